from pyspark.sql import functions as F

from papersieve.operators import classify, counters, filters

COLUMNS = "ingest_seq long, doi string, title string, publication_types string, pub_date string, track string"


def rows(spark, *cells):
    return spark.createDataFrame(
        [(i, c.get("doi", "10.5555/x"), c.get("title", "Enzymatic route to norvaline derivatives"),
          c.get("types", ""), c.get("date", ""), c.get("track", "")) for i, c in enumerate(cells)],
        COLUMNS,
    )


def reasons(spark, cfg, *cells):
    frame = rows(spark, *cells).select("ingest_seq", filters.drop_reason(cfg).alias("r"))
    return [r["r"] for r in frame.orderBy("ingest_seq").collect()]


def test_types(spark):
    cells = [{"types": t} for t in ("", " ", "Journal Article", "A Review", "Preview", "Meta Analysis", "metaanalysis", "LETTER")]
    kept = filters.filter_types(rows(spark, *cells)).select("publication_types").collect()
    assert [r[0] for r in kept] == ["", " ", "Journal Article", "Preview", "Meta Analysis"]
    stats = counters.kept_dropped(rows(spark, *cells), filters.type_excluded()).first()
    assert (stats["input"], stats["dropped"], stats["kept"]) == (8, 3, 5)


def test_cleaner_reasons_in_order(spark):
    got = reasons(
        spark, filters.CleanerConfig(),
        {"title": "4-Fluorophenylalanine made by a new route"},
        {"title": "Recent advances in amino acid synthesis"},
        {"types": "Journal Article; Review"},
        {"title": "Two words"},
        {"types": "Editorial", "title": "Recent"},
        {"types": " "},
        {"title": "A broad overview of routes"},
        {"title": "Notes of the conference on routes"},
        {"doi": "10.1021/MTGABS.1"},
        {"doi": "10.1021/abc.S001"},
        {"title": "Front of the issue (Small 12/2024)"},
        {"title": "Nanozyme made by a route"},
        {},
    )
    assert got == [
        "numeric_title_start", "title_prefix", None, "short_title", "non_journal_article",
        "non_journal_article", "title_regex", "conference_keyword", "conference_keyword",
        "doi_pattern", "cover_suffix", None, None,
    ]


def test_cleaner_overrides(spark):
    cfg = filters.CleanerConfig.from_dict(
        {"enabled": True, "title_prefixes": [], "track_overrides": {
            "bio": {"exclude_nanozyme_in_title": True, "min_pub_year": 2020, "min_title_words": 0}}}
    )
    got = reasons(
        spark, cfg,
        {"title": "Nanozyme made by a route"},
        {"title": "Nanozyme made by a route", "track": "BIO "},
        {"title": "Short", "track": "bio", "date": "2019-05"},
        {"title": "Short", "track": "bio", "date": "unknown"},
        {"title": "recent but default prefixes stay"},
    )
    assert got == [None, "nanozyme_in_title", "pub_year_before_min", None, "title_prefix"]


def test_drop_reason_counts_are_sorted(spark):
    frame = rows(spark, {"title": "Two words"}, {"title": "Recent one"}, {"title": "Short"}, {})
    counted = counters.drop_reason_counts(frame, filters.drop_reason(filters.CleanerConfig())).collect()
    assert [(r["reason"], r["n"]) for r in counted] == [("short_title", 2), ("title_prefix", 1)]


def test_title_filter(spark):
    frame = rows(spark, {"title": "soil software for patient"}, {"title": "Enzymatic catalysis"}, {"title": "soil, algorithm"})
    cfg = filters.TitleFilterConfig(enabled=True, require_positive=True, only_keep_passed=False)
    got = [(r["title_filter_hits"], r["title_filter_pass"]) for r in filters.filter_titles(frame, cfg).orderBy("ingest_seq").collect()]
    assert got == [
        ("neg:patient, soil, software; pos:missing", "false"),
        ("pos:enzymatic, catalysis", "true"),
        ("neg:algorithm; pos:missing", "false"),
    ]
    off = filters.filter_titles(frame, filters.TitleFilterConfig()).first()
    assert (off["title_filter_hits"], off["title_filter_pass"]) == ("", "true")
    assert filters.filter_titles(frame, filters.TitleFilterConfig(enabled=True)).count() == 1


def test_usable(spark):
    frame = spark.createDataFrame(
        [("true", ""), (" TRUE ", "x"), ("true", "batch_api_error_kept "), ("false", ""), (None, None)],
        "ai_pass string, ai_rationale_zh string",
    )
    assert [r[0] for r in frame.select(filters.is_usable()).collect()] == [True, True, False, False, False]


def test_tracks(apply, spark):
    titles = ["Unnatural amino acid norvaline by fermentative production", "Amber suppression in yeast",
              "Norvaline by fermentative production", "ncAA by transaminase", "an unnatural amino acid and total synthesis"]
    assert apply(classify.track_of_title, titles) == ["hybrid", "pathway", None, "enzymatic", "chemical"]
    frame = spark.createDataFrame([("GCE ", "x"), ("", "Hybrid"), ("bio", "both")], "track string, ai_category string")
    assert [r[0] for r in frame.select(classify.resolved_track()).collect()] == ["gce", "hybrid", "pathway"]
    counts = counters.count_by_domain(frame, F.lower(F.trim("track"))).collect()
    assert {r["track"]: r["n"] for r in counts}["gce"] == 1 and len(counts) == 6


def test_observed_counters(spark):
    frame, seen = counters.observed(rows(spark, {}, {"title": "Short"}), "obs", short=F.col("title") == "Short")
    assert frame.count() == 2 and seen.get == {"input": 2, "short": 1}
