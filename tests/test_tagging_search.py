import random
import re

from pyspark.sql import functions as F

from papersieve import vocabulary as V
from papersieve.lexicon import GROUPS, alias_table, search_term_table, search_terms_frame, starter_aliases, starter_terms
from papersieve.operators import search, tagging
from papersieve.schema import TRACKS

ALIASES = {
    "norvaline": "Nva", "d-lysine": "D-lysine", "2,4-diaminobutyric acid": "Dab",
    "diaminobutyric acid": "Dab", "asymmetric dimethylarginine": "ADMA",
    "symmetric dimethylarginine": "SDMA", "acc": "ACPrC", "acid": "ACID",
    "(2s)-2-amino acid": "X(2S)", "ng,n'g-dimethylarginine": "SDMA", "gly(bcp)": "BCP",
}


def plain(text, aliases):
    found = []
    for alias in sorted(aliases, key=len, reverse=True):
        pattern = r"(?<![a-zA-Z0-9-])" + re.escape(alias) + r"(?![a-zA-Z0-9-])"
        if aliases[alias] not in found and re.search(pattern, text, re.IGNORECASE):
            found.append(aliases[alias])
    return ", ".join(found)


def frame_of(spark, texts):
    return spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], "ingest_seq long, title string, abstract string")


def test_golden(spark):
    texts = ["D-lysine and norvaline", "2,4-diaminobutyric acid", "asymmetric dimethylarginine", "L-norvaline", "", "ACC-x", "NORVALINE."]
    got = tagging.tag_records(frame_of(spark, texts), ALIASES).orderBy("ingest_seq").collect()
    assert [r["compounds"] for r in got] == ["Nva, D-lysine", "Dab, ACID", "ADMA", "", "", "", "Nva"]


def test_literal_and_table_agree_with_plain_search(spark):
    rng = random.Random(3)
    pieces = [*ALIASES, "foo", "-", "(", "2,4-", "acids", "The", "ACC", "é", "K", ",", "symmetric"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "", ", ", "-"]) for _ in range(rng.randrange(12))) for _ in range(400)]
    records = frame_of(spark, texts)
    want = [plain(t, ALIASES) for t in texts]
    literal = tagging.tag_records(records, ALIASES).orderBy("ingest_seq").collect()
    assert [r["compounds"] for r in literal] == want
    ranked = [(a, c, i) for i, (a, c) in enumerate(tagging.ranked_aliases(ALIASES))]
    table = spark.createDataFrame(ranked, "alias string, canonical string, rank int")
    joined = tagging.tag_with_table(records, table).orderBy("ingest_seq").collect()
    assert [r["compounds"] for r in joined] == want
    by_table = tagging.tag(records, table.select("alias", "canonical")).orderBy("ingest_seq").collect()
    assert [set(r["compounds"].split(", ")) for r in by_table] == [set(w.split(", ")) for w in want]
    many = {**ALIASES, **{f"unused name {i}": "none" for i in range(6000)}}
    big = tagging.tag(records, many).orderBy("ingest_seq").collect()
    assert [r["compounds"] for r in big] == want


def test_title_and_abstract_are_one_text(spark):
    rows = spark.createDataFrame([(0, "norvaline", "d-lysine"), (1, None, "acc")], "ingest_seq long, title string, abstract string")
    got = tagging.tag_records(rows, ALIASES).orderBy("ingest_seq").collect()
    assert [r["compounds"] for r in got] == ["Nva, D-lysine", "ACPrC"]
    counts = {r["tag"]: r["n"] for r in tagging.tag_frequency(rows, ALIASES).collect()}
    assert counts == {"Nva": 1, "D-lysine": 1, "ACPrC": 1}


def test_term_tables(spark, tmp_path):
    (tmp_path / "aliases.csv").write_text("alias,canonical\nL-Norvaline,Nva\nfoo,Foo\n")
    (tmp_path / "terms.csv").write_text("grp,ord,term\nb,1,y\nb,0,x\na,2,z\n")
    read = {r["alias"]: r["canonical"] for r in alias_table(spark, str(tmp_path / "aliases.csv")).collect()}
    assert read == {"l-norvaline": "Nva", "foo": "Foo"} and alias_table(spark, None) == starter_aliases()
    assert search_term_table(spark, str(tmp_path / "terms.csv")) == {"b": ["x", "y"], "a": ["z"]}
    terms = starter_terms()
    assert list(terms) == list(GROUPS) and all(terms.values())
    table = search_terms_frame(spark)
    assert table.count() == sum(len(v) for v in terms.values())
    blocks = search.field_blocks(table.select("grp", "ord", "term"), size=5).collect()
    lysine = sorted((r["block_ord"], r["block"]) for r in blocks if r["grp"] == "lysine")
    assert lysine[0][1].split(" OR ")[0] == terms["lysine"][0] + "[Title/Abstract]"
    assert sum(len(b.split(" OR ")) for _, b in lysine) == len(terms["lysine"])


def test_query_builders(spark):
    terms = {"gce": ["g1", "g2"], "beta": ["b1"], **{g: ["x"] for g in GROUPS if g not in ("gce", "beta")}}
    sizes = [len(search.pubmed_queries(t, terms)) for t in TRACKS]
    assert sizes == [10, 10, 9, 19, 7, 12]
    names = sum(len(v) for v in terms.values())
    lengths = {t: len(search.crossref_queries(t, terms)) for t in TRACKS}
    assert lengths["chemical"] == names + 4 * 14 and lengths["hybrid"] == names + 4 * 6 + 3
    assert lengths["gce"] == 2 + 12
    assert search.crossref_queries("pathway", terms, 3) == search.crossref_queries("pathway", terms)[:3]
    assert search.crossref_queries("pathway", terms, 0) == search.crossref_queries("pathway", terms)
    assert search.crossref_queries("other", terms) == []
    listed = [(i, n) for i, n in enumerate(n for v in terms.values() for n in v)]
    frame = search.crossref_query_frame(spark.createDataFrame(listed, "ord int, term string"), ["hybrid"])
    assert [r["query"] for r in frame.orderBy("ord").collect()] == search.crossref_queries("hybrid", terms)


def test_query_resolution():
    cfg = {"pubmed": {"pathway_queries": [" ", "a"], "queries": ["legacy"]},
           "crossref": {"rows": 5, "gce": {"enabled": False}, "hybrid": {"query_source": "manual", "queries": ["m", " "]},
                        "chemical": {"strategy": {"max_queries": 4}}}}
    assert search.searches(cfg, "pubmed", "pathway") == ["a"]
    assert search.searches({"pubmed": {"use_keywords_from_code": False, "queries": ["q"]}}, "pubmed", "hybrid") == ["q"]
    assert search.searches({**cfg, "pubmed": {**cfg["pubmed"], "use_keywords_from_code": False}}, "pubmed", "hybrid") == []
    assert search.searches(cfg, "crossref", "gce") == [] and search.searches(cfg, "crossref", "hybrid") == ["m"]
    assert len(search.searches(cfg, "crossref", "chemical")) == 4
    assert search.track_settings(cfg, "crossref", "hybrid")["rows"] == 5
    assert search.resolve_tracks(" GCE ") == ["gce"] and search.resolve_tracks(None) == list(TRACKS)


def test_pairs_are_not_a_cross_join(spark):
    frame = spark.createDataFrame([("g", 0, "a"), ("g", 1, "b ")], "grp string, ord int, term string")
    pairs = search.pair_terms(frame, V.METHOD_SIGNALS["hybrid"])
    got = [r["expression"] for r in pairs.orderBy("ord", "signal_ord").collect()]
    assert got == [f"{t} {s}".strip() for t in ("a", "b ") for s in V.METHOD_SIGNALS["hybrid"]]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Exchange" not in plan
