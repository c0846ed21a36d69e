import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from papersieve.operators import ranges
from papersieve.sources import api, landed

ARTICLE = """<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal><Title>J &amp; K</Title></Journal>
<ArticleTitle> Total <i>E. coli</i> synthesis</ArticleTitle><Abstract><AbstractText Label="AIM">Foo <sub>2</sub> bar</AbstractText>
<AbstractText> </AbstractText><AbstractText>Plain.</AbstractText></Abstract>
<PublicationTypeList><PublicationType>Journal Article</PublicationType><PublicationType>Review</PublicationType></PublicationTypeList>
<PubDate><Year>2024</Year><Month>Mar</Month></PubDate></Article></MedlineCitation>
<PubmedData><ArticleIdList>{ids}</ArticleIdList><ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">10.9/ref</ArticleId>
</ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle>"""


def article(pmid, doi="10.5555/x"):
    ids = f'<ArticleId IdType="pii">p</ArticleId><ArticleId IdType="doi"> {doi}{pmid} </ArticleId>' if doi else ""
    return ARTICLE.format(pmid=pmid, ids=ids)


def test_landed_xml(spark, tmp_path):
    body = "<?xml version='1.0'?>\n<PubmedArticleSet>\n" + "\n".join(
        [article(1), article(2, ""), "<PubmedArticle><broken></PubmedArticle>", article(3)]
    ) + "\n</PubmedArticleSet>"
    (tmp_path / "a.xml").write_text(body, encoding="utf-8")
    got = {r["pmid"]: r for r in landed.read_articles(spark, str(tmp_path / "a.xml")).collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert tuple(landed.malformed(landed.article_texts(spark, str(tmp_path / "a.xml"))).first()) == (4, 1)
    one = got["1"]
    assert (one["doi"], one["title"], one["journal"], one["pub_date"]) == (
        "10.5555/x1", "Total E. coli synthesis", "J & K", "2024-Mar",
    )
    assert one["abstract"] == "AIM: Foo 2 bar\nPlain." and one["publication_types"] == "Journal Article; Review"
    assert got["2"]["doi"] == ""


def test_landed_json(spark, tmp_path):
    items = [
        {"DOI": " 10.5/A ", "title": ["A &lt;b&gt;", "t2"], "container-title": ["J &amp; K"],
         "published": {"date-parts": [[2024, 3, None]]}, "type": "journal-article"},
        {"DOI": "10.5/b", "published-online": {"date-parts": [[2023]]}},
        {"title": ["no id"]},
    ]
    (tmp_path / "p.json").write_text(json.dumps({"message": {"total-results": 3, "items": items}}), encoding="utf-8")
    got = sorted(landed.read_answers(spark, str(tmp_path)).collect(), key=lambda r: r["doi"])
    assert [(r["doi"], r["title"], r["journal"], r["pub_date"], r["publication_types"]) for r in got] == [
        ("10.5/A", "A <b>", "J & K", "2024-3", "journal article"), ("10.5/b", "", "", "2023", ""),
    ]


def test_split_range_covers_every_day_once():
    todo, leaves = [(date(2019, 5, 7), date(2026, 6, 25))], []
    while todo:
        low, high = todo.pop()
        finer = ranges.split_range(low, high)
        assert finer[0][0] == low and finer[-1][1] == high
        assert all(b[0] - a[1] == timedelta(days=1) for a, b in zip(finer, finer[1:]))
        (leaves if len(finer) == 1 else todo).extend(finer)
    assert len(leaves) == (date(2026, 6, 25) - date(2019, 5, 7)).days + 1
    assert ranges.split_range(date(2023, 1, 1), date(2025, 12, 31))[0] == (date(2023, 1, 1), date(2023, 1, 31))
    assert ranges.split_range(date(2020, 3, 1), date(2026, 1, 1))[0] == (date(2020, 3, 1), date(2022, 12, 31))


def record_answer(folder, url, params, text):
    (folder / api.ReplayTransport.name(url, params)).write_text(text, encoding="utf-8")


def search_params(query, low, high, offset, size):
    return {"db": "pubmed", "tool": "papersieve", "term": query, "datetype": "pdat",
            "mindate": low.strftime("%Y/%m/%d"), "maxdate": high.strftime("%Y/%m/%d"),
            "retstart": offset, "retmax": size, "retmode": "json"}


def fetch_params(ids):
    return {"db": "pubmed", "tool": "papersieve", "id": ",".join(ids), "rettype": "xml", "retmode": "xml"}


def test_article_search_pages_splits_and_halves(spark, tmp_path):
    low, high = date(2024, 1, 1), date(2024, 2, 29)
    mid = date(2024, 1, 31)

    def answer(query, a, b, count, pages):
        record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params(query, a, b, 0, 0),
                      json.dumps({"esearchresult": {"count": str(count)}}))
        for offset, size, ids in pages:
            record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params(query, a, b, offset, size),
                          json.dumps({"esearchresult": {"idlist": ids}}))

    answer("big", low, high, 20000, [])
    answer("big", low, mid, 3, [(0, 2, ["1", "2"]), (2, 1, ["3"])])
    answer("big", date(2024, 2, 1), high, 1, [(0, 1, ["2"])])
    answer("small", low, high, 1, [(0, 1, ["4"])])
    spark.dataSource.register(api.ArticleSearch)
    options = {"queries": json.dumps(["big", "small"]), "date_from": str(low), "date_to": str(high),
               "batch_size": "2", "replay": str(tmp_path)}
    found = spark.read.format("article_search").options(**options).load().orderBy("query_ord", "position").collect()
    assert [(r["query_ord"], r["pmid"]) for r in found] == [(0, "1"), (0, "2"), (0, "3"), (0, "2"), (1, "4")]
    # The batch request of ids 1,2 is missing, so it is halved; id 2 fails for good.
    record_answer(tmp_path, api.ARTICLE_FETCH_URL, fetch_params(["1"]), f"<S>{article(1)}</S>")
    record_answer(tmp_path, api.ARTICLE_FETCH_URL, fetch_params(["3", "4"]), f"<S>{article(3)}{article(4)}</S>")
    ids = spark.createDataFrame([(0, "1"), (1, "2"), (2, "3"), (3, "4")], "row_index long, pmid string")
    raw = api.fetch_articles(ids, {"replay": str(tmp_path), "efetch_batch_size": 2})
    parsed = landed.parse_articles(raw, keep=("row_index",)).orderBy("row_index").collect()
    assert [(r["row_index"], r["doi"]) for r in parsed] == [(0, "10.5555/x1"), (2, "10.5555/x3"), (3, "10.5555/x4")]


def test_work_search_follows_the_cursor(spark, tmp_path):
    common = {"query.title": "norvaline", "filter": "from-pub-date:2024-01-01,until-pub-date:2024-02-01,type:journal-article"}

    def answer(params, message):
        record_answer(tmp_path, api.WORKS_URL, {**common, **params}, json.dumps({"message": message}))

    items = [{"DOI": f"10.5/{i}", "title": [f"t{i}"]} for i in range(3)]
    answer({"rows": 0, "select": "DOI"}, {"total-results": 9})
    answer({"rows": 2, "cursor": "*", "select": api.WORK_FIELDS}, {"items": items[:2], "next-cursor": "n1"})
    answer({"rows": 1, "cursor": "n1", "select": api.WORK_FIELDS}, {"items": items[2:], "next-cursor": "n2"})
    spark.dataSource.register(api.WorkSearch)
    found = spark.read.format("work_search").options(
        queries=json.dumps(["norvaline"]), date_from="2024-01-01", date_to="2024-02-01", query_param="title",
        rows_per_query="2", limit_per_query="3", replay=str(tmp_path),
    ).load()
    parsed = landed.parse_items(found, keep=("query_ord", "position")).orderBy("position").collect()
    assert [(r["doi"], r["title"]) for r in parsed] == [("10.5/0", "t0"), ("10.5/1", "t1"), ("10.5/2", "t2")]


def article_ids(tmp_path, day, **options):
    options = {"queries": '["q"]', "date_from": str(day), "date_to": str(day), "batch_size": "2", "replay": str(tmp_path), **options}
    return [r[2] for r in api.ArticleReader(options).read(api.SearchPartition(0, "q"))]


def test_article_search_raises_instead_of_losing_results(tmp_path):
    day = date(2024, 1, 1)
    say = lambda offset, size, answer: record_answer(
        tmp_path, api.ARTICLE_SEARCH_URL, search_params("q", day, day, offset, size), json.dumps(answer))
    say(0, 0, {})
    with pytest.raises(api.Incomplete):
        article_ids(tmp_path, day)
    say(0, 0, {"esearchresult": {"count": str(ranges.RESULT_LIMIT + 1)}})
    with pytest.raises(api.Incomplete, match="one day"):
        article_ids(tmp_path, day)
    say(0, 0, {"esearchresult": {"count": "3"}})
    say(0, 2, {"esearchresult": {"idlist": ["1", "2"]}})
    with pytest.raises(api.Unavailable):
        article_ids(tmp_path, day)
    say(2, 1, {"esearchresult": {"idlist": []}})
    with pytest.raises(api.Incomplete, match="0 of 1"):
        article_ids(tmp_path, day)
    say(2, 1, {"esearchresult": {"idlist": ["3"]}})
    assert article_ids(tmp_path, day) == ["1", "2", "3"]


def test_work_search_takes_all_pages_or_raises(tmp_path):
    options = {"queries": '["q"]', "date_from": "2024-01-01", "date_to": "2024-02-01", "rows_per_query": "1", "replay": str(tmp_path)}
    common = {"query": "q", "filter": "from-pub-date:2024-01-01,until-pub-date:2024-02-01,type:journal-article"}
    say = lambda params, message: record_answer(tmp_path, api.WORKS_URL, {**common, **params}, json.dumps({"message": message}))
    page = lambda cursor: {"rows": 1, "cursor": cursor, "select": api.WORK_FIELDS}
    found = lambda **more: list(api.WorkReader({**options, **more}).read(api.SearchPartition(0, "q")))
    say({"rows": 0, "select": "DOI"}, {"total-results": 25})
    for i in range(24):
        say(page(f"n{i}" if i else "*"), {"items": [{"DOI": f"10.5/{i}"}], "next-cursor": f"n{i + 1}"})
    with pytest.raises(api.Unavailable):
        found()
    say(page("n24"), {"items": []})
    with pytest.raises(api.Incomplete, match="24 of 25"):
        found()
    say(page("n24"), {"items": [{"DOI": "10.5/24"}]})
    assert len(found()) == 25 and len(found(limit_per_query="7")) == 7


def test_failing_ids_and_searches_end_a_run(spark, tmp_path):
    from papersieve.plans import runs

    day = date(2024, 1, 1)
    record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params("q", day, day, 0, 0), json.dumps({"esearchresult": {"count": "2"}}))
    settings = {"replay": str(tmp_path), "batch_size": 2, "efetch_batch_size": 2}
    spark.dataSource.register(api.ArticleSearch)
    read = lambda **more: runs.pubmed_records(spark, ["q"], (day, day), {**settings, **more}, str(tmp_path / "landing"), True)
    with pytest.raises(Exception, match="Unavailable"):
        read()
    record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params("q", day, day, 0, 2), json.dumps({"esearchresult": {"idlist": ["1", "2"]}}))
    record_answer(tmp_path, api.ARTICLE_FETCH_URL, fetch_params(["1"]), f"<S>{article(1)}</S>")
    record_answer(tmp_path, api.ARTICLE_FETCH_URL, fetch_params(["2"]), "<S><ERROR>no</ERROR></S>")
    with pytest.raises(api.Incomplete, match="1 articles could not be fetched: 2"):
        read()
    assert [r["doi"] for r in read(allow_gaps=True).collect()] == ["10.5555/x1"]
    assert [r["gap"] for r in spark.read.parquet(str(tmp_path / "landing" / "article_gaps" / "*")).collect()] == ["2"]


def articles_of(tmp_path, query, low, high, ids, pages=True):
    record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params(query, low, high, 0, 0), json.dumps({"esearchresult": {"count": str(len(ids))}}))
    if pages and ids:
        record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params(query, low, high, 0, len(ids)), json.dumps({"esearchresult": {"idlist": ids}}))


def test_a_plan_has_a_partition_for_each_segment(spark, tmp_path):
    low, high = date(2024, 1, 1), date(2024, 2, 29)
    record_answer(tmp_path, api.ARTICLE_SEARCH_URL, search_params("big", low, high, 0, 0), json.dumps({"esearchresult": {"count": "12000"}}))
    articles_of(tmp_path, "big", low, date(2024, 1, 31), [str(i) for i in range(3)])
    articles_of(tmp_path, "big", date(2024, 2, 1), high, ["9"])
    articles_of(tmp_path, "none", low, high, [])
    articles_of(tmp_path, "small", low, high, ["9", "8"])
    options = {"queries": json.dumps(["big", "none", "small"]), "date_from": str(low), "date_to": str(high), "replay": str(tmp_path)}
    plan = api.ArticleReader(options).plan()
    assert [(s.ordinal, s.start.day, s.end.month, s.first, s.total) for s in plan] == [(0, 1, 1, 0, 3), (0, 1, 2, 3, 1), (2, 1, 2, 0, 2)]
    assert [api.SearchPartition.from_dict(json.loads(json.dumps(s.to_dict()))) for s in plan] == plan
    api.register(spark)
    found = spark.read.format("article_search").options(**options).load()
    assert found.rdd.getNumPartitions() == 3
    one = found.filter("query_ord = 2")
    assert one.rdd.getNumPartitions() == 1 and sorted(r["pmid"] for r in one.collect()) == ["8", "9"]


def test_a_resumed_run_repeats_only_the_failed_segment(spark, tmp_path):
    from papersieve.plans import runs

    replay, day = tmp_path / "answers", date(2024, 1, 1)
    replay.mkdir()
    for query, pages in (("q1", True), ("q2", False), ("q3", True)):
        articles_of(replay, query, day, day, [query + "a", query + "b"], pages)
    api.register(spark)
    land = lambda resume: runs.land(
        spark, "article_search", ["q1", "q2", "q3"], (day, day), {"replay": str(replay)}, str(tmp_path / "landing"), resume)
    with pytest.raises(Exception, match="Unavailable"):
        land(False)
    (attempt,) = (tmp_path / "landing").glob("article_search/*/attempt-*/segments")
    assert sorted(p.name[:6] for p in attempt.glob("*.parquet")) == ["000000", "000002"]
    # Everything that is there already, counts included, is not asked for again.
    for path in list(replay.iterdir()):
        path.write_text("{}")
    record_answer(replay, api.ARTICLE_SEARCH_URL, search_params("q2", day, day, 0, 2), json.dumps({"esearchresult": {"idlist": ["x", "y"]}}))
    got = land(True).orderBy("query_ord", "position").collect()
    assert [tuple(r) for r in got] == [(0, 0, "q1a"), (0, 1, "q1b"), (1, 0, "x"), (1, 1, "y"), (2, 0, "q3a"), (2, 1, "q3b")]
    with pytest.raises(api.Incomplete):
        land(False)


def say_works(folder, low, high, items, types=("journal-article",), query="w", rows=200):
    common = {"query": query, "filter": ",".join([f"from-pub-date:{low}", f"until-pub-date:{high}", *(f"type:{t}" for t in types)])}
    answer = lambda params, message: record_answer(folder, api.WORKS_URL, {**common, **params}, json.dumps({"message": message}))
    answer({"rows": 0, "select": "DOI"}, {"total-results": len(items)})
    if items:
        answer({"rows": min(rows, len(items)), "cursor": "*", "select": api.WORK_FIELDS}, {"items": items})


def work(doi, day, kind="journal-article"):
    return {"DOI": doi, "published": {"date-parts": [[int(x) for x in day.split("-")]]}, "type": kind}


def test_filters_on_dates_and_types_go_to_the_service(spark, tmp_path):
    items = [work("10.5/a", "2024-01-05"), work("10.5/b", "2024-02-10", "book"), work("10.5/c", "2024-02-20"), {"DOI": "10.5/d"}, work("10.5/e", "2024")]
    both = ["journal-article", "book"]
    whole, pushed = tmp_path / "whole", tmp_path / "pushed"
    whole.mkdir()
    pushed.mkdir()
    say_works(whole, "2024-01-01", "2024-12-31", items, both)
    # The service may give out more than was asked for; Spark checks again.
    say_works(pushed, "2024-02-01", "2024-02-28", items[1:4], ["book"])
    api.register(spark)
    options = {"queries": '["w", "other"]', "date_from": "2024-01-01", "date_to": "2024-12-31", "filter_types": json.dumps(both)}
    read = lambda folder: spark.read.format("work_search").options(**options, replay=str(folder)).load()
    wanted = "query_ord = 0 and published >= date'2024-02-01' and published < date'2024-02-29' and type = 'book'"
    got = read(pushed).filter(wanted)
    assert [r["raw"] for r in got.collect()] == [json.dumps(items[1])]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "query_ord" not in plan.split("Filter")[1].split("BatchScan")[0].split("(")[1], plan
    say_works(whole, "2024-01-01", "2024-12-31", [], both, "other")
    unpushed = read(whole).collect()
    same = [r["raw"] for r in unpushed if r["query_ord"] == 0 and r["published"] and date(2024, 2, 1) <= r["published"] < date(2024, 2, 29) and r["type"] == "book"]
    assert same == [r["raw"] for r in got.collect()]
    assert [r["published"] for r in unpushed] == [date(2024, 1, 5), date(2024, 2, 10), date(2024, 2, 20), None, date(2024, 1, 1)]
    assert read(pushed).filter("query_ord = 0 and type = 'dataset'").count() == 0
    assert read(pushed).filter("query_ord = 0 and published > date'2025-06-01'").count() == 0


def test_works_are_cut_into_segments_that_add_up(tmp_path):
    items = [work(f"10.5/{i}", "2024-01-05") for i in range(3)] + [work("10.5/x", "2024-02-05")]
    say_works(tmp_path, "2024-01-01", "2024-02-29", items)
    say_works(tmp_path, "2024-01-01", "2024-01-31", items[:3])
    say_works(tmp_path, "2024-02-01", "2024-02-29", items[3:])
    options = {"queries": '["w"]', "date_from": "2024-01-01", "date_to": "2024-02-29", "replay": str(tmp_path)}
    plan = lambda **more: [(str(s.start), s.first, s.total) for s in api.WorkReader({**options, **more}).plan()]
    assert plan() == [("2024-01-01", 0, 4)] == plan(segment_rows="3", limit_per_query="9")
    assert plan(segment_rows="3") == [("2024-01-01", 0, 3), ("2024-02-01", 3, 1)]
    rows = [r for s in api.WorkReader({**options, "segment_rows": "3"}).plan() for r in api.WorkReader(options).read(s)]
    assert [(r[1], json.loads(r[2])) for r in rows] == list(enumerate(items))
    say_works(tmp_path, "2024-02-01", "2024-02-29", [])
    assert plan(segment_rows="3") == [("2024-01-01", 0, 4)]


def test_units_are_landed_whole(spark, tmp_path):
    from papersieve.sinks import units

    rows = [("a", 2, None, 1), ("a", 2, None, 2), ("c", 2, None, 4), ("d", 1, "down", None), ("b", 1, None, 3)]
    frame = spark.createDataFrame(rows, "unit string, unit_rows long, error string, v int").coalesce(1)
    with pytest.raises(Exception, match="2 units are missing: c: 1 of 2 rows; d: down"):
        units.land(frame, str(tmp_path / "u"))
    assert units.landed(spark, str(tmp_path / "u")) == {"a", "b"} and units.read(spark, str(tmp_path / "none"), "v int").count() == 0
    units.land(frame.filter("unit = 'a'").withColumn("v", F.col("v") * 10), str(tmp_path / "u"))
    assert sorted(r["v"] for r in units.read(spark, str(tmp_path / "u"), "v int").collect()) == [3, 10, 20]


def test_point_lookup():
    known = lambda url, params: '{"message": {"DOI": "10.5/a"}}' if url.endswith("10.5/a") else ""
    assert json.loads(api.work_by_doi(" 10.5/a ", known))["DOI"] == "10.5/a"
    assert api.work_by_doi("10.5/zz", known) is None and api.work_by_doi("", known) is None


def test_fetch_lands_and_resumes(spark, tmp_path):
    from papersieve.plans import runs

    replay = tmp_path / "answers"
    replay.mkdir()
    low, high = date(2024, 1, 1), date(2024, 2, 1)
    for query, ids in (("q1", ["7", "8"]), ("q2", ["8", "9"])):
        record_answer(replay, api.ARTICLE_SEARCH_URL, search_params(query, low, high, 0, 0),
                      json.dumps({"esearchresult": {"count": "2"}}))
        record_answer(replay, api.ARTICLE_SEARCH_URL, search_params(query, low, high, 0, 2),
                      json.dumps({"esearchresult": {"idlist": ids}}))
    record_answer(replay, api.ARTICLE_FETCH_URL, fetch_params(["7", "8", "9"]), f"<S>{article(7)}{article(8)}{article(9)}</S>")
    common = {"query": "w1", "filter": "from-pub-date:2024-01-01,until-pub-date:2024-02-01,type:journal-article"}
    work = {"DOI": "10.5555/W", "title": ["Work"]}
    for params, message in (
        ({"rows": 0, "select": "DOI"}, {"total-results": 2}),
        ({"rows": 2, "cursor": "*", "select": api.WORK_FIELDS}, {"items": [work, {**work, "DOI": "10.5555/w"}]}),
    ):
        record_answer(replay, api.WORKS_URL, {**common, **params}, json.dumps({"message": message}))
    cfg = {
        "paths": {"state_dir": str(tmp_path / "state")},
        "pubmed": {"use_keywords_from_code": False, "hybrid_queries": ["q1", "q2"], "batch_size": 2,
                   "efetch_batch_size": 50, "replay": str(replay)},
        "crossref": {"query_source": "manual", "queries": ["w1"], "replay": str(replay)},
    }
    fetch = lambda resume: runs.fetch_records(spark, cfg, ["hybrid"], "all", lambda _: (low, high), resume)
    rows = fetch(False).orderBy("ingest_seq").collect()
    assert [(r["ingest_seq"], r["source"], r["doi"], r["track"]) for r in rows] == [
        (0, "pubmed", "10.5555/x7", "hybrid"), (1, "pubmed", "10.5555/x8", "hybrid"),
        (2, "pubmed", "10.5555/x9", "hybrid"), (3, "crossref", "10.5555/W", "hybrid"),
    ]
    # The searches are complete: a resumed run needs none of their answers again.
    for query in ("q1", "q2"):
        (replay / api.ReplayTransport.name(api.ARTICLE_SEARCH_URL, search_params(query, low, high, 0, 2))).write_text("{}")
    assert fetch(True).count() == 4
    assert len(list((tmp_path / "state" / "landing").glob("article_search/*/attempt-*"))) == 1
    assert runs.fetch_records(spark, {"pubmed": {"use_keywords_from_code": False}, "crossref": {"enabled": False}},
                              ["hybrid"], "all", lambda _: (low, high)).count() == 0


def test_articles_are_parsed_slice_by_slice(spark):
    """What a task holds is bounded by bytes of text, not by the rows of a batch."""
    body = "x" * 300_000
    rows = [(i, f"<PubmedArticle><PMID>{i}</PMID><Abstract><AbstractText>{body}</AbstractText></Abstract></PubmedArticle>") for i in range(12)]
    table = spark.createDataFrame([*rows, (12, None), (13, "<broken")], "k long, raw string").coalesce(1)
    parsed = landed.parse_articles(table, keep=("k",))
    assert "MapInArrow" in parsed._jdf.queryExecution().executedPlan().toString()
    assert {(r["k"], r["pmid"], len(r["abstract"])) for r in parsed.collect()} == {(i, str(i), 300_000) for i in range(12)}
    assert tuple(landed.malformed(table).first()) == (14, 2)
