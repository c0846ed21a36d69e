import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracle import compare
from papersieve.operators import ranges
from papersieve.plans import oracle, queries
from papersieve.sources import api

SF_DIR = "/root/testdata/sf0.001"


OWN = queries.queries()


def test_every_query_has_sql():
    assert set(OWN) == set(oracle.oracle_sql())
    assert set(OWN) <= set(entry.queries())


@pytest.mark.parametrize("name", list(OWN))
def test_query_equals_its_sql(spark, name):
    outcome = compare(spark, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


def test_flagship(spark):
    found = entry.entry(spark)
    assert found.columns == ["doi", "title", "source", "track", "journal", "pub_date", "local_has_pdf"]
    assert found.count() > 0


def test_segments_cover_all_results(spark):
    from papersieve.plans.queries import _daily

    daily = _daily(spark, SF_DIR)
    plan = ranges.plan_segments(daily, limit=100)
    assert plan.groupBy().sum("n").first()[0] == daily.groupBy().sum("n").first()[0]
    assert plan.filter("not truncated and n > 100").count() == 0


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_they_need(spark):
    assert "text" not in plan_of(OWN["record_union"](spark, SF_DIR)).split("ReadSchema")[1].split("\n")[0]
    for name in ("dedup_doi_only", "library_import", "judgement_merge", "query_pairs", "keep_first_by_doi"):
        plan = plan_of(OWN[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def with_table(frame, name, folder):
    """A copy of the test tables with another table ``name``."""
    for other in os.listdir(SF_DIR):
        if other != f"{name}.parquet":
            os.symlink(f"{SF_DIR}/{other}", folder / other)
    frame.toPandas().to_parquet(folder / f"{name}.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", ["json_record_parse", "json_landed_scan"])
def test_titles_cut_within_a_reference(spark, tmp_path, name):
    titles = ["a&amp;&amp;amp", "b &amp", "&am", "c&quot", "d&", "&copy e", "&#39", "&amp;amp", "&amp;lt; &lt;i&gt; &quot;x&quot; &#39;", "plain"]
    pages = spark.createDataFrame([(i + 1, f"u{i}", f"<html><title>{t}</title></html>") for i, t in enumerate(titles)], "page_id long, url string, html string")
    outcome = compare(spark, with_table(pages, "pages", tmp_path), name, entry.queries()[name], entry.oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


def test_segment_plan_with_months_over_the_limit(spark, tmp_path):
    days = {"1992-05-07": 1500, "1993-02-03": 40, "1995-01-01": 700, "1995-12-31": 300, "1996-02-29": 5, "1998-01-20": 1300, "1998-01-31": 100, "1998-02-02": 1000}
    orders = [
        (priority, f"{day} 00:00:00")
        for priority, part in (("1-URGENT", ""), ("2-HIGH", "199"), ("3-MEDIUM", "1995"), ("4-LOW", "1998"), ("5-ONE", "1992"))
        for day, n in days.items() if day.startswith(part) for _ in range(n)
    ]
    frame = spark.createDataFrame([(i, p, d) for i, (p, d) in enumerate(orders)], "o_orderkey long, o_orderpriority string, o_orderdate string")
    frame = frame.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    outcome = compare(spark, with_table(frame, "orders", tmp_path), "segment_plan", entry.queries()["segment_plan"], entry.oracle_sql()["segment_plan"])
    assert outcome.startswith("ok"), outcome


def test_months_over_the_limit_are_cut_for_a_read(spark):
    daily = spark.createDataFrame([("q", f"2020-03-{d:02d}", 400) for d in range(1, 32)], "query string, day string, n long").withColumn("day", F.col("day").cast("date"))
    plan = api.plan_of_counts(daily, 1200).collect()
    assert sum(r["n"] for r in plan) == 31 * 400 and max(r["n"] for r in plan) <= 1200
    assert [r["n"] for r in api.plan_of_counts(daily, 1200, finest="month").collect()] == [31 * 400]
