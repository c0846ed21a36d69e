import pytest

from papersieve.operators import dedup
from papersieve.sources import api
from papersieve.streaming.ingest import RecordStore, ingest, ingest_works, record_keys
from test_sources import say_works, work

SCHEMA = "ingest_seq long, doi string, title string, pub_date string"


def test_later_files_meet_the_history(spark, tmp_path):
    source, store = str(tmp_path / "in"), RecordStore(spark, str(tmp_path / "store"))
    checkpoint = str(tmp_path / "offsets")
    cfg = dedup.DedupConfig(by_title=True)

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def drain():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        ingest(stream, store, checkpoint, cfg).awaitTermination()
        return sorted(r["ingest_seq"] for r in store.records().collect())

    arrive([(0, "10.5555/a", "one", ""), (1, "10.5555/b", "one", ""), (2, "10.5555/c", "two", "")])
    assert drain() == [0, 2]
    arrive([(3, "10.5555/A", "three", ""), (4, "10.5555/b", "four", "")])
    assert drain() == [0, 2, 4]
    assert drain() == [0, 2, 4]
    # A title of an earlier file is taken as well, as if all files were one batch.
    arrive([(5, "10.5555/e", "TWO", ""), (6, "10.5555/f", "six", "")])
    assert drain() == [0, 2, 4, 6]
    # A micro-batch that runs again replaces its own rows.
    again = spark.createDataFrame([(4, "10.5555/b", "four", "")], SCHEMA)
    store.write(again, 1)
    assert sorted(r["ingest_seq"] for r in store.records().collect()) == [0, 2, 4, 6]


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    store, cfg = RecordStore(spark, str(tmp_path / "store")), dedup.DedupConfig(by_title=True)
    rows = [(i, f"10.5555/{i}", f"title number {i}", "") for i in range(400)]
    store.accept(spark.createDataFrame(rows, SCHEMA), 0, cfg)
    batch = spark.createDataFrame([(900, "10.5555/7", "new", ""), (901, "10.5555/x", "Title NUMBER 9", ""), (902, "10.5555/y", "", "")], SCHEMA)
    keys = record_keys(batch, cfg)
    near = store.history.sharing(keys, 1)
    assert sorted(r["ingest_seq"] for r in near.collect()) == [7, 9]
    plan = near._jdf.queryExecution().executedPlan().toString()
    touched = {r["bucket"] for r in keys.collect()}
    assert len(touched) == 5 and "PartitionFilters" in plan and all(f"{b}" in plan.split("PartitionFilters")[1] for b in touched)
    assert store.history.sharing(keys, 0).count() == 0
    store.accept(batch, 1, cfg)
    assert sorted(r["ingest_seq"] for r in store.records().filter("batch = 1").collect()) == [902]


def test_three_runs_of_a_search_equal_one(spark, tmp_path):
    items = {
        ("2024-01-01", "2024-01-31"): [work("10.5555/a", "2024-01-05"), work("10.5555/b", "2024-01-06")],
        ("2024-02-01", "2024-02-29"): [work("10.5555/A", "2024-02-05"), work("10.5555/c", "2024-02-06")],
        ("2024-03-01", "2024-03-31"): [work("10.5555/d", "2024-03-05"), work("10.5555/b", "2024-03-06")],
    }
    replay = tmp_path / "answers"
    replay.mkdir()
    for (low, high), found in items.items():
        say_works(replay, low, high, found)
    say_works(replay, "2024-01-01", "2024-03-31", [i for found in items.values() for i in found])
    say_works(replay, "2024-01-01", "2024-03-31", [], query="v")

    def run(name, until, **more):
        store = RecordStore(spark, str(tmp_path / name))
        options = {"queries": '["w"]', "date_from": "2024-01-01", "date_to": until, "replay": str(replay), **more}
        ingest_works(spark, options, store, str(tmp_path / f"{name}-offsets")).awaitTermination()
        return sorted((r["batch"], r["doi"]) for r in store.records().collect())

    once = run("one", "2024-03-31")
    assert [d for _, d in once] == ["10.5555/a", "10.5555/b", "10.5555/c", "10.5555/d"]
    assert run("three", "2024-01-31") == [(0, "10.5555/a"), (0, "10.5555/b")]
    lost = replay / api.ReplayTransport.name(api.WORKS_URL, {
        "query": "w", "filter": "from-pub-date:2024-02-01,until-pub-date:2024-02-29,type:journal-article", "rows": 2, "cursor": "*", "select": api.WORK_FIELDS})
    kept = lost.read_text()
    lost.unlink()
    with pytest.raises(Exception):
        run("three", "2024-02-29")
    lost.write_text(kept)
    assert run("three", "2024-02-29") == [(0, "10.5555/a"), (0, "10.5555/b"), (1, "10.5555/c")]
    # Nothing new: no batch, and no request of an earlier day is made again.
    lost.unlink()
    assert len(run("three", "2024-02-29")) == 3
    assert run("three", "2024-03-31") == [(0, "10.5555/a"), (0, "10.5555/b"), (1, "10.5555/c"), (2, "10.5555/d")]
