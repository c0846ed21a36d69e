import random

import pytest

from papersieve.operators import dedup, joins

SCHEMA = "ingest_seq long, doi string, title string, pub_date string"
FULL = dict(by_title=True, by_title_and_pub_date=True)


def sequential(rows, known, by_title, by_date):
    """Plain restatement of the rule on already normalised keys."""
    dois, titles, dated, out = set(), set(), set(), {}
    for seq, doi, title, day in sorted(rows):
        if not doi:
            out[seq] = dedup.NO_DOI
        elif not (doi.startswith("10.5555/") and len(doi) >= 8):
            out[seq] = dedup.INVALID_DOI
        elif doi in dois:
            out[seq] = dedup.IN_BATCH
        elif doi in known:
            out[seq] = dedup.IN_MASTER
        elif by_date and title and day and (title, day) in dated:
            out[seq] = dedup.TITLE_DATE
        elif by_title and title and title in titles:
            out[seq] = dedup.TITLE
        else:
            out[seq] = dedup.KEPT
            dois.add(doi)
            if title:
                titles.add(title)
                if day:
                    dated.add((title, day))
    return out


def labels(spark, rows, known=(), **cfg):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table = spark.createDataFrame([(k,) for k in known], "doi string") if known else None
    result = dedup.deduplicate(frame, table, dedup.DedupConfig(**cfg))
    return {r["ingest_seq"]: r["reason"] for r in result.labels.collect()}, result, frame


def random_rows(seed, n, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        doi = "10.5555/hot" if rng.random() < hot else f"10.5555/{rng.randrange(n // 2)}"
        doi = rng.choice([doi] * 18 + ["", "bad"])
        title = rng.choice(["", f"title {rng.randrange(n // 3)}", f"title {rng.randrange(n // 3)}"])
        rows.append((seq * 7, doi, title, rng.choice(["", "2024-01", "2024-02"])))
    return rows


def test_golden_table(spark):
    rows = [
        (0, "10.5555/a", "Title one here", ""),
        (1, "https://doi.org/10.5555/A", "Title two here", ""),
        (2, "10.5555/b", "Title two here", "2024-3"),
        (3, "10.5555/c", "title TWO, here!", "2024-Mar"),
        (4, "10.5555/k", "Title four", ""),
        (5, "", "Title five", ""),
        (6, "bad-doi", "Title six", ""),
        (7, "10.5555/d", "", ""),
        (8, "10.5555/e", "Title two here", "2023"),
    ]
    got, result, frame = labels(spark, rows, ["10.5555/k"], **FULL)
    assert got == {
        0: "kept", 1: dedup.IN_BATCH, 2: "kept", 3: dedup.TITLE_DATE, 4: dedup.IN_MASTER,
        5: dedup.NO_DOI, 6: dedup.INVALID_DOI, 7: "kept", 8: dedup.TITLE,
    }
    kept = result.kept(frame).orderBy("ingest_seq").collect()
    assert [(r["ingest_seq"], r["doi"]) for r in kept] == [(0, "10.5555/a"), (2, "10.5555/b"), (7, "10.5555/d")]
    stats = result.stats()
    assert stats["total_raw"] == 9 == stats["new_count"] + sum(stats[r] for r in dedup.REASONS)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("by_title,by_date", [(True, True), (True, False), (False, True), (False, False)])
def test_equals_sequential(spark, seed, by_title, by_date):
    rows = random_rows(seed, 600)
    known = {f"10.5555/{i}" for i in range(0, 300, 9)}
    got, _, _ = labels(spark, rows, sorted(known), by_title=by_title, by_title_and_pub_date=by_date)
    assert got == sequential(rows, known, by_title, by_date)


def test_hot_doi_takes_several_rounds(spark):
    rows = random_rows(5, 500, hot=0.35)
    known = {"10.5555/1", "10.5555/2"}
    got, result, _ = labels(spark, rows, sorted(known), **FULL)
    assert got == sequential(rows, known, True, True)
    assert result.rounds > 1


def chain(n, start=0):
    # Each row shares a DOI with the one before and a title with the one after.
    return [(start + i, f"10.5555/{start}.{i // 2}", f"chain {start} {(i + 1) // 2}", "") for i in range(n)]


def test_long_chains_end_in_few_rounds(spark):
    rows = chain(10_000) + chain(30, 20_000) + [(30_000 + r[0], *r[1:]) for r in random_rows(4, 300)]
    got, result, _ = labels(spark, rows, **FULL)
    assert got == sequential(rows, set(), True, True)
    assert result.rounds < 10


def test_large_components_go_on_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(dedup, "IN_ORDER", 8)
    monkeypatch.setattr(dedup, "ROUNDS", 3)
    rows = chain(26) + chain(6, 100)
    got, result, _ = labels(spark, rows, **FULL)
    assert got == sequential(rows, set(), True, True)
    assert result.rounds > 4


def test_no_stage_of_the_labels_is_a_single_task(spark):
    frame = spark.createDataFrame(random_rows(3, 200), SCHEMA).repartition(3)
    plan = dedup.deduplicate(frame, None, dedup.DedupConfig(**FULL)).labels._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Coalesce" not in plan and "InPandas" not in plan


def test_idempotent(spark):
    got, result, frame = labels(spark, random_rows(9, 300), **FULL)
    again = dedup.deduplicate(result.kept(frame), None, dedup.DedupConfig(**FULL)).reason_counts().collect()
    assert [r["reason"] for r in again] == ["kept"]


def test_invalid_dois_can_stay(spark):
    rows = [(0, "weird id", "", ""), (1, "weird id", "", ""), (2, "", "", "")]
    got, _, _ = labels(spark, rows, skip_invalid_doi=False)
    assert got == {0: "kept", 1: dedup.IN_BATCH, 2: dedup.NO_DOI}


def test_hot_key_is_split_by_the_planner(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(40_000).selectExpr("id AS ingest_seq", "if(id % 3 = 0, concat('k', id), 'hot') AS key", "sha2(cast(id AS string), 256) AS pad")
        dim = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", None)], "key string, v int")
        found = joins.lookup(rows.repartition(8), dim, "key")
        assert found.filter("v = 1").count() == 26_666
        full = joins.lookup(rows.repartition(8), dim, "key")
        full.collect()
        assert "skew=true" in full._jdf.queryExecution().executedPlan().toString()
        left = joins.exclude(rows.repartition(8), dim, "key")
        assert left.count() == 40_000 - 26_666 - 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_keep_first_and_last(spark):
    frame = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, "b")], "ingest_seq long, k string")
    assert {r[0] for r in dedup.keep_first(frame, frame["k"]).collect()} == {1, 2}
    assert {r[0] for r in dedup.keep_last(frame, frame["k"]).collect()} == {3, 5}
