from papersieve.operators import library


def test_copies_and_blocks(spark, monkeypatch):
    master = spark.createDataFrame([("a",)] * 7 + [("b",), (None,), ("z",)], "DOI string")
    meta = spark.createDataFrame([(0, "a", "x"), (1, "a", "y"), (2, "b", "z"), (3, None, "n"), (4, "c", "m")],
                                 "ingest_seq long, DOI string, title string")
    expected = sorted([("x", i) for i in range(1, 8)] + [("y", i) for i in range(1, 8)] + [("z", 1)])
    for limit in (100_000, 3, 7):
        monkeypatch.setattr(library, "COPIES_PER_BLOCK", limit)
        for unique in (None, "ingest_seq"):
            got = library.library_with_metadata(master, meta, unique=unique)
            assert sorted((r["title"], r["_copy"]) for r in got.collect()) == expected
