"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window is ``size`` consecutive words of an item (a shorter item is one window). A document holds
a window if all of its words follow each other there, so every word of a window is needed and one of them
is a sufficient prefix: the rarest in the corpus, by counts over all documents. The documents' words are
joined with those prefix words; the positional bound fixes where the window would begin, the
length bound that it ends within the document, and the window of the item's size at that place
is compared word by word. Both tests are part of the join condition, so only true occurrences leave it.

Texts are never shuffled: the words of the benchmark, a table that is given and small beside the corpus, are
sent to the documents where they take at most ``BROADCAST_BYTES``, by a count of their bytes. A larger
benchmark is joined by shuffling the single words with ``size - 1`` neighbours on each side.

Defined cases: null and empty texts have no words; items without id, text or words take no part; rows of one
item_id are one item; document rows are judged one by one (equal rows alike); an empty benchmark hits
nothing; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SIZE = 10
BROADCAST_BYTES = 64 << 20
# Contaminated documents (id, or hash of the text) that are sent to all tasks at most.
LISTED_BYTES = 16 << 20
# Everything ASCII but digits and small letters, after lower-casing.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case; all other letters as they are."""
    plain = F.length(text) == F.octet_length(text)
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(mapped)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), _GAPS, -1), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(item_id, window) without repeats."""
    words = items.select(F.col("item_id"), words_of(F.col("text")).alias("words")).filter(
        F.col("item_id").isNotNull() & (F.size("words") > 0)
    )
    last = F.greatest(F.size("words") - size, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, F.lit(size)))
    return words.select("item_id", F.explode(cut).alias("window")).distinct()


def _fits(table: DataFrame, size: Column) -> bool:
    return (table.select(F.sum(size).alias("bytes")).first()["bytes"] or 0) <= BROADCAST_BYTES


def _counted(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n): occurrences in all documents of the words of a vocabulary."""
    words = documents.select(F.explode(words_of(F.col("text"))).alias("word"))
    if _fits(vocabulary, F.octet_length("word") + 48):
        return words.join(F.broadcast(vocabulary), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    return words.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word", "left_semi")


def prefix_index(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(word, place, window_id, window): each window under its rarest word."""
    places = windows.select("window_id", F.posexplode("window").alias("place", "word"))
    ranked = places.join(counts, "word", "left").select(
        "window_id", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place").alias("rank")
    )
    rarest = ranked.groupBy("window_id").agg(F.min("rank").alias("rank"))
    return rarest.join(windows, "window_id").select(
        F.col("rank.word").alias("word"), F.col("rank.place").alias("place"), "window_id", "window"
    )


def occurrences(documents: DataFrame, index: DataFrame, size: int) -> DataFrame:
    """(doc_id, mark, start, n, window_id) of every window in every document."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    placed = rows.select("doc_id", "mark", "words", F.posexplode("words").alias("at", "word"))
    start = F.col("at") - F.col("place")
    n = F.size("window")
    if _fits(index, F.aggregate("window", F.lit(64), lambda a, w: a + F.octet_length(w) + 16)):
        index = F.broadcast(index.withColumnRenamed("word", "prefix"))
        # The slice of an array at a place below 1 is an error, so it is kept in bounds beside the tests.
        there = F.slice("words", F.greatest(start, F.lit(0)) + 1, n) == F.col("window")
        joined = placed.join(index, (F.col("word") == F.col("prefix")) & (start >= 0) & (start + n <= F.size("words")) & there)
    else:
        low = F.greatest(F.col("at") - (size - 1), F.lit(0))
        near = placed.select(
            "doc_id", "mark", "at", "word", low.alias("low"),
            F.slice("words", low + 1, F.col("at") - low + size).alias("near"),
        )
        index = index.withColumnRenamed("word", "prefix")
        there = F.slice("near", F.greatest(start - F.col("low"), F.lit(0)) + 1, n) == F.col("window")
        joined = near.join(index, (F.col("word") == F.col("prefix")) & (start >= F.col("low")) & there)
    return joined.select("doc_id", "mark", start.alias("start"), n.alias("n"), "window_id")


def covered(spans: Column) -> Column:
    """Words that lie in any of the spans (start, n), which are ordered by start."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))
    return F.aggregate(
        spans,
        begin,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["n"]).alias("end"),
            (a["hit"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["end"], s["start"]))).alias("hit"),
        ),
        lambda a: a["hit"],
    ).cast("long")


def find_windows(documents: DataFrame, items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """All occurrences, and (item_id, window_id)."""
    by_item = cut_lineage(item_windows(items, size))
    windows = cut_lineage(by_item.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()))
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    index = cut_lineage(prefix_index(windows, _counted(documents, vocabulary)))
    return occurrences(documents, index, size), by_item.join(windows, "window").select("item_id", "window_id")


def keep_clean(documents: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows, with all columns, that hold no window. Rows of one doc_id go together, rows without one each by its text."""
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    found, _ = find_windows(texts, items, size)
    mark = F.when(F.col("doc_id").isNull(), F.col("mark")).alias("_mark")
    listed = cut_lineage(found.select(F.col("doc_id").alias("_id"), mark).distinct())
    small = listed.count() * 48 <= LISTED_BYTES
    own = F.when(documents["doc_id"].isNull(), F.xxhash64(documents["text"].cast("string")))
    same = documents["doc_id"].eqNullSafe(F.col("_id")) & own.eqNullSafe(F.col("_mark"))
    return documents.join(F.broadcast(listed) if small else listed, same, "left_anti")


def decontaminate(documents: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and mark, a hash of the text) for each document row."""
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    found, named = find_windows(documents, items, size)
    spans = F.array_sort(F.collect_set(F.struct("start", "n")))
    per_doc = cut_lineage(
        found.groupBy("doc_id", "mark").agg(covered(spans).alias("n_hit"), F.collect_set("window_id").alias("windows"))
    )
    items_hit = per_doc.select("doc_id", "mark", F.explode("windows").alias("window_id")).join(named, "window_id")
    ids = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    items_hit = items_hit.groupBy("doc_id", "mark").agg(ids.alias("ids"))
    hits = per_doc.select("doc_id", "mark", "n_hit").alias("h").join(items_hit.alias("i"), _same("h", "i")).select(
        "h.doc_id", "h.mark", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
    )
    rows = documents.select("doc_id", F.xxhash64("text").alias("mark"), word_count(F.col("text")).alias("n_words"))
    none = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.alias("d").join(hits.alias("x"), _same("d", "x"), "left").select(
        "d.doc_id", "n_words", none.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (none > 0).alias("contaminated"), "d.mark",
    )


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))
