"""Incremental ingest: new files or new days of a search in, deduplicated against everything stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedup
from ..schema import SEQ
from ..session import cut_lineage, is_missing, work_path

# What a deduplication looks at.
KEY_COLUMNS = (SEQ, "doi", "title", "pub_date")
# Parts into which stored keys are dealt by their hash.
BUCKETS = 256
# Records of a micro-batch that ``number`` tells apart.
BATCH_ROWS = 1 << 40


def record_keys(records: DataFrame, cfg: dedup.DedupConfig | None) -> DataFrame:
    """``ingest_seq, key, bucket``: the DOI and the title key of each record, as far as others can share them."""
    table = dedup.key_table(records, cfg or dedup.DedupConfig()).filter("early is null")
    own = F.array(F.concat(F.lit("d:"), "doi"), F.when(~F.startswith("second", F.lit("#seq:")), F.concat(F.lit("t:"), "second")))
    keys = table.select(SEQ, F.explode(F.array_compact(own)).alias("key"))
    return keys.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))


@dataclass(frozen=True)
class KeyHistory:
    """The keys of accepted records as Parquet, one folder per micro-batch, dealt into buckets by their hash.

    A micro-batch reads only the buckets its own keys fall into, and of these only records that share a key with it: accepted records do not
    touch each other, so no other one can change what becomes of the batch.
    """

    spark: SparkSession
    path: str

    def _read(self, before: int) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path).filter(F.col("batch") < before)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            return None

    def sharing(self, keys: DataFrame, before: int) -> DataFrame:
        """The key columns of accepted records of earlier micro-batches that share one of the ``keys``."""
        stored = self._read(before)
        if stored is None:
            return self.spark.createDataFrame([], f"{SEQ} long, doi string, title string, pub_date string")
        touched = [r["bucket"] for r in keys.select("bucket").distinct().collect()]
        near = stored.filter(F.col("bucket").isin(touched)).join(keys.select("key").distinct(), "key", "left_semi")
        return near.select(*KEY_COLUMNS).dropDuplicates([SEQ])

    def add(self, records: DataFrame, cfg: dedup.DedupConfig | None, batch: int) -> None:
        rows = record_keys(records, cfg).join(records.select(*KEY_COLUMNS), SEQ)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={batch}")


@dataclass(frozen=True)
class RecordStore:
    """Accepted records as Parquet, one folder per micro-batch, and the history of their keys beside them.

    A micro-batch that runs again overwrites its own folders and looks only at
    earlier ones, so a restart after a failure yields the same store.
    """

    spark: SparkSession
    path: str

    @property
    def history(self) -> KeyHistory:
        return KeyHistory(self.spark, f"{self.path.rstrip('/')}_keys")

    def write(self, records: DataFrame, batch: int) -> None:
        records.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def accept(self, records: DataFrame, batch: int, cfg: dedup.DedupConfig | None) -> None:
        """Deduplicate a micro-batch against itself and the history, and store what is accepted with its keys."""
        held = self.history.sharing(record_keys(records, cfg), batch)
        # What was accepted before is read first and accepted again, so its DOIs, titles and dates are taken.
        keys = held.unionByName(records.select(*KEY_COLUMNS))
        kept = cut_lineage(dedup.deduplicate(keys, None, cfg).kept(records))
        self.history.add(kept, cfg, batch)
        self.write(kept, batch)

    def records(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def ingest(
    stream: DataFrame,
    store: RecordStore,
    checkpoint: str,
    cfg: dedup.DedupConfig | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    number: bool = False,
) -> StreamingQuery:
    """Process what has arrived, then stop; run it again for what arrives later.

    The stream's checkpoint remembers which files or days are done together with the
    stored records, so a resumed run neither repeats nor loses any. The result
    equals one batch over all input as long as it arrives in ingest order. ``number``: ``prepare`` numbers the records
    of a micro-batch from 0 on, and the batch's number goes before that.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        records = prepare(batch)
        if number:
            records = records.withColumn(SEQ, F.col(SEQ) + F.lit(batch_id * BATCH_ROWS))
        store.accept(cut_lineage(records), batch_id, cfg)

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_works(
    spark: SparkSession, options: dict, store: RecordStore, checkpoint: str, cfg: dedup.DedupConfig | None = None
) -> StreamingQuery:
    """Search for works of the days since the last run (see ``sources.api``), and ingest them in the order of searches."""
    from ..operators import ordering
    from ..sources import api, landed

    def prepare(found: DataFrame) -> DataFrame:
        rows = cut_lineage(found.select("query_ord", "unit", "position", "raw"))
        placed = ordering.number_rows(rows, [F.col("query_ord"), F.col("unit"), F.col("position")], SEQ)
        return landed.parse_items(placed.select(SEQ, "raw"), keep=(SEQ,))

    api.register(spark)
    stream = spark.readStream.format("work_search").options(**options).load()
    return ingest(stream, store, checkpoint, cfg, prepare, number=True)


# Portions in which the document table arrives.
ARRIVALS = 3


def drain_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Let the document table arrive in portions, ingest each when it is there, and return the stored keys."""
    from ..plans import tables as T

    documents = T.table(spark, sf_dir, "documents")
    source, offsets = work_path(spark, "arrivals"), work_path(spark, "offsets")
    store = RecordStore(spark, work_path(spark, "store"))
    cfg = dedup.DedupConfig(by_title=True, by_title_and_pub_date=True)
    cuts = documents.approxQuantile("doc_id", [i / ARRIVALS for i in range(1, ARRIVALS)], 0.01)
    portion = sum((F.coalesce(F.col("doc_id") > cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for number in range(ARRIVALS):
        documents.filter(portion == number).write.mode("append").parquet(source)
        stream = spark.readStream.schema(documents.schema).parquet(source)
        ingest(stream, store, offsets, cfg, T.records_of).awaitTermination()
    return store.records().select("ingest_seq", "doi", "title")
