"""Session helpers: a tuned builder and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library wants. Sizes are per task, so they hold for
# eight local threads as well as for thousands of executors.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(app: str = "papersieve", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which may start in another folder or on another machine."""
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="papersieve-"), "papersieve.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only where nobody set it does a local
    session get a temporary folder, and a cluster session a folder beside the
    warehouse (which is shared by definition).
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if active is not None:
        return active.rstrip("/")
    if context.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp" if os.path.isdir("/tmp") else None)
    else:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_papersieve_work"
    context.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a result as a table in the shared folder and go on from there.

    It survives the loss of executors like a reliable checkpoint does, is far
    smaller than serialised rows, and later steps read only the columns they use.
    """
    path = work_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because nothing is there; any other failure must not pass for an empty table."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
