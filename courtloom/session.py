"""Session defaults and durable intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Raw pages are fat rows: small Arrow batches keep a Python worker's memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; leave `master` unset on a cluster."""
    builder = SparkSession.builder.appName("courtloom")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local session that names none, such as a test, gets one of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _OWN_DIRS:
        _OWN_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _OWN_DIRS[context.applicationId]


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/courtloom-{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: cuts lineage and survives executor loss."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over all cores by a unique key, ahead of work that costs far more than the rows weigh.

    The count is explicit because adaptive execution would merge such light partitions again.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, key)
