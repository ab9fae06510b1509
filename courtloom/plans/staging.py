"""Shared intermediates of a session: written once to the shared folder, read by every later plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtloom.session import work_path

_STAGED: dict[tuple[str, str, str], tuple[str, object]] = {}


def staged(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The named intermediate of a data folder, built on first use in this application."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STAGED:
        frame, path = build(), work_path(spark, name)
        frame.write.option("compression", "zstd").parquet(path)
        _STAGED[key] = (path, frame.schema)
    path, schema = _STAGED[key]
    return spark.read.schema(schema).parquet(path)
