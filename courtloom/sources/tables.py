"""Readers: Parquet folders, catalog tables, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtloom.schemas import RAW_SCHEMA


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw page store."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options) -> DataFrame:
    """A database table, read in `parts` parallel ranges of a numeric key."""
    return spark.read.options(**options).jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts)
