"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtloom.functions.arrays import let

#: Characters that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\\x20\\x09-\\x0D"
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder, read by Spark alone."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get by bytes, so that long texts do not pile up in one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def words(text: Column) -> Column:
    """Words of a text: runs of anything but blanks; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^{BLANKS}]+"), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Number of groups that keeps a group near `rows_per_task` rows, however many rows there are."""
    return max(1, -(-rows // rows_per_task))


def alike(a: Column, b: Column, percent: int, least_union: int = 0) -> Column:
    """Whether 100 * intersection >= percent * union of two sets; always true for unions below `least_union`.

    Both sets and their intersection are bound, since a filter would compute them anew for every mention.
    """

    def decide(s: Column) -> Column:
        shared = F.size(F.array_intersect(s["a"], s["b"]))
        return let(shared, lambda c: let(F.size(s["a"]) + F.size(s["b"]) - c, lambda u: (u < least_union) | (100 * c >= percent * u)))

    return let(F.struct(a.alias("a"), b.alias("b")), decide)


def fresh(taken, name: str) -> str:
    """`name`, lengthened by underscores until no column of `taken` has it, for helper columns beside a caller's."""
    while name in taken:
        name += "_"
    return name
