"""Joins that keep their shape when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtloom.session import durable

HEAVY_ROWS = 1_000_000
LOOKUP_ROWS = 100_000


def heavy_keys(df: DataFrame, key: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than `rows` rows; counts combine before the shuffle.

    There are fewer of them than rows of the frame divided by `rows`.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > rows).select(key)


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", rows: int = HEAVY_ROWS, salts: int = 64) -> DataFrame:
    """Equi-join on `key`, spreading keys that are heavy on the `left` over `salts` reducers.

    Rows of a heavy key get a salt from a hash of the whole row, which a re-run
    task repeats; the few matching right rows are copied to every salt.  Rows
    without a key match nothing and are spread the same way.  The salt
    in the join key also puts the join in a stage of its own, where adaptive
    execution can split what is still skewed, such as a row repeated many times.
    `how` may be inner, left, left_semi or left_anti.  The key column of `left` is
    read twice, so a `left` that is costly to compute should be written first.
    """
    heavy = heavy_keys(left, key, rows).withColumn("_heavy", F.lit(True))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    mark = lambda df: df.join(heavy, key, "left")
    spread = mark(left).withColumn(
        "_salt", F.when(F.col("_heavy") | F.col(key).isNull(), F.pmod(row_hash, F.lit(salts)).cast("int")).otherwise(0)
    )
    copied = mark(right).withColumn(
        "_salt",
        F.explode(F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    )
    return spread.drop("_heavy").join(copied.drop("_heavy"), [key, "_salt"], how).drop("_salt")


def lookup_join(df: DataFrame, dim: DataFrame, key: str, limit: int = LOOKUP_ROWS) -> DataFrame:
    """Left join to a dimension that is unique by `key`.

    The dimension is written once and counted: up to `limit` rows it is broadcast,
    beyond that the join is salted.
    """
    dim = durable(dim, "lookup")
    if dim.limit(limit + 1).count() <= limit:
        return df.join(F.broadcast(dim), key, "left")
    return salted_join(df, dim, key, "left")
