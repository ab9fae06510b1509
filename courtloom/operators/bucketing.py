"""Extract rows to labelled, bucketed feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtloom import vocab
from courtloom.functions import buckets
from courtloom.operators.joins import lookup_join, salted_join
from courtloom.session import durable

GENERAL = "outcome courttype courtname casetype race sex height weight state zip".split()
#: Stands for a missing date in the order of cases.
NO_DATE = "9999-12-31"
TOPICAL = "outcome casetype race sex height weight state zip".split()


def type_buckets(types: DataFrame) -> DataFrame:
    """One family per case type: the first in precedence of those that share it."""
    rank = F.array_position(F.array(*map(F.lit, vocab.FAMILIES)), F.col("family"))
    return types.groupBy("type").agg(F.min_by("family", rank).alias("family"))


def case_type_bucket(rows: DataFrame, types: DataFrame) -> DataFrame:
    """Adds `casetype`: the family of the row's type, or the type itself."""
    joined = lookup_join(rows, type_buckets(types), "type")
    return joined.withColumn("casetype", F.coalesce("family", "type")).drop("family")


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def carry_court_type(rows: DataFrame, cell_digits: int = 2) -> DataFrame:
    """Adds `courttype`; a court without a type takes that of the case before it.

    The order is filing date (cases without one come last), then a cell from the digest
    of the case id, the id and the court.  Rows reduce to one per case, date and court,
    so a heavy case counts once; every row of the input gives one row.  Values carry on
    three levels: inside a cell, over the cells of a day (at most 16^digits rows a
    window), over the days of the calendar (one row a day).
    """
    kind = buckets.court_type_bucket(buckets.raw_court_type(F.col("court_system")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    day = F.coalesce(F.col("filing_date"), F.lit(NO_DATE).cast("date"))
    rows = rows.withColumn("_row", F.concat_ws("\u0001", text("case_id"), day.cast("string"), text("court_system")))
    cases = (
        rows.select("_row", text("case_id").alias("case_id"), day.alias("filing_date"), text("court_system").alias("court"), kind.alias("kind"))
        .distinct()
        .withColumn("cell", F.left(F.md5("case_id"), F.lit(cell_digits)))
    )
    last = lambda column, window: F.last(column, ignorenulls=True).over(window)
    in_cell = Window.partitionBy("filing_date", "cell").orderBy("case_id", "court")
    known = F.col("kind").isNotNull()
    cells = cases.groupBy("filing_date", "cell").agg(
        F.max_by("kind", F.when(known, F.struct("case_id", "court"))).alias("cell_last")
    )
    days = cells.groupBy("filing_date").agg(
        F.max_by("cell_last", F.when(F.col("cell_last").isNotNull(), F.col("cell"))).alias("day_last")
    )
    day_carry = days.select("filing_date", last("day_last", _before(Window.orderBy("filing_date"))).alias("day_carry"))
    over_cells = _before(Window.partitionBy("filing_date").orderBy("cell"))
    carry = cells.select("filing_date", "cell", last("cell_last", over_cells).alias("cell_carry")).join(
        day_carry, "filing_date"
    )
    running = last("kind", in_cell.rowsBetween(Window.unboundedPreceding, 0))
    filled = (
        cases.select("_row", "filing_date", "cell", running.alias("running"))
        .join(carry, ["filing_date", "cell"])
        .select(
            "_row",
            F.coalesce("running", "cell_carry", "day_carry", F.lit(vocab.UNKNOWN_COURT_TYPE)).alias("courttype"),
        )
    )
    return salted_join(rows, filled, "_row").drop("_row")


def labelled_rows(extract: DataFrame, types: DataFrame, comma_scrub_first: bool = False) -> DataFrame:
    """Extract rows (with `case_id`) plus outcome and all buckets.

    The extract is written once: the carry reads it more than once, and its joins
    should not run again for that.
    """
    text = lambda c: buckets.scrub_commas(F.col(c)) if comma_scrub_first else F.col(c)
    if comma_scrub_first:
        scrubbed = "disposition court_system type race sex state zip".split()
        extract = extract.withColumns({c: text(c) for c in scrubbed})
    rows = case_type_bucket(carry_court_type(durable(extract, "extract")), types)
    return rows.withColumns(
        {
            "outcome": buckets.outcome(F.col("disposition")),
            "courtname": buckets.court_name(F.col("court_system")),
            "race": buckets.race_bucket(F.col("race")),
            "zip": F.substring("zip", 1, 5),
        }
    )


def topical_rows(extract: DataFrame, types: DataFrame, comma_scrub_first: bool = False) -> DataFrame:
    """As `labelled_rows` without the court columns, which topical sets do not use."""
    if comma_scrub_first:
        extract = extract.withColumns({c: buckets.scrub_commas(F.col(c)) for c in "disposition type race sex state zip".split()})
    return case_type_bucket(extract, types).withColumns(
        {
            "outcome": buckets.outcome(F.col("disposition")),
            "race": buckets.race_bucket(F.col("race")),
            "zip": F.substring("zip", 1, 5),
        }
    )


def decided(rows: DataFrame) -> DataFrame:
    """Rows with a verdict."""
    return rows.where(F.col("outcome").isin("guilty", "not-guilty"))


def in_process(rows: DataFrame) -> DataFrame:
    """Rows still open."""
    return rows.where(F.col("outcome") == "in-process")


def with_set(rows: DataFrame) -> DataFrame:
    """Rows of either set under a `bucket` column, for one partitioned write; unknown outcomes drop."""
    name = F.when(F.col("outcome").isin("guilty", "not-guilty"), "decided").when(
        F.col("outcome") == "in-process", "in_process"
    )
    return rows.withColumn("bucket", name).where("bucket is not null")
