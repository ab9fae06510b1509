"""Training extract and case types per court family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtloom.functions.buckets import families_of
from courtloom.functions.text import contains_ci, not_blank
from courtloom.operators.joins import salted_join

EXTRACT_COLUMNS = (
    "disposition court_system type filing_date race sex height weight state city zip description".split()
)


def defendants(parties: DataFrame) -> DataFrame:
    """Parties on the defending side."""
    return parties.where(contains_ci(F.col("type"), "defendant"))


def training_extract(
    cases: DataFrame,
    parties: DataFrame,
    charges: DataFrame,
    topic: str | None = None,
    lower_city: bool | None = None,
    keep_key: bool = False,
) -> DataFrame:
    """Complete charge x defendant rows of each case, 12 columns.

    Every filter sits on its own table, below the joins.  `topic` keeps charges
    whose description contains it, and then leaves the city as written.
    """
    lower_city = topic is None if lower_city is None else lower_city
    full_cases = cases.where(
        not_blank(F.col("court_system")) & not_blank(F.col("type")) & F.col("filing_date").isNotNull()
    ).select("case_id", "court_system", "type", "filing_date")
    people = defendants(parties).where(
        not_blank(F.col("race"))
        & not_blank(F.col("sex"))
        & F.col("height").isNotNull()
        & F.col("weight").isNotNull()
        & not_blank(F.col("state"))
        & not_blank(F.col("city"))
        & not_blank(F.col("zip"))
        & (F.length("zip") == 5)
    )
    people = people.select(
        "case_id",
        "race",
        "sex",
        "height",
        "weight",
        "state",
        (F.lower("city") if lower_city else F.col("city")).alias("city"),
        F.substring("zip", 1, 5).alias("zip"),
    )
    counts = charges.where(not_blank(F.col("disposition")) & not_blank(F.col("description")))
    if topic is not None:
        counts = counts.where(contains_ci(F.col("description"), topic))
    counts = counts.select("case_id", "disposition", "description")
    joined = salted_join(counts, full_cases.join(people, "case_id"), "case_id")
    return joined.select(*(["case_id"] if keep_key else []), *EXTRACT_COLUMNS)


def case_types_by_family(cases: DataFrame) -> DataFrame:
    """Distinct case types of each court family; blank types name nothing and are left out.

    Each case unfolds into its families in place, and repeats combine before the shuffle.
    """
    return (
        cases.where(not_blank(F.col("type")))
        .select(F.explode(families_of(F.col("court_system"))).alias("family"), "type")
        .distinct()
    )
