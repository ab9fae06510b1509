"""Noisy categories to stable buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtloom import vocab
from courtloom.functions.arrays import let


def scrub_commas(text: Column) -> Column:
    """Commas to blanks, so that a value cannot split a comma-separated line."""
    return F.translate(text, ",", " ")


def court_name(court_system: Column) -> Column:
    """Part before the first dash, closing blank included."""
    return F.get(F.split(court_system, "-"), F.lit(0))


def raw_court_type(court_system: Column) -> Column:
    """Part after the first dash, up to the next; NULL without a dash."""
    return F.get(F.split(court_system, "-"), F.lit(1))


def _bucket(value: Column, buckets: dict[str, tuple[str, ...]]) -> Column:
    out = F.lit(None).cast("string")
    for name, members in buckets.items():
        out = F.coalesce(out, F.when(value.isin(*members), name))
    return F.coalesce(out, value)


def court_type_bucket(court_type: Column) -> Column:
    """Known court types to `criminal` or `traffic`, others as they are."""
    return _bucket(court_type, vocab.COURT_TYPE_BUCKETS)


def race_bucket(race: Column, comma_scrub_first: bool = False) -> Column:
    """Spellings to five buckets, others as they are.

    With `comma_scrub_first`, commas go before the lookup, and spellings that
    hold one are then never found.
    """
    return _bucket(scrub_commas(race) if comma_scrub_first else race, vocab.RACE_BUCKETS)


def outcome(disposition: Column) -> Column:
    """`guilty`, `not-guilty`, `in-process`, or the disposition itself when it is unknown.

    After a count number and a colon, whatever is neither guilty nor not guilty is in process.
    """

    def verdict(text: Column, in_process: Column, other: Column) -> Column:
        return (
            F.when(text.isin(*vocab.GUILTY), "guilty")
            .when(text.isin(*vocab.NOT_GUILTY), "not-guilty")
            .when(in_process, "in-process")
            .otherwise(other)
        )

    numbered = F.get(F.split(disposition, ":"), F.lit(1))
    return F.when(disposition.contains(":"), verdict(numbered, F.lit(True), numbered)).otherwise(
        verdict(disposition, disposition.isin(*vocab.IN_PROCESS), disposition)
    )


def families_of(court_system: Column) -> Column:
    """Court families a court system belongs to, as an array; unfolds in place of a join on a substring."""
    known = F.array(*map(F.lit, vocab.FAMILIES))
    excluded = F.create_map(*[F.lit(x) for item in vocab.EXCLUDED_PART.items() for x in item])

    def member(court: Column, family: Column) -> Column:
        shut_out = F.coalesce(court.contains(F.try_element_at(excluded, family)), F.lit(False))
        return court.contains(family) & ~shut_out

    return let(F.lower(court_system), lambda court: F.filter(known, lambda family: member(court, family)))
