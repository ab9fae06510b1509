"""Text and URL column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator control characters that general text tools also treat as blank.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def collapse_ws(text: Column) -> Column:
    """One blank between words, none at the ends; covers non-breaking and other Unicode blanks."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def prompt_label(text: Column, clean: Column | None = None) -> Column:
    """Label of a prompt: one closing colon, then one closing question mark, go before trimming.

    `clean` is the collapsed text where the caller has it already.
    """
    clean = collapse_ws(text) if clean is None else clean
    marks = F.when(text.endswith("?:"), 2).when(text.endswith(":") | text.endswith("?"), 1).otherwise(0)
    return F.trim(F.left(clean, F.length(clean) - marks))


def not_blank(text: Column) -> Column:
    """True where the text is neither NULL nor empty."""
    return F.nullif(text, F.lit("")).isNotNull()


def contains_ci(text: Column, part: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(text).contains(part.lower())


def url_case_id(url: Column) -> Column:
    """Value of the first query parameter, whatever its name; NULL where there is none."""
    return F.get(F.split(F.get(F.split(url, "&"), F.lit(0)), "="), F.lit(1))


def parse_ymd(text: Column) -> Column:
    """Date of a `YYYY/MM/DD` parameter, padding optional."""
    return F.try_to_date(text, "y/M/d")


def format_mdy(day: Column) -> Column:
    """Date as `M/D/YYYY` without padding."""
    return F.date_format(day, "M/d/yyyy")
