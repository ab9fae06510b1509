"""Value rules of the docket attributes. Each leaves NULL and empty text alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtloom import vocab
from courtloom.functions.arrays import let

DIGITS = "^[0-9]+$"


def _filled(value: Column, rule: Column) -> Column:
    return F.when(value != "", rule).otherwise(value)


def height_inches(value: Column) -> Column:
    """`5'10"` to `70`. A lone `6"` is read as feet; a plain number stays; junk becomes NULL."""

    def inches(parts: Column) -> Column:
        def whole(n: int) -> Column:
            part = F.coalesce(F.get(parts, F.lit(n)), F.lit(""))
            return F.when(part == "", 0).otherwise(F.trim(part).try_cast("int"))

        return (whole(0) * 12 + whole(1)).cast("string")

    split_marks = F.split(F.translate(value, '"', "'"), "'")
    return _filled(value, F.when(value.rlike("['\"]"), let(split_marks, inches)).otherwise(value))


def sex_code(value: Column) -> Column:
    """First letter, upper case."""
    return _filled(value, F.left(F.upper(value), F.lit(1)))


def full_date_text(value: Column) -> Column:
    """`MM/YYYY` to `MM/01/YYYY`; a text without a slash has no date and becomes NULL."""
    return _filled(
        value,
        let(
            F.split(value, "/"),
            lambda parts: F.when(F.size(parts) >= 3, value).when(
                F.size(parts) == 2, F.concat(F.get(parts, F.lit(0)), F.lit("/01/"), F.get(parts, F.lit(1)))
            ),
        ),
    )


def docket_date(value: Column) -> Column:
    """Typed date of a repaired date text."""
    return F.try_to_date(value, "M/d/y")


def flag_text(value: Column) -> Column:
    """`true` for yes words in any case, else `false`."""
    return _filled(value, F.lower(value).isin(*vocab.YES_WORDS).cast("string"))


def injuries_text(value: Column, falsy_to_null: bool = True) -> Column:
    """Count of injuries; wording that is not a number means none."""
    none = F.lit(None).cast("string") if falsy_to_null else F.lit("0")
    return _filled(value, F.when(value.rlike(DIGITS), value).otherwise(none))


def term_text(years: Column, months: Column, days: Column, hours: Column) -> Column:
    """`Y-M D H:00:00`. Blank parts count 0; more than twelve months carry into years."""
    zero = F.lit("0")
    y, m = F.coalesce(years, zero), F.coalesce(months, zero)
    carry = y.rlike(DIGITS) & m.rlike(DIGITS) & (m.try_cast("int") > 12)
    total_years = y.try_cast("int") + F.floor(m.try_cast("int") / 12).cast("int")
    return F.concat(
        F.when(carry, total_years.cast("string")).otherwise(y),
        F.lit("-"),
        F.when(carry, (m.try_cast("int") % 12).cast("string")).otherwise(m),
        F.lit(" "),
        F.coalesce(days, zero),
        F.lit(" "),
        F.coalesce(hours, zero),
        F.lit(":00:00"),
    )


TERM = r"^([0-9]+)-([0-9]+) ([0-9]+) ([0-9]+):00:00$"


def term_months(value: Column) -> Column:
    """Whole months of a term text."""
    return F.regexp_extract(value, TERM, 1).try_cast("int") * 12 + F.regexp_extract(value, TERM, 2).try_cast("int")


def term_days(value: Column) -> Column:
    """Days of a term text."""
    return F.regexp_extract(value, TERM, 3).try_cast("int")


def term_hours(value: Column) -> Column:
    """Hours of a term text."""
    return F.regexp_extract(value, TERM, 4).try_cast("int")


def amount(value: Column) -> Column:
    """Typed companion of a money text."""
    return F.regexp_replace(value, "[$,]", "").try_cast("decimal(18,2)")


def format_value(attribute: Column, value: Column, falsy_to_null: bool = True) -> Column:
    """The rule that belongs to an attribute, applied to its value.

    With `falsy_to_null`, false flags are stored as NULL, as an empty text is.
    """
    flag = flag_text(value)
    is_date = attribute.contains("date") | (attribute == "dob")
    return (
        F.when(attribute == "height", height_inches(value))
        .when(attribute == "sex", sex_code(value))
        .when(is_date, full_date_text(value))
        .when(attribute.isin(*vocab.FLAG_ATTRIBUTES), F.nullif(flag, F.lit("false")) if falsy_to_null else flag)
        .when(attribute == "injuries", injuries_text(value, falsy_to_null))
        .otherwise(value)
    )
