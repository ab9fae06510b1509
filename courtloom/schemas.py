"""The eight docket tables: stored columns, types, and schemas of the frames in between."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_SCHEMA = "case_id string, html string"

# Columns of the stored tables, in order.
TABLE_COLUMNS = {
    "cases": "case_id title court_system type filing_date status disposition disposition_date violation_county "
    "violation_date".split(),
    "parties": "case_id name type bus_org_name agency_name race sex height weight dob address city state zip".split(),
    "attorneys": "case_id name type appearance_date removal_date practice_name address city state zip".split(),
    "events": "case_id type date time result result_date".split(),
    "charges": "case_id statute_code description offense_date_from offense_date_to class amended_date cjis_code "
    "probable_cause victim_age speed_limit recorded_speed location_stopped accident_contribution injuries "
    "property_damage seatbelts_used mandatory_court_appearance vehicle_tag state plea plea_date disposition "
    "disposition_date jail_extreme_punishment jail_term jail_suspended_term jail_unsuspended_term probation_term "
    "probation_supervised_term probation_unsupervised_term fine_amt fine_suspended_amt fine_restitution_amt fine_due "
    "fine_first_pmt_due cws_hours cws_deadline cws_location cws_date".split(),
    "documents": "case_id name filing_date".split(),
    "judgements": "case_id against in_favor_of type date interest amt".split(),
    "complaints": "case_id type against status status_date filing_date amt".split(),
}

DATE_COLUMNS = frozenset(
    {c for cols in TABLE_COLUMNS.values() for c in cols if "date" in c} | {"dob"}
)
INT_COLUMNS = frozenset({"height", "weight", "injuries"})
FLAG_COLUMNS = frozenset(
    "probable_cause accident_contribution property_damage seatbelts_used mandatory_court_appearance".split()
)
TERM_COLUMNS = frozenset(c for c in TABLE_COLUMNS["charges"] if c.endswith("_term"))
MONEY_COLUMNS = frozenset({"amt", "fine_amt", "fine_suspended_amt", "fine_restitution_amt"})


def column_fields(name: str) -> list[T.StructField]:
    """Stored fields of one column. Terms become three integers, money keeps its text beside a decimal."""
    if name in DATE_COLUMNS:
        return [T.StructField(name, T.DateType())]
    if name in INT_COLUMNS:
        return [T.StructField(name, T.IntegerType())]
    if name in FLAG_COLUMNS:
        return [T.StructField(name, T.BooleanType())]
    if name in TERM_COLUMNS:
        return [T.StructField(f"{name}_{part}", T.IntegerType()) for part in ("months", "days", "hours")]
    if name in MONEY_COLUMNS:
        return [T.StructField(name, T.StringType()), T.StructField(f"{name}_value", T.DecimalType(18, 2))]
    return [T.StructField(name, T.StringType())]


def table_schema(table: str) -> T.StructType:
    """Stored schema of a table."""
    return T.StructType([f for c in TABLE_COLUMNS[table] for f in column_fields(c)])


TABLES = tuple(TABLE_COLUMNS)
