"""From parsed pages to the eight tables: what to parse, what to reject, what to store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from courtloom.functions import values
from courtloom.operators.joins import salted_join
from courtloom.operators.normalize import explode_entries
from courtloom.schemas import DATE_COLUMNS, FLAG_COLUMNS, INT_COLUMNS, MONEY_COLUMNS, TABLE_COLUMNS, TABLES, TERM_COLUMNS, table_schema


def unparsed(raw: DataFrame, cases: DataFrame) -> DataFrame:
    """Pages whose id has no stored case.

    Bucket both tables by `case_id` to run this without moving a page.
    """
    return raw.join(cases.select("case_id"), "case_id", "left_anti")


def page_slice(frame: DataFrame, key: str, offset: int, limit: int) -> DataFrame:
    """One page of work in key order. Only for looking around: jobs run over the whole frame."""
    return frame.orderBy(key).offset(offset).limit(limit)


def winners(parsed: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """One page per new case id: of copies the least raw id stays, ids stored already drop out.

    `min_by` combines copies before the shuffle, so an id carried by a third of
    all pages reaches its reducer as one row per input partition. The anti join
    then meets unique ids, already partitioned by `case_id`.
    """
    first = F.min_by(F.struct("raw_case_id", "page_hash", "entries"), F.struct("raw_case_id", "page_hash"))
    best = (
        parsed.where(F.col("case_id").isNotNull())
        .groupBy("case_id")
        .agg(first.alias("page"))
        .select("page.raw_case_id", "page.page_hash", "case_id", "page.entries")
    )
    return best if cases is None else best.join(cases.select("case_id"), "case_id", "left_anti")


def nonsense_rejects(parsed: DataFrame) -> DataFrame:
    """Pages that name no case."""
    return parsed.where(F.col("case_id").isNull()).select("raw_case_id", F.lit("nonsense").alias("reason"))


def duplicate_rejects(parsed: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """Pages whose case id is stored already or belongs to another page of this batch.

    Copies of a page are counted before anything moves; the one join that meets a
    repeated id is salted.
    """
    keys = parsed.where(F.col("case_id").isNotNull()).select("case_id", "raw_case_id", "page_hash")
    counted = keys.groupBy("case_id", "raw_case_id", "page_hash").agg(F.count("*").alias("copies"))
    best = keys.groupBy("case_id").agg(F.min(F.struct("raw_case_id", "page_hash")).alias("best"))
    if cases is not None:
        stored = cases.select("case_id", F.lit(True).alias("stored"))
        best = best.join(stored, "case_id", "left")
        best = best.select("case_id", F.when(F.col("stored").isNull(), F.col("best")).alias("best"))
    stays = F.coalesce(F.struct("raw_case_id", "page_hash") == F.col("best"), F.lit(False))
    return (
        salted_join(counted, best, "case_id")
        .withColumn("pages", F.col("copies") - stays.cast("int"))
        .where("pages > 0")
        .select("raw_case_id", "case_id", F.lit("duplicate").alias("reason"), "pages")
    )


def _untyped(attribute: Column, text: Column) -> Column:
    """Whether a text that is there gives a NULL in the typed column of its attribute."""
    typed = (
        F.when(attribute.isin(*DATE_COLUMNS), values.docket_date(text).isNotNull())
        .when(attribute.isin(*INT_COLUMNS), F.trim(text).try_cast("int").isNotNull())
        .when(attribute.isin(*MONEY_COLUMNS), values.amount(text).isNotNull())
        .when(attribute.isin(*TERM_COLUMNS), F.coalesce(values.term_months(text), values.term_days(text), values.term_hours(text)).isNotNull())
    )
    return (text != "") & ~F.coalesce(typed, ~attribute.isin(*DATE_COLUMNS, *INT_COLUMNS, *MONEY_COLUMNS, *TERM_COLUMNS))


def value_rejects(entries: DataFrame) -> DataFrame:
    """Values that a rule could not read or a typed column cannot hold, so they are NULL, or that no page text backed."""
    item = lambda key, value, read, by_rule: F.struct(key.alias("attribute"), value.alias("value"), read.alias("read"), F.lit(by_rule).alias("ruled"))
    ruled = F.transform(F.map_entries("raw"), lambda p: item(p["key"], p["value"], F.try_element_at("attrs", p["key"]), True))
    others = F.filter(F.map_entries("attrs"), lambda p: ~F.map_contains_key("raw", p["key"]))
    plain = F.transform(others, lambda p: item(p["key"], p["value"], p["value"], False))
    silent = F.col("p.attribute").isin(*FLAG_COLUMNS) | (F.col("p.attribute") == "injuries")
    unread = F.col("p.ruled") & F.col("p.read").isNull() & (F.col("p.value").isNull() | ~silent)
    return (
        entries.select("raw_case_id", "case_id", "table", "entry_no", F.explode(F.concat(ruled, plain)).alias("p"))
        .where(unread | F.coalesce(_untyped(F.col("p.attribute"), F.col("p.read")), F.lit(False)))
        .select("raw_case_id", "case_id", "table", "entry_no", "p.attribute", "p.value")
    )


def raw_after_rejects(raw: DataFrame, parsed: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """Raw store without rejected pages, matched by raw id and content; of exact copies of a page one stays.

    Only the winners' pages that occur more than once are brought together to drop their copies.
    """
    kept = winners(parsed, cases).select("raw_case_id", "page_hash")
    counted = parsed.groupBy("raw_case_id", "page_hash").agg(F.count("*").alias("copies"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    kept = kept.alias("k").join(counted.alias("n"), same("k.raw_case_id", "n.raw_case_id") & same("k.page_hash", "n.page_hash"))
    kept = kept.select(F.col("k.raw_case_id").alias("_raw"), F.col("k.page_hash").alias("_page"), "copies")
    pages = raw.withColumn("_hash", F.xxhash64("html"))
    chosen = lambda which: pages.join(kept.where(which), same("case_id", "_raw") & same("_hash", "_page"), "left_semi")
    return chosen("copies = 1").unionByName(chosen("copies > 1").dropDuplicates(["case_id", "_hash"])).drop("_hash")


def _stored(name: str) -> list[Column]:
    text = F.nullif(F.try_element_at("attrs", F.lit(name)), F.lit(""))
    if name in DATE_COLUMNS:
        return [values.docket_date(text).alias(name)]
    if name in INT_COLUMNS:
        return [F.trim(text).try_cast("int").alias(name)]
    if name in FLAG_COLUMNS:
        return [text.try_cast("boolean").alias(name)]
    if name in TERM_COLUMNS:
        parts = {"months": values.term_months, "days": values.term_days, "hours": values.term_hours}
        return [rule(text).alias(f"{name}_{part}") for part, rule in parts.items()]
    if name in MONEY_COLUMNS:
        return [text.alias(name), values.amount(text).alias(f"{name}_value")]
    return [text.alias(name)]


def to_table(entries: DataFrame, table: str) -> DataFrame:
    """Entries of one table as typed rows; unknown attributes drop, missing and empty ones are NULL."""
    columns = [c for name in TABLE_COLUMNS[table][1:] for c in _stored(name)]
    return entries.where(F.col("table") == table).select("case_id", *columns)


def to_long(entries: DataFrame) -> DataFrame:
    """Stored values as `(table, case_id, entry_no, column, value)`, text form, without NULLs."""
    stored = F.create_map(
        *[x for t in TABLES for x in (F.lit(t), F.array(*[F.lit(c) for c in TABLE_COLUMNS[t][1:]]))]
    )
    kept = F.filter(
        F.map_entries("attrs"),
        lambda a: (a["value"] != "") & F.array_contains(F.try_element_at(stored, F.col("table")), a["key"]),
    )
    return entries.select("table", "case_id", "entry_no", F.explode(kept).alias("a")).select(
        "table", "case_id", "entry_no", F.col("a.key").alias("column"), "a.value"
    )


def load_counts(entries: DataFrame) -> DataFrame:
    """Rows per table."""
    return entries.groupBy("table").agg(F.count("*").alias("n_rows"))


def eight_tables(entries: DataFrame) -> dict[str, DataFrame]:
    """All eight tables."""
    return {t: to_table(entries, t) for t in TABLES}


def _case_number(entries: Column) -> Column:
    """Number (from 1) of the first case entry of a page."""
    return F.array_position(F.transform(entries, lambda e: e["table"]), "cases")


def load(parsed: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """Entries to store: pages resolved to one per new case, then exploded.

    The first case entry of a page is the row of its case, so `cases` is unique by id.
    """
    best = winners(parsed, cases)
    first = _case_number(F.col("entries"))
    single = F.filter("entries", lambda e, i: (e["table"] != "cases") | (i + 1 == first))
    return explode_entries(best.withColumn("entries", single))


def extra_case_rejects(parsed: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """Case entries behind the first one of a stored page."""
    best = winners(parsed, cases).withColumn("_first", _case_number(F.col("entries")))
    rows = best.select("raw_case_id", "case_id", "_first", F.posexplode("entries").alias("entry_no", "entry"))
    extra = rows.where("entry.table = 'cases' AND entry_no + 1 > _first")
    return extra.select("raw_case_id", "case_id", F.lit("second case block").alias("reason"), "entry_no")


def stage_entries(entries: DataFrame, path: str) -> DataFrame:
    """Entries written once by table: the page parse runs one time for all tables and survives lost executors."""
    entries.write.mode("overwrite").partitionBy("table").parquet(path)
    return entries.sparkSession.read.schema(entries.schema).parquet(path)


def store_tables(staged: DataFrame, out: str, batch: int = 0) -> None:
    """Write all eight tables as one batch.

    A batch owns its folder in each table and a repeat replaces it.  The cases go
    last: a batch counts as loaded when they are there.
    """
    for table in sorted(TABLES, key=lambda t: t == "cases"):
        to_table(staged, table).write.mode("overwrite").parquet(f"{out}/{table}/batch={batch}")


def read_table(spark, out: str, table: str) -> DataFrame:
    """A stored table, all batches."""
    return spark.read.schema(table_schema(table).add("batch", IntegerType())).parquet(f"{out}/{table}")
