"""Titled blocks to table entries: routing, attribute names, value rules, attorneys and party types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom import vocab
from courtloom.functions.arrays import built_once, last_wins, let
from courtloom.functions.values import format_value
from courtloom.operators.blocks import with_blocks
from courtloom.sources.elements import html_items


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in mapping.items() for x in item])


def section_table(title: Column) -> Column:
    """Table a section title belongs to; NULL when the section is not stored."""
    return F.try_element_at(_literal_map(vocab.SECTION_TABLE), title)


def attribute_name(label: Column) -> Column:
    """Attribute of a label: from the map, else the label in snake case."""
    snake = F.replace(F.lower(label), F.lit(" "), F.lit("_"))
    return F.coalesce(F.try_element_at(_literal_map(vocab.LABEL_ATTRIBUTE), label), snake)


def rename_labels(pairs: Column) -> Column:
    """`label` becomes the attribute; of two labels of one attribute the later-introduced wins."""
    return last_wins(
        F.transform(pairs, lambda p: F.struct(attribute_name(p["label"]).alias("label"), p["value"].alias("value")))
    )


def party_type(title: Column) -> Column:
    """Type that a party section's title imposes, or NULL."""
    named = F.lit(False)
    for part in vocab.TITLED_PARTIES:
        named = named | title.contains(part)
    return F.when(named, F.replace(title, F.lit(vocab.TITLE_SUFFIX), F.lit("")))


def attorney_type(title: Column) -> Column:
    """Whom the attorneys of a section act for, from its title, or NULL."""
    return F.when(
        title.startswith(vocab.ATTORNEY_TITLE),
        F.substring(title, len(vocab.ATTORNEY_TITLE) + 1, F.length(title)),
    )


def is_attorney_entry(attrs: Column) -> Column:
    """An attorney section also lists parties; its attorneys have an appearance date or say so by name."""
    filled = F.coalesce(F.try_element_at(attrs, F.lit("appearance_date")) != "", F.lit(False))
    named = F.coalesce(F.lower(F.try_element_at(attrs, F.lit("name"))).contains("attorney"), F.lit(False))
    return filled | named


def relocated_type(table: Column, attrs: Column) -> Column:
    """Client of a party that is really an attorney, or NULL."""
    own = F.try_element_at(attrs, F.lit("type"))
    return F.when(
        (table == "parties") & F.lower(own).startswith(vocab.ATTORNEY_PARTY),
        F.substring(own, len(vocab.ATTORNEY_PARTY) + 1, F.length(own)),
    )


def _with_type(pairs: Column, imposed: Column) -> Column:
    retyped = F.flatten(
        F.array(
            F.filter(pairs, lambda p: p["label"] != "type"),
            F.array(F.struct(F.lit("type").alias("label"), imposed.alias("value"))),
        )
    )
    return F.when(imposed.isNotNull(), retyped).otherwise(pairs)


def page_entries(titled_blocks: Column, falsy_to_null: bool = True) -> Column:
    """`array<struct<table,title,moved,raw,attrs>>` of a page, in page order, moved attorneys last."""

    def entry(table: Column, title: Column, raw: Column) -> Column:
        def build(pairs: Column) -> Column:
            formatted = F.transform(
                pairs,
                lambda p: F.struct(
                    p["label"].alias("label"), format_value(p["label"], p["value"], falsy_to_null).alias("value")
                ),
            )
            imposed = F.coalesce(attorney_type(title), F.when(table == "parties", party_type(title)))
            return let(
                F.map_from_entries(_with_type(formatted, imposed)),
                lambda attrs: F.when(
                    ~title.startswith(vocab.ATTORNEY_TITLE) | is_attorney_entry(attrs),
                    let(
                        relocated_type(table, attrs),
                        lambda client: F.struct(
                            F.when(client.isNotNull(), "attorneys").otherwise(table).alias("table"),
                            title.alias("title"),
                            client.isNotNull().alias("moved"),
                            F.map_from_entries(pairs).alias("raw"),
                            F.when(
                                client.isNotNull(),
                                F.map_concat(
                                    F.map_filter(attrs, lambda k, v: k != "type"), F.create_map(F.lit("type"), client)
                                ),
                            )
                            .otherwise(attrs)
                            .alias("attrs"),
                        ),
                    ),
                ),
            )

        return let(rename_labels(raw), build)

    routed = F.filter(
        F.transform(
            titled_blocks,
            lambda b: F.struct(section_table(b["title"]).alias("table"), b["title"].alias("title"), b["entries"].alias("entries")),
        ),
        lambda b: b["table"].isNotNull(),
    )
    built = F.filter(
        F.flatten(
            F.transform(routed, lambda b: F.transform(b["entries"], lambda e: entry(b["table"], b["title"], e)))
        ),
        lambda e: e.isNotNull(),
    )
    return let(built, lambda es: F.flatten(F.array(F.filter(es, lambda e: ~e["moved"]), F.filter(es, lambda e: e["moved"]))))


@built_once
def _block_entries(falsy_to_null: bool) -> Column:
    return page_entries(F.col("blocks"), falsy_to_null)


def parse_pages(raw: DataFrame, falsy_to_null: bool = True, lossy_skips: bool = False) -> DataFrame:
    """Raw pages to one parsed row per page; narrow, so nothing moves between executors.

    Columns: `raw_case_id`, `page_hash`, `case_id` (from the page's first case
    entry, NULL when the page is nonsense), `entries`.  They leave through a
    generator, below which Catalyst pushes no filter, so each page is parsed once.
    """
    pages = raw.select(
        F.col("case_id").alias("raw_case_id"),
        F.xxhash64("html").alias("page_hash"),
        "html",
    )
    titled = with_blocks(pages, lossy_skips, html_items("html"), parts=("title", "entries"))
    parsed = titled.withColumn("entries", _block_entries(falsy_to_null))
    first_case = F.get(F.filter("entries", lambda e: e["table"] == "cases"), F.lit(0))
    case_id = F.try_element_at(first_case["attrs"], F.lit("case_id"))
    case_id = F.when(F.trim(case_id) != "", case_id)  # a blank number names no case
    once = F.array(F.struct(case_id.alias("case_id"), F.col("entries").alias("entries")))
    return parsed.select("raw_case_id", "page_hash", F.inline_outer(once))


def explode_entries(parsed: DataFrame) -> DataFrame:
    """One row per entry, with its place on the page."""
    return parsed.select(
        "raw_case_id", "page_hash", "case_id", F.posexplode_outer("entries").alias("entry_no", "entry")
    ).where("entry is not null").select("raw_case_id", "page_hash", "case_id", "entry_no", "entry.*")
