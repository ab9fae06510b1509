"""One query per operator, over the sample tables. Each takes `(spark, folder)` and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtloom.functions import buckets, text, values
from courtloom.operators import blocks, bucketing, extract, frontier, load, model, normalize
from courtloom.plans.staging import staged
from courtloom.schemas import TABLES
from courtloom.session import work_path
from courtloom.sources import demo, files
from courtloom.sources.elements import html_elements, html_items
from courtloom.sources.tables import parquet
from courtloom.streaming import incremental

QUERIES = {}
TOPIC = "ring"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Dates, flags and decimals as text, which every engine prints alike."""
    as_text = (T.DateType, T.BooleanType, T.DecimalType)
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, as_text) else F.col(f.name) for f in df.schema]
    )


# Shared inputs.


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return staged(spark, folder, "raw", lambda: demo.raw_pages(spark, folder))


def _spans(spark, folder) -> DataFrame:
    def build():
        pages = _raw(spark, folder).select(F.col("case_id").alias("raw_case_id"), html_items("html").alias("items"))
        return blocks.with_spans(pages).select("raw_case_id", "spans", "kept")

    return staged(spark, folder, "spans", build)


def _blocks(spark, folder) -> DataFrame:
    def build():
        pages = _raw(spark, folder).select(F.col("case_id").alias("raw_case_id"), "html")
        return blocks.with_blocks(pages, page_items=html_items("html")).drop("html")

    return staged(spark, folder, "blocks", build)


def _parsed(spark, folder) -> DataFrame:
    return staged(spark, folder, "parsed", lambda: normalize.parse_pages(_raw(spark, folder)))


def _entries(spark, folder) -> DataFrame:
    return staged(spark, folder, "entries", lambda: load.load(_parsed(spark, folder)))


def _docket(spark, folder):
    return [demo.view(spark, folder, f"docket_{t}") for t in ("cases", "parties", "charges")]


def _extract(spark, folder, topic=None) -> DataFrame:
    return extract.training_extract(*_docket(spark, folder), topic=topic, keep_key=True)


def _types(spark, folder) -> DataFrame:
    return extract.case_types_by_family(demo.view(spark, folder, "docket_cases"))


def _general(spark, folder) -> DataFrame:
    return bucketing.labelled_rows(_extract(spark, folder), _types(spark, folder))


def _topical(spark, folder) -> DataFrame:
    return bucketing.topical_rows(_extract(spark, folder, TOPIC), _types(spark, folder))


def _result_pages(spark, folder) -> DataFrame:
    """Result pages: the web pages with a results table and page links set in; every third is a sub page."""
    k = F.col("page_id")
    link = lambda i: F.concat(
        F.lit('<tr><td><a href="'),
        F.when(i % 4 == 3, F.lit("inquiry-results.jis?sort="))
        .when(i % 7 == 6, F.lit("inquiry-detail.jis?case"))
        .otherwise(F.lit("inquiry-detail.jis?caseId=")),
        ((k * 37 + i) % 15013).cast("string"),
        F.lit('&amp;loc=2">case</a></td></tr>'),
    )
    count = (k % 9).cast("int")
    rows = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.when(i < count, link(i)).otherwise("")), "")
    rows = F.when(k % 7 == 6, F.replace(rows, F.lit("caseId="), F.lit("case-"))).otherwise(rows)
    further = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.lit(4)),
            lambda i: F.concat(F.lit('<a href="/results?page='), (i % 3).cast("string"), F.lit('">next</a>')),
        ),
        " ",
    )
    table = F.concat(F.lit('<table class="wide results">'), rows, F.lit('</table><span class="pagelinks">'), further, F.lit("</span>"))
    return parquet(spark, folder, "pages").select(
        "page_id",
        (k % 3 == 2).alias("is_sub_page"),
        F.when(k % 10 == 4, 503).otherwise(200).alias("status"),
        F.concat(F.col("html"), table).alias("html"),
    )


def _links(spark, folder) -> DataFrame:
    def build():
        pages = frontier.with_page_links(frontier.answered(_result_pages(spark, folder)))
        return frontier.explode_links(pages, "case_links", "page_id")

    return staged(spark, folder, "links", build)


def _case_links(spark, folder) -> DataFrame:
    return frontier.with_case_id(frontier.drop_sort_links(_links(spark, folder)))


def _stored_links(spark, folder) -> DataFrame:
    return parquet(spark, folder, "lineitem").select(F.col("l_orderkey").cast("string").alias("case_id")).distinct()


# Scans and sinks.


@query
def scan_raw_pages(spark, folder):
    return _raw(spark, folder).select("case_id", F.col("html").contains("Case Number").cast("string").alias("names_case"))


@query
def csv_pipe_roundtrip(spark, folder):
    rows = extract.training_extract(*_docket(spark, folder))
    path = work_path(spark, "extract")
    files.write_csv(rows, path)
    return plain(files.read_csv(spark, path, rows.schema))


@query
def csv_typed_roundtrip(spark, folder):
    rows = bucketing.decided(_general(spark, folder)).select(*bucketing.GENERAL)
    path = work_path(spark, "features")
    files.write_csv(rows, path, sep=",")
    return files.read_csv(spark, path, rows.schema, sep=",")


@query
def case_types_json(spark, folder):
    path = work_path(spark, "types")
    files.types_json(_types(spark, folder)).write.text(path)
    return files.read_types_json(spark, path)


# Frontier.


@query
def date_spine_asc(spark, folder):
    start = F.to_date("o_orderdate")
    orders = parquet(spark, folder, "orders").select("o_orderkey", start.alias("a"))
    days = frontier.date_spine(F.col("a"), F.date_add("a", (F.col("o_orderkey") % 4).cast("int")))
    return plain(orders.select("o_orderkey", days.alias("day")))


@query
def date_spine_desc(spark, folder):
    start = F.to_date("o_orderdate")
    orders = parquet(spark, folder, "orders").select("o_orderkey", start.alias("a"))
    back = F.sequence(F.col("a"), F.date_sub("a", (F.col("o_orderkey") % 4).cast("int")))
    return plain(orders.select("o_orderkey", F.posexplode(back).alias("step", "day")))


@query
def date_parse_format(spark, folder):
    day = F.to_date("o_orderdate")
    written = F.concat_ws("/", F.year(day), F.month(day), F.dayofmonth(day))
    orders = parquet(spark, folder, "orders").select("o_orderkey", written.alias("written"))
    parsed = text.parse_ymd(F.col("written"))
    return plain(orders.select("o_orderkey", parsed.alias("day"), text.format_mdy(parsed).alias("form_date")))


@query
def search_grid(spark, folder):
    days = parquet(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    grid = frontier.search_grid(days)
    return grid.groupBy("filing_date", "company_label", "court_label").agg(
        F.count("*").alias("n_searches"),
        F.min("last_name").alias("first_letter"),
        F.max("last_name").alias("last_letter"),
        F.countDistinct("site").alias("n_sites"),
    )


@query
def page_links(spark, folder):
    return _links(spark, folder)


@query
def page_links_filtered(spark, folder):
    return frontier.drop_sort_links(_links(spark, folder))


@query
def url_case_id(spark, folder):
    links = parquet(spark, folder, "pages").select("page_id", "url")
    return frontier.with_case_id(links, "url").select("page_id", "case_id")


@query
def frontier_unseen(spark, folder):
    return frontier.unseen(_case_links(spark, folder), _stored_links(spark, folder)).select("page_id", "pos", "case_id")


@query
def frontier_seen(spark, folder):
    return frontier.seen(_case_links(spark, folder), _stored_links(spark, folder)).select("page_id", "pos", "case_id")


@query
def pagination_links(spark, folder):
    pages = frontier.with_page_links(frontier.answered(_result_pages(spark, folder)))
    return frontier.pagination(pages, "page_id")


@query
def retry_queue(spark, folder):
    return frontier.retry_queue(_result_pages(spark, folder)).select("page_id", "status")


# Pages to key/value blocks.


@query
def web_elements(spark, folder):
    pages = parquet(spark, folder, "pages")
    found = pages.select("page_id", F.explode_outer(html_elements("html", ("a", "h1", "nav", "title"))).alias("e"))
    return found.groupBy("page_id", "e.tag", "e.parent").agg(F.count("*").alias("n_elements"))


@query
def html_elements_text(spark, folder):
    pages = parquet(spark, folder, "pages")
    found = pages.select("page_id", F.explode_outer(html_elements("html", ("a", "h1"))).alias("e"))
    return found.select("page_id", "e.pos", "e.tag", "e.parent", "e.text")


QUERIES["html_elements"] = QUERIES.pop("html_elements_text")


def _pair_rows(spark, folder, field):
    found = _blocks(spark, folder).select("raw_case_id", F.explode_outer("blocks").alias("b"))
    return found.select("raw_case_id", "b.title", F.explode_outer(f"b.{field}").alias("p"))


@query
def doc_kv_pairs(spark, folder):
    rows = _pair_rows(spark, folder, "pairs").where("p is not null")
    return rows.select("raw_case_id", "title", "p.label", "p.value")


@query
def doc_kv_last_wins(spark, folder):
    rows = _pair_rows(spark, folder, "entries").select("raw_case_id", "title", F.explode_outer("p").alias("p"))
    return rows.where("p is not null").select("raw_case_id", "title", "p.label", "p.value")


@query
def doc_blocks(spark, folder):
    per_title = _blocks(spark, folder).select("raw_case_id", F.explode_outer("blocks").alias("b"))
    return (
        per_title.groupBy("raw_case_id", "b.title")
        .agg(F.sum(F.size("b.entries")).alias("n_entries"))
        .where("n_entries > 0")
    )


def _kept(spark, folder, kind):
    found = _spans(spark, folder).select("raw_case_id", F.explode_outer("kept").alias("s"))
    return found.where(F.col("s.kind") == kind)


@query
def statute_code(spark, folder):
    return _kept(spark, folder, "statute").select("raw_case_id", F.col("s.text").alias("code"))


@query
def term_interval(spark, folder):
    term = F.col("s.text")
    return _kept(spark, folder, "term").select(
        "raw_case_id",
        F.col("s.label").alias("label"),
        term.alias("term"),
        values.term_months(term).alias("months"),
        values.term_days(term).alias("days"),
        values.term_hours(term).alias("hours"),
    )


@query
def event_table_rows(spark, folder):
    rows = _kept(spark, folder, "event table").select("raw_case_id", F.explode_outer("s.rows").alias("r"))
    cell = lambda n: F.map_from_entries("r")[n]
    return rows.where("r is not null").select(
        "raw_case_id", cell("Event Type").alias("event_type"), cell("Event Date").alias("event_date")
    )


@query
def anchor_intervals(spark, folder):
    return _spans(spark, folder).select("raw_case_id", F.size("spans").alias("n_spans"), F.size("kept").alias("n_kept"))


@query
def whitespace_norm(spark, folder):
    clean = text.collapse_ws(F.col("text"))
    docs = parquet(spark, folder, "documents").select("doc_id", clean.alias("clean"))
    return docs.select("doc_id", F.length("clean").alias("n_clean"), F.md5("clean").alias("digest"))


@query
def prompt_norm(spark, folder):
    k = F.col("p_partkey")
    tail = F.when(k % 5 == 0, ":").when(k % 5 == 1, "?:").when(k % 5 == 2, ": ").when(k % 5 == 3, " ?").otherwise("::")
    parts = parquet(spark, folder, "part").select("p_partkey", F.concat("p_name", tail).alias("prompt"))
    return parts.select("p_partkey", text.prompt_label(F.col("prompt")).alias("label"))


# Sections and attributes.


def _all_entries(spark, folder):
    return normalize.explode_entries(_parsed(spark, folder))


@query
def section_route(spark, folder):
    return _all_entries(spark, folder).groupBy("table", "title").agg(F.count("*").alias("n_entries"))


@query
def attr_rename(spark, folder):
    labels = F.array(*map(F.lit, ("Case Number", "Attorney's Firm", "Vehicle Tag", "Amount of Judgement")))
    k = F.col("p_partkey")
    label = F.coalesce(F.get(labels, (k % 6).cast("int")), F.col("p_type"))
    parts = parquet(spark, folder, "part").select("p_partkey", label.alias("label"))
    return parts.select("p_partkey", normalize.attribute_name(F.col("label")).alias("attribute"))


@query
def attr_collision(spark, folder):
    return _parsed(spark, folder).select("raw_case_id", "case_id")


@query
def height_inches(spark, folder):
    k = F.col("c_custkey")
    feet, inches = (k % 7).cast("string"), (k % 12).cast("string")
    written = (
        F.when(k % 6 == 0, F.concat(feet, F.lit("'"), inches, F.lit('"')))
        .when(k % 6 == 1, F.concat(feet, F.lit("' "), inches))
        .when(k % 6 == 2, F.concat(inches, F.lit('"')))
        .when(k % 6 == 3, F.concat(F.lit("'"), inches))
        .when(k % 6 == 4, (k % 80).cast("string"))
        .otherwise("tall'ish")
    )
    people = parquet(spark, folder, "customer").select("c_custkey", written.alias("written"))
    return people.select("c_custkey", values.height_inches(F.col("written")).alias("height"))


@query
def sex_code(spark, folder):
    word = F.get(F.array(*map(F.lit, ("female", "Male", "m", "", "unknown"))), (F.col("c_custkey") % 6).cast("int"))
    people = parquet(spark, folder, "customer").select("c_custkey", word.alias("word"))
    return people.select("c_custkey", values.sex_code(F.col("word")).alias("sex"))


@query
def month_year_date(spark, folder):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    written = F.when(k % 4 == 0, F.date_format(day, "MM/yyyy")).when(k % 4 == 1, text.format_mdy(day)).when(
        k % 4 == 2, F.date_format(day, "MM/dd/yyyy")
    ).otherwise("pending")
    orders = parquet(spark, folder, "orders").select("o_orderkey", written.alias("written"))
    repaired = values.full_date_text(F.col("written"))
    return plain(orders.select("o_orderkey", repaired.alias("written"), values.docket_date(repaired).alias("day")))


@query
def bool_flags(spark, folder):
    word = F.get(F.array(*map(F.lit, ("Yes", "y", "NO", "", "yes please"))), (F.col("o_orderkey") % 6).cast("int"))
    orders = parquet(spark, folder, "orders").select("o_orderkey", word.alias("word"))
    return orders.select("o_orderkey", values.flag_text(F.col("word")).alias("flag"))


@query
def injuries_count(spark, folder):
    k = F.col("o_orderkey")
    word = F.when(k % 4 == 0, "None").when(k % 4 == 1, "").otherwise((k % 5).cast("string"))
    orders = parquet(spark, folder, "orders").select("o_orderkey", word.alias("word"))
    return orders.select(
        "o_orderkey",
        values.injuries_text(F.col("word"), falsy_to_null=False).alias("injuries"),
        values.injuries_text(F.col("word")).alias("injuries_stored"),
    )


@query
def attorney_entries(spark, folder):
    rows = _all_entries(spark, folder).where((F.col("table") == "attorneys") & ~F.col("moved"))
    return rows.select("raw_case_id", F.col("attrs")["name"].alias("name"), F.col("attrs")["type"].alias("type"))


@query
def party_type(spark, folder):
    rows = _all_entries(spark, folder).where(F.col("table") == "parties")
    return rows.select("raw_case_id", "title", F.col("attrs")["type"].alias("type"))


@query
def attorney_relocation(spark, folder):
    rows = _all_entries(spark, folder).where("moved")
    return rows.select("raw_case_id", "table", F.col("attrs")["name"].alias("name"), F.col("attrs")["type"].alias("type"))


# Load.


@query
def unparsed_pages(spark, folder):
    # The ids alone decide: from the pages as they are built, only ids are made, and no html is written first.
    return load.unparsed(demo.raw_pages(spark, folder), demo.stored_cases(spark, folder)).select("case_id")


@query
def page_slice(spark, folder):
    return load.page_slice(_raw(spark, folder).select("case_id"), "case_id", 100, 50)


@query
def nonsense_rejects(spark, folder):
    return load.nonsense_rejects(_parsed(spark, folder))


@query
def duplicate_rejects(spark, folder):
    return load.duplicate_rejects(_parsed(spark, folder), demo.stored_cases(spark, folder))


@query
def value_rejects(spark, folder):
    k = F.col("o_orderkey")
    pages = parquet(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("case_id"),
        F.concat(
            F.lit('<h5>Case Information</h5><span class="Prompt">Case Number:</span><span class="Value">'),
            F.col("o_orderkey").cast("string"),
            F.lit('</span><span class="Prompt">Filing Date:</span><span class="Value">'),
            F.when(k % 3 == 0, "soon").otherwise("05/2016"),
            F.lit('</span><h5>Defendant</h5><span class="Prompt">Height:</span><span class="Value">'),
            F.when(k % 5 == 0, "x'9\"").otherwise("5'10\""),
            F.lit("</span>"),
        ).alias("html"),
    )
    entries = normalize.explode_entries(normalize.parse_pages(pages))
    return load.value_rejects(entries).drop("entry_no")


@query
def raw_after_rejects(spark, folder):
    return load.raw_after_rejects(_raw(spark, folder), _parsed(spark, folder)).select("case_id")


@query
def load_counts(spark, folder):
    return load.load_counts(_entries(spark, folder))


@query
def load_eight_tables(spark, folder):
    return load.to_long(_entries(spark, folder)).drop("entry_no")


def _table_query(table):
    def run(spark, folder):
        return plain(load.to_table(_entries(spark, folder), table))

    QUERIES[f"table_{table}"] = run


for _table in TABLES:
    _table_query(_table)


# Export.


@query
def training_extract(spark, folder):
    return plain(extract.training_extract(*_docket(spark, folder)))


@query
def defendant_filter(spark, folder):
    return extract.defendants(demo.view(spark, folder, "docket_parties")).select("case_id", "name", "type")


@query
def topic_extract(spark, folder):
    return plain(extract.training_extract(*_docket(spark, folder), topic=TOPIC))


@query
def case_types_by_family(spark, folder):
    return _types(spark, folder)


# Buckets.


@query
def comma_scrub(spark, folder):
    parties = demo.view(spark, folder, "docket_parties")
    return parties.select("case_id", "type", buckets.scrub_commas(F.col("race")).alias("race"))


@query
def court_split(spark, folder):
    court = F.col("court_system")
    cases = demo.view(spark, folder, "docket_cases")
    return cases.select("case_id", buckets.court_name(court).alias("courtname"), buckets.raw_court_type(court).alias("raw_type"))


@query
def court_type_bucket(spark, folder):
    cases = demo.view(spark, folder, "docket_cases")
    kind = buckets.court_type_bucket(buckets.raw_court_type(F.col("court_system")))
    return cases.select("case_id", kind.alias("courttype"))


@query
def court_type_ffill(spark, folder):
    cases = demo.view(spark, folder, "docket_cases")
    return bucketing.carry_court_type(cases).select("case_id", "courttype")


@query
def case_type_bucket(spark, folder):
    cases = demo.view(spark, folder, "docket_cases")
    return bucketing.case_type_bucket(cases, _types(spark, folder)).select("case_id", "casetype")


@query
def category_bucket(spark, folder):
    parties = demo.view(spark, folder, "docket_parties")
    return parties.select(
        "case_id",
        "type",
        buckets.race_bucket(F.col("race")).alias("bucket"),
        buckets.race_bucket(F.col("race"), comma_scrub_first=True).alias("scrubbed_bucket"),
    )


@query
def outcome_label(spark, folder):
    charges = demo.view(spark, folder, "docket_charges")
    return charges.select("case_id", "description", buckets.outcome(F.col("disposition")).alias("outcome"))


@query
def split_decided(spark, folder):
    return bucketing.decided(_general(spark, folder)).select("case_id", *bucketing.GENERAL)


@query
def split_in_process(spark, folder):
    return bucketing.in_process(_general(spark, folder)).select("case_id", *bucketing.GENERAL)


@query
def split_sets_written(spark, folder):
    path = work_path(spark, "sets")
    rows = bucketing.with_set(_topical(spark, folder)).select("bucket", *bucketing.TOPICAL)
    files.write_sets(rows, path, "bucket")
    schema = T.StructType([f for f in rows.schema if f.name != "bucket"] + [rows.schema["bucket"]])
    return files.read_csv(spark, path, schema, sep=",").groupBy("bucket", "outcome").agg(F.count("*").alias("n_rows"))


@query
def features_general(spark, folder):
    return _general(spark, folder).select(*bucketing.GENERAL)


@query
def features_topic(spark, folder):
    return _topical(spark, folder).select(*bucketing.TOPICAL)


# Model.


@query
def label_encode(spark, folder):
    rows = staged(spark, folder, "decided", lambda: QUERIES["split_decided"](spark, folder))
    return model.label_encode(rows, model.text_columns(rows, skip=("case_id",)))


@query
def train_test_split(spark, folder):
    rows = staged(spark, folder, "decided", lambda: QUERIES["split_decided"](spark, folder))
    return rows.withColumn("split", model.split_column("case_id")).groupBy("split", "outcome").agg(F.count("*").alias("n_rows"))


def _tree(spark, folder, topical=False):
    if topical:
        rows = bucketing.decided(_topical(spark, folder))
        features = bucketing.TOPICAL[1:]
    else:
        rows = staged(spark, folder, "decided", lambda: QUERIES["split_decided"](spark, folder))
        features = bucketing.GENERAL[1:]
    prepared, classes, bins = model.prepare(rows, features, "outcome", "case_id")
    return model.fit_tree(prepared.where("split = 'train'"), bins), prepared, features, classes


@query
def tree_accuracy(spark, folder):
    fitted, prepared, _, _ = _tree(spark, folder)
    return model.accuracy(fitted, prepared)


@query
def tree_nodes(spark, folder):
    fitted, _, features, classes = _tree(spark, folder)
    return model.tree_nodes(fitted, spark, features, classes)


@query
def feature_importance(spark, folder):
    fitted, _, features, _ = _tree(spark, folder)
    return model.feature_importance(fitted, spark, features)


@query
def topic_tree_importance(spark, folder):
    fitted, _, features, _ = _tree(spark, folder, topical=True)
    return model.feature_importance(fitted, spark, features)


# Incremental.


@query
def incremental_load(spark, folder):
    """Pages arrive in two drops, the second repeating the first; a third run finds nothing."""
    source, out = work_path(spark, "drops"), work_path(spark, "store")
    raw = _raw(spark, folder)
    first = raw.where(F.substring("case_id", -1, 1) < "5")
    for drop in (first, raw):
        files.append(drop, source)
        incremental.incremental_load(spark, source, out)
    incremental.incremental_load(spark, source, out)
    tables = [load.read_table(spark, out, t).select(F.lit(t).alias("table"), "case_id") for t in TABLES]
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows.groupBy("table").agg(F.count("*").alias("n_rows"), F.countDistinct("case_id").alias("n_cases"))


@query
def incremental_dedupe(spark, folder):
    source, store = work_path(spark, "arrivals"), work_path(spark, "raw-store")
    raw = _raw(spark, folder)
    for _ in range(2):
        files.append(raw.unionByName(raw), source)
        incremental.save_pages(incremental.page_stream(spark, source), store)
    return spark.read.parquet(store).groupBy("case_id").agg(F.count("*").alias("copies"))
