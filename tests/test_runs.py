"""File round trips, stored tables, incremental runs and the model."""

import datetime

from pyspark.sql import functions as F

from courtloom.operators import extract, load, model, normalize
from courtloom.schemas import TABLES, table_schema
from courtloom.session import work_path
from courtloom.sources import files, tables
from courtloom.streaming import incremental


def page(case_id, charges=1):
    pair = lambda label, value: f'<span class="Prompt">{label}:</span><span class="Value">{value}</span>'
    one = pair("Plea", "G") + pair("Fine Amt", "$1,000.50") + pair("Seat Belts Used", "y") + "<hr>"
    return "<h5>Case Information</h5>" + pair("Case Number", case_id) + pair("Filing Date", "05/2016") + "<h5>Charge Information</h5>" + one * charges


def raw(spark, *pages):
    return spark.createDataFrame(list(pages), "case_id string, html string")


def test_csv_keeps_blanks_quotes_and_nulls(spark):
    rows = [(" a ", 'say "hi"|x', ""), (None, "a,b", "c"), ("", None, "d\\"), ("two\nlines", "x", "y")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for sep in ("|", ","):
        path = work_path(spark, "csv")
        files.write_csv(df, path, sep)
        assert sorted(map(str, files.read_csv(spark, path, df.schema, sep).collect())) == sorted(map(str, df.collect()))


def test_types_json_is_one_object(spark):
    types = spark.createDataFrame([("civil", "b"), ("civil", "a"), ("traffic", "c"), ("civil", "a")], "family string, type string")
    assert files.types_json(types).first().json == '{"civil":["a","b"],"traffic":["c"]}'


def test_tables_are_typed(spark):
    entries = load.load(normalize.parse_pages(raw(spark, ("1", page("A")))))
    charge = load.to_table(entries, "charges").first()
    assert charge.fine_amt == "$1,000.50" and str(charge.fine_amt_value) == "1000.50" and charge.seatbelts_used is True
    assert load.to_table(entries, "cases").first().filing_date == datetime.date(2016, 5, 1)
    for name in TABLES:
        assert [(f.name, f.dataType) for f in load.to_table(entries, name).schema] == [(f.name, f.dataType) for f in table_schema(name)]


def test_eight_tables_from_one_parse(spark):
    out = work_path(spark, "batch")
    entries = load.load(normalize.parse_pages(raw(spark, ("1", page("A", 2)), ("2", page("B")))))
    staged = load.stage_entries(entries, f"{out}/_staged")
    load.store_tables(staged, out)
    load.store_tables(staged, out)
    assert load.read_table(spark, out, "charges").count() == 3
    assert load.read_table(spark, out, "cases").count() == 2


def test_incremental_runs_add_only_what_is_new(spark):
    source, out = work_path(spark, "in"), work_path(spark, "out")
    files.append(raw(spark, ("1", page("A")), ("2", page("B", 2)), ("3", "<p>nothing")), source)
    incremental.incremental_load(spark, source, out)
    ids = lambda: sorted(r.case_id for r in load.read_table(spark, out, "cases").collect())
    assert ids() == ["A", "B"]
    files.append(raw(spark, ("2", page("B")), ("4", page("A")), ("C", page("C", 3))), source)
    incremental.incremental_load(spark, source, out)
    incremental.incremental_load(spark, source, out)
    assert ids() == ["A", "B", "C"]
    assert load.read_table(spark, out, "charges").count() == 6
    reasons = spark.read.parquet(f"{out}/_rejects").groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in reasons} == {"nonsense": 1, "duplicate": 2}


def test_repeated_batch_changes_nothing(spark):
    out = work_path(spark, "again")
    incremental.prepare_store(spark, out)
    batch = raw(spark, ("1", page("A")), ("2", page("B")))
    for _ in range(2):
        incremental.load_batch(batch, 0, out)
    assert load.read_table(spark, out, "cases").count() == 2
    assert load.read_table(spark, out, "charges").count() == 2


def test_stream_dedupe_within_watermark(spark):
    source = work_path(spark, "timed")
    rows = [("1", "a", datetime.datetime(2024, 1, 1)), ("1", "b", datetime.datetime(2024, 1, 1, 0, 5)), ("2", "c", datetime.datetime(2024, 1, 1))]
    schema = "case_id string, html string, at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    once = incremental.first_within(spark.readStream.schema(schema).parquet(source), "at", "1 hour")
    query = once.writeStream.format("memory").queryName("timed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.case_id for r in spark.table("timed").collect()) == ["1", "2"]


def test_tree_finds_the_rule_and_explains_it(spark):
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("case_id"),
        F.when(F.col("id") % 100 < 37, "guilty").otherwise("not-guilty").alias("outcome"),
        F.lpad((F.col("id") % 100).cast("string"), 5, "0").alias("zip"),
        (F.col("id") % 7).cast("int").alias("height"),
    )
    prepared, classes, bins = model.prepare(rows, ["zip", "height"], "outcome", "case_id")
    assert classes == ["guilty", "not-guilty"] and bins >= 100
    fitted = model.fit_tree(prepared.where("split = 'train'"), bins)
    scores = {r.split: r.accuracy for r in model.accuracy(fitted, prepared).collect()}
    assert scores == {"train": 1.0, "test": 1.0}
    nodes = model.tree_nodes(fitted, spark, ["zip", "height"], classes).orderBy("node").collect()
    assert nodes[0].feature == "zip" and 36 <= nodes[0].threshold < 37
    assert {n.outcome for n in nodes if n.feature is None} == {"guilty", "not-guilty"}
    importance = model.feature_importance(fitted, spark, ["zip", "height"]).collect()
    assert [(r.feature, r.importance) for r in importance] == [("zip", 1.0), ("height", 0.0)]


def test_random_split_is_seeded(spark):
    train, test = model.random_split(spark.range(1000))
    again, _ = model.random_split(spark.range(1000))
    assert train.count() + test.count() == 1000 and train.exceptAll(again).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("raw_b", "cases_b"):
            files.append_bucketed(spark.range(100).select(F.col("id").cast("string").alias("case_id"), F.lit("x").alias("html")), name, buckets=4)
        plan = load.unparsed(spark.table("raw_b"), spark.table("cases_b"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "LeftAnti" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS raw_b")
        spark.sql("DROP TABLE IF EXISTS cases_b")


def test_parquet_readers(spark):
    path = work_path(spark, "pages")
    files.append(raw(spark, ("1", "a")), path)
    assert tables.raw_pages(spark, path).columns == ["case_id", "html"]


def test_extract_scans_only_what_it_needs(spark):
    out = work_path(spark, "pruned")
    entries = load.load(normalize.parse_pages(raw(spark, ("1", page("A")))))
    load.store_tables(load.stage_entries(entries, f"{out}/_staged"), out)
    for table in ("parties", "attorneys"):
        assert load.read_table(spark, out, table).count() == 0
    stored = [load.read_table(spark, out, t) for t in ("cases", "parties", "charges")]
    plan = extract.training_extract(*stored)._jdf.queryExecution().executedPlan().toString()
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    assert "struct<case_id:string,court_system:string,type:string,filing_date:date>" in "".join(schemas)
    assert not any("jail_term_months" in s or "address" in s or "title" in s for s in schemas)
    assert "IsNotNull(height)" in plan and "IsNotNull(filing_date)" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_fresh_pages_move_html_once_and_sort_none(spark):
    pages = [("a", "x"), ("a", "x"), ("b", "z"), ("b", "y"), ("b", None), (None, "n"), (None, "n"), ("c", None), ("old", "x")]
    earlier = spark.createDataFrame([("old",), (None,)], "case_id string")
    got = incremental.fresh_pages(raw(spark, *pages), earlier)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "x"), ("b", "y"), (None, "n"), ("c", None)], key=str)
    alike = incremental.fresh_pages(raw(spark, ("a", "x"), ("a", "x"), ("c", "y")), earlier)
    plan = alike._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange") == 2
    assert sorted(map(tuple, alike.collect())) == [("a", "x"), ("c", "y")]
    assert incremental.fresh_pages(raw(spark, ("old", "other")), earlier).collect() == []
