"""Results stay whole when one key holds a third of the rows."""

import collections
import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from courtloom.operators import bucketing, extract, joins, load, normalize
from courtloom.plans.queries import QUERIES


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"),
        (F.col("id") % 50).alias("v"),
    )
    left = left.unionByName(spark.createDataFrame([(None, 1)], "key string, v long"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("zz", 5), (None, 6)], "key string, w int")
    salted = joins.salted_join(left, right, "key", how, rows=500, salts=8)
    plain = left.join(right, "key", how)
    count = lambda df: collections.Counter(map(tuple, df.select(sorted(df.columns)).collect()))
    assert count(salted) == count(plain)


def test_heavy_keys_are_found_and_spread(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    assert [r.key for r in joins.heavy_keys(left, "key", rows=500).collect()] == ["hot"]
    right = spark.createDataFrame([("hot", 1)], "key string, w int")
    plan = joins.salted_join(left, right, "key", rows=500)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


@pytest.mark.parametrize("limit", [1, 100])
def test_lookup_join_beyond_its_limit(spark, limit):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "type string, v int")
    dim = spark.createDataFrame([("a", "x"), ("b", "y")], "type string, family string")
    rows = {r.v: r.family for r in joins.lookup_join(df, dim, "type", limit).collect()}
    assert rows == {1: "x", 2: "y", 3: None, 4: None}


def walk(cases):
    """The carry as a plain loop."""
    out, kind = {}, "courttype"
    for case_id, day, court in cases:
        parts = court.split("-")
        if len(parts) > 1:
            kind = {" Criminal": "criminal", " Traffic System": "traffic"}.get(parts[1], parts[1])
        out[case_id] = kind
    return out


@pytest.mark.parametrize("digits", [1, 2])
def test_carry_equals_a_walk(spark, digits):
    import hashlib

    random.seed(digits)
    start = datetime.date(2020, 1, 1)
    courts = ["A - Criminal", "B - Traffic System", "C - X", "D none", "E none", "F none", "G none"]
    # a third of the cases on one day; most courts name no type, so values travel over cells and days
    cases = [(str(i), start if i % 3 == 0 else start + datetime.timedelta(random.randint(0, 25)), random.choice(courts)) for i in range(400)]
    order = sorted(cases, key=lambda c: (c[1], hashlib.md5(c[0].encode()).hexdigest()[:digits], c[0]))
    copies = [c for c in cases for _ in range(200 if c[0] == "7" else 1)]
    rows = bucketing.carry_court_type(spark.createDataFrame(copies, "case_id string, filing_date date, court_system string"), digits)
    found = collections.Counter((r.case_id, r.courttype) for r in rows.collect())
    expected = walk(order)
    assert found == collections.Counter((c[0], expected[c[0]]) for c in copies)


def test_carry_without_any_type(spark):
    rows = spark.createDataFrame([("1", datetime.date(2020, 1, 1), "A")], "case_id string, filing_date date, court_system string")
    assert bucketing.carry_court_type(rows).first().courttype == "courttype"


def parsed_pages(spark, rows):
    entry = "struct<table:string,title:string,moved:boolean,raw:map<string,string>,attrs:map<string,string>>"
    filled = [(raw, h, case, [("cases", "Case Information", False, {}, {"title": raw})]) for raw, h, case in rows]
    return spark.createDataFrame(filled, f"raw_case_id string, page_hash long, case_id string, entries array<{entry}>")


def test_one_page_per_case_when_one_id_is_everywhere(spark):
    rows = [(f"r{i:04}", i, "hot" if i % 3 == 0 else str(i)) for i in range(300)] + [("r0003", 3, "hot"), ("n", 1, None)]
    parsed, stored = parsed_pages(spark, rows), spark.createDataFrame([("1",)], "case_id string")
    best = {r.case_id: r.raw_case_id for r in load.winners(parsed, stored).collect()}
    assert best["hot"] == "r0000" and "1" not in best and len(best) == 200
    rejects = load.duplicate_rejects(parsed, stored).collect()
    assert sum(r.pages for r in rejects) + len(best) == 301
    assert {r.pages for r in rejects if r.raw_case_id == "r0003"} == {2}
    assert [r.raw_case_id for r in load.nonsense_rejects(parsed).collect()] == ["n"]
    assert load.load_counts(load.load(parsed, stored)).first().n_rows == 200


def test_copies_combine_before_the_shuffle(spark):
    rows = [(f"r{i}", i, "hot") for i in range(10)]
    plan = load.winners(parsed_pages(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_extract_joins_fan_out_and_filter(spark):
    day = datetime.date(2020, 1, 1)
    cases = spark.createDataFrame([("1", "C", "t", day), ("2", "C", "", day), ("3", "C", "t", None)], "case_id string, court_system string, type string, filing_date date")
    people = "case_id string, name string, type string, race string, sex string, height int, weight int, state string, city string, zip string"
    row = lambda case, kind, zip_="21201", race="White": (case, "n", kind, race, "F", 60, 100, "MD", "Bel AIR", zip_)
    parties = spark.createDataFrame(
        [row("1", "Defendant"), row("1", "DEFENDANT/Respondent"), row("1", "Plaintiff"), row("1", "Defendant", "2120"), row("1", "Defendant", race=""), row("2", "Defendant"), row("3", "Defendant")],
        people,
    )
    charges = spark.createDataFrame(
        [("1", "Oyster theft", "Guilty"), ("1", "Speeding", "Stet"), ("1", "", "Stet"), ("1", "x", None), ("2", "x", "Stet"), ("3", "x", "Stet")],
        "case_id string, description string, disposition string",
    )
    rows = extract.training_extract(cases, parties, charges).collect()
    assert len(rows) == 4 and {r.city for r in rows} == {"bel air"}
    topic = extract.training_extract(cases, parties, charges, topic="oyster").collect()
    assert len(topic) == 2 and {r.city for r in topic} == {"Bel AIR"}
    assert topic[0].asDict().keys() == dict.fromkeys(extract.EXTRACT_COLUMNS).keys()


def test_carry_keeps_every_row(spark):
    data = [("1", None, "A - Criminal"), ("1", None, "B"), (None, datetime.date(2020, 1, 1), "C - Traffic System"), ("2", datetime.date(2020, 1, 1), None)]
    rows = bucketing.carry_court_type(spark.createDataFrame(data, "case_id string, filing_date date, court_system string")).collect()
    found = {(r.case_id, r.court_system): r.courttype for r in rows}
    assert len(rows) == len(data)
    assert found == {("1", "A - Criminal"): "criminal", ("1", "B"): "criminal", (None, "C - Traffic System"): "traffic", ("2", None): "courttype"}


def test_load_keeps_winners_and_single_cases(spark):
    page = lambda number, more="": f'<h5>Case Information</h5><span class="Prompt">Case Number:</span><span class="Value">{number}</span>{more}'
    twice = page("C2", "<hr>" + page("C9"))
    pages = [("1", page("C1")), ("1", page("C1", "<hr>")), ("2", page("C1")), ("3", page(" ")), ("4", twice), ("4", twice)]
    raw = spark.createDataFrame(pages, "case_id string, html string")
    parsed = normalize.parse_pages(raw)
    assert sorted(r.case_id for r in load.raw_after_rejects(raw, parsed).collect()) == ["1", "4"]
    assert load.nonsense_rejects(parsed).count() == 1
    stored = load.to_table(load.load(parsed), "cases").collect()
    assert sorted(r.case_id for r in stored) == ["C1", "C2"]
    assert load.extra_case_rejects(parsed).count() == 1


def test_values_that_no_typed_column_holds_are_listed(spark):
    attrs = {"weight": "180 lbs", "dob": "13/45/2016", "height": "70", "name": "n/a", "zip": ""}
    entry = ("1", "1", "parties", 0, {"dob": "13/45/2016", "height": "5'10"}, attrs)
    entries = spark.createDataFrame([entry], "raw_case_id string, case_id string, `table` string, entry_no int, raw map<string,string>, attrs map<string,string>")
    found = {(r.attribute, r.value) for r in load.value_rejects(entries).collect()}
    assert found == {("weight", "180 lbs"), ("dob", "13/45/2016")}


def test_unclosed_tags_stay_linear():
    from time import perf_counter

    from courtloom.sources import elements

    def took(n):
        start = perf_counter()
        elements.page_elements("<b>" * n + "</i>" * n, frozenset({"b"}))
        return perf_counter() - start

    took(2_000)
    assert took(40_000) < 10 * max(took(10_000), 0.01)


def test_unparsed_pages_makes_ids_and_no_html(spark, tmp_path):
    folder = str(tmp_path)
    duckdb.sql(f"COPY (SELECT range::BIGINT AS o_orderkey, 1::BIGINT AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority, DATE '2020-01-01' AS o_orderdate FROM range(8)) TO '{folder}/orders.parquet'")
    duckdb.sql(f"COPY (SELECT 1::BIGINT AS c_custkey, 'c' AS c_name, 0::INT AS c_nationkey) TO '{folder}/customer.parquet'")
    duckdb.sql(f"COPY (SELECT 0::INT AS n_nationkey, 'n' AS n_name) TO '{folder}/nation.parquet'")
    got = QUERIES["unparsed_pages"](spark, folder)
    assert sorted(r.case_id for r in got.collect()) == ["0", "2", "3", "4", "6", "7", "copy-0"]
    assert "html" not in got._jdf.queryExecution().executedPlan().toString()
