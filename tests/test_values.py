"""Scalar rules: samples, and properties against plain Python."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courtloom.functions import buckets, text, values
from courtloom.operators import frontier


def column(spark, rows, rule, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", rule(F.col("x")).alias("y")).orderBy("i").collect()]


SAMPLES = [
    (text.collapse_ws, ["a  \tb　", " \x1cx\x1f", " ", None], ["a b", "x", "", None]),
    (text.prompt_label, ["Seat Belts Used?:", "Name: ", "a:?", "a?:", "a ?", ":", "x::"], ["Seat Belts Used", "Name:", "a:", "a", "a", "", "x:"]),
    (text.url_case_id, ["/d.jis?caseId=0A1&loc=2", "/d.jis", "/d?x=&y=1", "/d?a=1=2"], ["0A1", None, "", "1"]),
    (values.height_inches, ["5'10\"", '6"', "70", "", None, "x'1", "5'", "5' 10"], ["70", "72", "70", "", None, None, "60", "70"]),
    (values.sex_code, ["female", "m", "", None], ["F", "M", "", None]),
    (values.full_date_text, ["05/2016", "5/7/2016", "soon", "", None], ["05/01/2016", "5/7/2016", None, "", None]),
    (values.flag_text, ["YES", "y", "no", "", None], ["true", "true", "false", "", None]),
    (values.term_months, ["2-6 10 5:00:00", "0-12 0 0:00:00", "x-1 0 0:00:00"], [30, 12, None]),
    (values.term_hours, ["2-6 10 5:00:00"], [5]),
    (
        buckets.outcome,
        ["1:Guilty", "1: Guilty", "Stet", "Unlisted", "2:Dismissed:x", "Nolo Contendere", "1:Unlisted", "a:", None],
        ["guilty", "in-process", "in-process", "Unlisted", "not-guilty", "guilty", "in-process", "in-process", None],
    ),
    (buckets.court_name, ["District Court - Traffic System", "X"], ["District Court ", "X"]),
    (lambda c: buckets.court_type_bucket(buckets.raw_court_type(c)), ["A - Criminal", "A - Traffic System-b", "A", "A-x"], ["criminal", "traffic", None, "x"]),
    (buckets.race_bucket, ["BLACK, AFRICAN AMERICAN", "Caucasion", "INDIAN", "Indian", "?"], ["black", "white", "asian", "other", "?"]),
    (lambda c: buckets.race_bucket(c, True), ["BLACK, AFRICAN AMERICAN", "Black"], ["BLACK  AFRICAN AMERICAN", "black"]),
    (buckets.families_of, ["X Civil Citation System", "Civil", "CRIMINAL traffic", "z"], [["civil citation"], ["civil"], ["criminal", "traffic"], []]),
    (lambda c: values.amount(c).cast("string"), ["$1,234.50", "n/a", ""], ["1234.50", None, None]),
]


@pytest.mark.parametrize("n", range(len(SAMPLES)))
def test_sample(spark, n):
    rule, given_rows, expected = SAMPLES[n]
    assert column(spark, given_rows, rule) == expected


def test_dates(spark):
    days = column(spark, ["05/01/2016", "5/7/2016", "13/40/2016", ""], values.docket_date)
    assert days == [datetime.date(2016, 5, 1), datetime.date(2016, 5, 7), None, None]
    assert column(spark, ["2024/1/3", "2024/01/03", "x"], lambda c: text.format_mdy(text.parse_ymd(c))) == ["1/3/2024", "1/3/2024", None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n  \x1cab:?", max_size=12), min_size=1, max_size=40))
def test_collapse_like_split_join_and_idempotent(spark, texts):
    once = column(spark, texts, text.collapse_ws)
    assert once == [" ".join(t.split()) for t in texts]
    assert column(spark, once, text.collapse_ws) == once


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 60)), min_size=1, max_size=40))
def test_term_carry_keeps_the_total(spark, terms):
    df = spark.createDataFrame([(i, str(y), str(m)) for i, (y, m) in enumerate(terms)], "i int, y string, m string")
    term = values.term_text(F.col("y"), F.col("m"), F.lit(None).cast("string"), F.lit("3"))
    rows = df.select("i", term.alias("t"), values.term_months(term).alias("months")).orderBy("i").collect()
    assert [r.months for r in rows] == [y * 12 + m for y, m in terms]
    for row, (y, m) in zip(rows, terms):
        shown = int(row.t.split(" ")[0].split("-")[1])
        assert shown == (m if m <= 12 else m % 12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.dates(datetime.date(1990, 1, 1), datetime.date(2030, 1, 1)), st.integers(-40, 40)), min_size=1, max_size=10))
def test_date_spine_runs_both_ways(spark, spans):
    rows = [(i, d, d + datetime.timedelta(n)) for i, (d, n) in enumerate(spans)]
    df = spark.createDataFrame(rows, "i int, a date, b date")
    forth = df.select("i", frontier.date_spine(F.col("a"), F.col("b")).alias("d")).collect()
    back = df.select("i", frontier.date_spine(F.col("b"), F.col("a")).alias("d")).collect()
    for i, (_, n) in enumerate(spans):
        there, here = [r.d for r in forth if r.i == i], [r.d for r in back if r.i == i]
        assert len(there) == abs(n) + 1 and there == here[::-1]


def test_search_grid_of_one_day(spark):
    days = spark.createDataFrame([(datetime.date(2024, 1, 3),)], "day date")
    grid = frontier.search_grid(days)
    assert grid.count() == grid.distinct().count() == 416
    assert grid.first().filing_date == "1/3/2024"
    assert {(r.company, r.company_label) for r in grid.collect()} == {("Y", "Company"), ("N", "Person")}


def test_links_of_a_result_page(spark):
    html = (
        "<a href='/top'>x</a><table class='results wide'><tr><td><a href='/d?caseId=1&amp;loc=2'>1</a></td>"
        "<td><a name='here'>no</a><a href='inquiry-results?s=1'>sort</a></td></tr></table>"
        "<table><tr><td><a href='/other'>o</a></td></tr></table>"
        "<span class=pagelinks><a href='/p2'>2</a> <a href='/p2'>next</a></span><span><a href='/q'>q</a></span>"
    )
    pages = spark.createDataFrame([(1, False, html), (2, True, html), (3, False, "<p>none")], "n int, is_sub_page boolean, html string")
    linked = frontier.with_page_links(pages)
    links = frontier.explode_links(linked, "case_links", "n")
    assert [(r.n, r.href) for r in links.where("n = 1").collect()] == [(1, "/d?caseId=1&loc=2"), (1, "inquiry-results?s=1")]
    ids = frontier.with_case_id(frontier.drop_sort_links(links)).where("n = 1").collect()
    assert [r.case_id for r in ids] == ["1"]
    assert [tuple(r) for r in frontier.pagination(linked, "n").collect()] == [(1, "/p2")]
    stored = spark.createDataFrame([("1",)], "case_id string")
    cases = frontier.with_case_id(frontier.drop_sort_links(links)).where("n = 1")
    assert (frontier.unseen(cases, stored).count(), frontier.seen(cases, stored).count()) == (0, 1)
    other = spark.createDataFrame([("2",)], "case_id string")
    assert (frontier.unseen(cases, other).count(), frontier.seen(cases, other).count()) == (1, 0)
