"""Case pages traced by hand, one per branch of the extraction."""

import pytest
from pyspark.sql import functions as F

from courtloom.operators import blocks, load, normalize
from courtloom.sources.elements import CASE_TAGS, html_elements, page_elements


def P(text):
    return f'<span class="Prompt">{text}</span>'


def V(text):
    return f'<span class="Value">{text}</span>'


def header(text):
    return f"<h5>{text}</h5>"


TERM = [P("Yrs:"), V("1"), P("Mos:"), V("18"), P("Days:"), V("10"), P("Hours:"), V("5")]
STATUTE = [P("Article:"), V("CR"), P("Sec:"), V("3"), P("Sub-Sec:"), V("203"), P("Para:"), V(""), P("Code:"), V("a")]
EVENTS = header("Case History Information") + "<th>" + P("Event Type") + "</th> <th>" + P("Event Date") + "</th>"

# page, expected entries as (table, attributes without NULLs)
PAGES = {
    "case": (
        header("Case Information") + P("Court System:") + V("District Court - Criminal System") + P("Case Number:") + V("0A1")
        + P("Filing Date:") + V("05/2016") + "<hr>",
        [("cases", {"court_system": "District Court - Criminal System", "case_id": "0A1", "filing_date": "05/01/2016"})],
    ),
    "no header": (P("Case Number:") + V("0A2"), [("cases", {"case_id": "0A2"})]),
    "party": (
        header("Defendant Information") + P("Name:") + V("DOE,  JANE") + P("Sex:") + V("female") + P("Height:") + V("5'10\""),
        [("parties", {"name": "DOE, JANE", "sex": "F", "height": "70", "type": "Defendant"})],
    ),
    "inches read as feet": (
        header("Defendant Information") + P("Height:") + V('6"'),
        [("parties", {"height": "72", "type": "Defendant"})],
    ),
    "statute": (header("Charge Information") + "".join(STATUTE), [("charges", {"statute_code": "CR.3.203.a"})]),
    "statute keeps what follows": (
        header("Charge Information") + "".join(STATUTE) + P("Plea:") + V("NG"),
        [("charges", {"statute_code": "CR.3.203.a", "plea": "NG"})],
    ),
    "statute cut short": (header("Charge Information") + "".join(STATUTE[:6]), [("charges", {})]),
    "article without section": (
        header("Charge Information") + P("Article:") + V("CR") + P("Plea:") + V("G"),
        [("charges", {"article": "CR", "plea": "G"})],
    ),
    "term": (header("Charge Information") + P("Jail Term:") + "".join(TERM), [("charges", {"jail_term": "2-6 10 5:00:00"})]),
    "twelve months stay": (
        header("Charge Information") + P("Jail Term:") + P("Yrs:") + V("") + P("Mos:") + V("12") + P("Days:") + V("") + P("Hours:") + V(""),
        [("charges", {"jail_term": "0-12 0 0:00:00"})],
    ),
    "term not numeric": (
        header("Charge Information") + P("Probation:") + P("Yrs:") + V("x") + P("Mos:") + V("18") + P("Days:") + V("1") + P("Hours:") + V("2"),
        [("charges", {"probation_term": "x-18 1 2:00:00"})],
    ),
    "anchor inside a term": (
        header("Charge Information") + P("Jail Term:") + P("Suspended Term:") + "".join(TERM[1:]) + P("Plea:") + V("G"),
        [("charges", {"jail_term": "2-6 10 5:00:00", "plea": "G"})],
    ),
    "events": (
        EVENTS + V("HEAR") + V("1/2/2016") + V("TRIAL") + V("2/3/2016") + "<hr>",
        [("events", {"type": "HEAR", "date": "1/2/2016"}), ("events", {"type": "TRIAL", "date": "2/3/2016"})],
    ),
    "events, short last row": (
        EVENTS + V("HEAR") + V("1/2/2016") + V("TRIAL") + "<hr>",
        [("events", {"type": "HEAR", "date": "1/2/2016"}), ("events", {"type": "TRIAL"})],
    ),
    "events to page end": (EVENTS + V("HEAR") + V("1/2/2016"), [("events", {"type": "HEAR", "date": "1/2/2016"})]),
    "no events": (EVENTS + "<hr>" + header("Defendant") + P("Name:") + V("X"), [("parties", {"name": "X", "type": "Defendant"})]),
    "noise value": (
        header("Judgement Information") + P("Amount:") + V("5.00") + V("MONEY JUDGMENT"),
        [("judgements", {"amt": "5.00"})],
    ),
    "last value wins": (header("Case Information") + P("Case Number:") + V("A") + V("B"), [("cases", {"case_id": "B"})]),
    "later label wins": (
        header("Case Information") + P("Case Number:") + V("A") + P("Citation Number:") + V("B") + P("Case Number:") + V("C"),
        [("cases", {"case_id": "B"})],
    ),
    "unknown title": (header("Unknown Title") + P("Name:") + V("X"), []),
    "attorney": (
        header("Attorney(s) for the Defendant") + P("Name:") + V("ROE") + P("Appearance Date:") + V("1/1/2016"),
        [("attorneys", {"name": "ROE", "type": "Defendant", "appearance_date": "1/1/2016"})],
    ),
    "attorney without date": (header("Attorney(s) for the Defendant") + P("Name:") + V("ROE"), []),
    "attorney by name": (
        header("Attorney(s) for the Plaintiff") + P("Name:") + V("State's ATTORNEY"),
        [("attorneys", {"name": "State's ATTORNEY", "type": "Plaintiff"})],
    ),
    "relocated attorney": (
        header("Related Persons Information") + P("Name:") + V("POE") + P("Party Type:") + V("Attorney for Plaintiff"),
        [("attorneys", {"name": "POE", "type": "Plaintiff"})],
    ),
    "relocated come last": (
        header("Related Persons Information") + P("Name:") + V("POE") + P("Party Type:") + V("attorney for X") + "<hr>"
        + header("Attorney(s) for the Defendant") + P("Name:") + V("ROE") + P("Appearance Date:") + V("1/1/2016"),
        [
            ("attorneys", {"name": "ROE", "type": "Defendant", "appearance_date": "1/1/2016"}),
            ("attorneys", {"name": "POE", "type": "X"}),
        ],
    ),
    "charge subheading": (
        header("Charge Information") + P("Plea:") + V("NG") + "<left><i>Fine</i></left>" + P("Fine Amt:") + V("10"),
        [("charges", {"plea": "NG", "fine_amt": "10"})],
    ),
    "free subheading": (
        header("Charge Information") + P("Plea:") + V("NG") + "<i>Disposition</i>" + P("Fine Amt:") + V("10"),
        [("charges", {"plea": "NG"}), ("charges", {"fine_amt": "10"})],
    ),
    "falsy values": (
        header("Charge Information") + P("Personal Injury:") + V("None") + P("Probable Cause Indicator:") + V("no") + P("Plea:") + V("G"),
        [("charges", {"plea": "G"})],
    ),
    "ignored class": (
        header("Case Information") + P("Case Number:") + V("A") + '<span class="AltBodyWindowDcCivil Value">B</span>',
        [("cases", {"case_id": "A"})],
    ),
    "statement does not break": (
        header("Charge Information") + P("Plea:") + V("G") + '<h6 class="InfoChargeStatement">s</h6>' + P("Fine Amt:") + V("1"),
        [("charges", {"plea": "G", "fine_amt": "1"})],
    ),
    "prompt survives headers": (
        header("Case Information") + P("Case Number:") + V("A") + header("Defendant") + V("B"),
        [("cases", {"case_id": "A"}), ("parties", {"case_id": "B", "type": "Defendant"})],
    ),
    "empty header closes the block": (
        header("Defendant") + P("Name:") + V("A") + "<h6> </h6>" + V("B"),
        [("parties", {"name": "A", "type": "Defendant"}), ("parties", {"name": "B", "type": "Defendant"})],
    ),
    "value before any prompt": (header("Defendant") + V("lost") + P("Name:") + V("A"), [("parties", {"name": "A", "type": "Defendant"})]),
    "odd letters": (
        header("Defendant") + P("Seat Belts Used?:") + V("Yes") + P("Name:") + V("A&nbsp;\n &amp; B <b>C</b>"),
        [("parties", {"seatbelts_used": "true", "name": "A & B C", "type": "Defendant"})],
    ),
    "officer": (
        header("Officer - Arresting/Complainant") + P("Name:") + V("X") + P("Connection:") + V("own"),
        [("parties", {"name": "X", "type": "Officer - Arresting/Complainant"})],
    ),
}


@pytest.fixture(scope="module")
def parsed(spark):
    raw = spark.createDataFrame([(name, page) for name, (page, _) in PAGES.items()], "case_id string, html string")
    return {r.raw_case_id: r for r in normalize.parse_pages(raw).collect()}


@pytest.mark.parametrize("name", PAGES)
def test_page(parsed, name):
    found = [(e["table"], {k: v for k, v in e["attrs"].items() if v is not None}) for e in parsed[name].entries]
    assert found == PAGES[name][1]


def test_page_without_case_is_nonsense(parsed):
    assert parsed["party"].case_id is None
    assert parsed["case"].case_id == "0A1"


def test_lossy_skips_drop_the_next_element(spark):
    page = header("Charge Information") + "".join(STATUTE) + P("Plea:") + V("NG")
    raw = spark.createDataFrame([("x", page)], "case_id string, html string")
    entry = normalize.parse_pages(raw, lossy_skips=True).first().entries[0]
    assert entry["attrs"] == {"statute_code": "CR.3.203.a", "article": "NG"}


def test_flags_kept_without_falsy_to_null(spark):
    raw = spark.createDataFrame([("x", PAGES["falsy values"][0])], "case_id string, html string")
    entry = normalize.parse_pages(raw, falsy_to_null=False).first().entries[0]
    assert entry["attrs"] == {"injuries": "0", "probable_cause": "false", "plea": "G"}


def test_null_page_is_nonsense(spark):
    raw = spark.createDataFrame([("x", None)], "case_id string, html string")
    parsed = normalize.parse_pages(raw)
    assert load.nonsense_rejects(parsed).count() == 1
    assert normalize.explode_entries(parsed).count() == 0


def elements(html, tags=CASE_TAGS):
    return page_elements(html, frozenset(tags))


def test_elements_nest_and_repeat_inner_text():
    found = elements("<div><span class='a b'>x<span>y</span></span>z</div>")
    assert found == [("span", "div", ("a", "b"), "xy"), ("span", "span", (), "y")]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<h5>a", [("h5", None, (), "a")]),
        ("<h5>a</h6></h5>b", [("h5", None, (), "a")]),
        ("<p><h5>a</p>b</h5>", [("h5", "p", (), "a")]),
        ("<hr><hr/>x", [("hr", None, (), ""), ("hr", None, (), "")]),
        ("<!-- <i>no</i> --><i>yes</i>", [("i", None, (), "yes")]),
        ("<script>var a='<i>no</i>';</script><i>yes</i>", [("i", None, (), "yes")]),
        ("<I CLASS=Value>1 &lt; 2</I>", [("i", None, ("Value",), "1 < 2")]),
        ("<i title='a > b' class='c'>t</i>", [("i", None, ("c",), "t")]),
        ("<i>a<script>b</script>c</i>", [("i", None, (), "ac")]),
        ("<left><i>a</i></left>", [("i", "left", (), "a")]),
        ("1 < 2 <i>a</i>", [("i", None, (), "a")]),
        ("<i>a<!-- b</i>", [("i", None, (), "a")]),
        ("<i>a<!-- b> c", [("i", None, (), "a")]),
        ("<i>a<script>b</i> c", [("i", None, (), "a")]),
        ("<i>a<!DOCTYPE x> c", [("i", None, (), "a c")]),
        ("<i>a</i", [("i", None, (), "a</i")]),
        ("", []),
    ],
)
def test_elements_of_untidy_html(html, expected):
    assert elements(html) == expected


def test_unended_tags_take_linear_time():
    assert elements("<i>x" + "<a " * 200_000) == [("i", None, (), "x" + "<a " * 200_000)]
    assert len(elements("<i " * 200_000 + ">")) == 1


def test_spans_resolve_like_a_walk(spark):
    """Kept spans equal a sequential walk over random anchors."""
    import random

    random.seed(3)
    pages, expected = [], []
    for n in range(60):
        starts = sorted(random.sample(range(60), random.randint(0, 12)))
        spans = [(s, s + random.randint(1, 15)) for s in starts]
        kept, free = [], 0
        for start, stop in spans:
            if start >= free:
                kept.append(start)
                free = stop
        pages.append((n, [{"start": a, "stop": b} for a, b in spans]))
        expected.append((n, kept))
    df = spark.createDataFrame(pages, "n int, spans array<struct<start:int,stop:int>>")
    got = df.select("n", F.transform(blocks.keep_spans(F.col("spans")), lambda s: s["start"]).alias("kept")).collect()
    assert sorted((r.n, r.kept) for r in got) == expected


def test_long_page_is_parsed_whole(spark):
    """A page of 20,000 pairs: every one is kept, in linear work."""
    page = header("Case Information") + P("Case Number:") + V("A") + "".join(P(f"L{i}:") + V(str(i)) for i in range(20000))
    raw = spark.createDataFrame([("x", page)], "case_id string, html string")
    entry = normalize.parse_pages(raw).first().entries[0]
    assert len(entry["attrs"]) == 20001 and entry["attrs"]["l19999"] == "19999"


def test_parse_plan_moves_nothing_and_walks_pages_once(spark):
    raw = spark.createDataFrame([("x", "<hr>")], "case_id string, html string")
    plan = normalize.explode_entries(normalize.parse_pages(raw)).where("table = 'cases' and case_id is not null")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1
    assert text.count("InfoChargeStatement") == 1


def test_each_distinct_tag_is_read_once():
    from functools import lru_cache

    from courtloom.sources import elements

    page = "<SPAN class=a>x</span><!-- <b> --><script>'<i>'</SCRIPT >&amp;<b/>" * 50 + "y"
    read = lru_cache(100)(elements.read_token)
    got = page_elements(page, frozenset({"span", "b"}), read=read)
    assert got == page_elements(page, frozenset({"span", "b"})) and len(got) == 100
    assert got[0] == ("span", None, ("a",), "x") and got[1][0] == "b"
    assert read.cache_info().misses == 5


def test_prompts_leave_once_their_label_is_carried(spark):
    page = P("Race:") + V("x") + "<hr>" + header("Defendant") + P("Sex:") + V("m") + "<span>n</span>" + V("f")
    df = spark.createDataFrame([(page,)], "html string").select(html_elements("html").alias("elements"))
    live = blocks.with_spans(df).withColumn("live", blocks.live_items(F.col("items"), F.col("kept")))
    got = live.select(blocks.labelled(F.col("live")).alias("x")).first().x
    assert [(x.role, x.label) for x in got] == [
        ("prompt", "Race"), ("value", "Race"), ("break", "Race"), ("break", "Race"), ("value", "Sex"), ("value", "Sex")
    ]


def test_flags_name_the_listed_classes(spark):
    """Each element says in one number which of the listed classes it has, whatever their order and other classes."""
    page = "<span class='big Value'>a</span><span class='Prompt Value Prompt'>b</span><span class=other>c</span><hr>"
    df = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    found = df.select(html_elements("html", classes=("Prompt", "Value")).alias("e")).collect()
    assert [e["flags"] for e in found[0].e] == [2, 3, 0, 0]
    assert found[1].e is None and found[2].e == []


def test_titles_are_carried_over_blocks(spark):
    """Blocks before any header take the default title, others the latest header's; nothing else changes."""
    blank = "cast(null as string) as title"
    df = spark.sql(f"SELECT array(named_struct('title', title, 'n', 1)) AS bs FROM (SELECT {blank})")
    df = df.select(F.concat("bs", *[F.array(F.struct(F.lit(t).cast("string").alias("title"), F.lit(n).alias("n"))) for t, n in (("A", 2), (None, 3), ("B", 4), (None, 5))]).alias("bs"))
    got = df.select(blocks.titled(F.col("bs")).alias("t")).first().t
    assert [(b.title, b.n) for b in got] == [("Case Information", 1), ("A", 2), ("A", 3), ("B", 4), ("B", 5)]
    assert df.select(blocks.titled(F.slice("bs", 1, 0)).alias("t")).first().t == []


def test_span_queries_parse_the_pages_once(spark, monkeypatch):
    """The queries on look-ahead reads share one staged parse."""
    from courtloom.plans import queries, staging

    monkeypatch.setattr(staging, "_STAGED", {})
    folder = "/root/testdata/sf0.001"
    for name in ("statute_code", "term_interval", "event_table_rows", "anchor_intervals"):
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" not in plan and "explode_html" not in plan
    assert [key[2] for key in staging._STAGED] == ["raw", "spans"]


ODD_PAGES = [
    "<i>Disposition</i><left><i> Disposition </i><i>Other</i></left><h6 class=InfoChargeStatement>s</h6><h6>t</h6><hr>",
    "<span class='Prompt Value'>Both?:</span><span class='Value AltBodyWindowDcCivil'>gone</span><span>none</span>",
    "<span class=Value>before any prompt</span><th><span class=FirstColumnPrompt> : </span></th><span class=Prompt>:</span>",
    "<span class=Prompt> Na me ?:</span><span class=Value>a b</span>" + P("Jail Term:") + P("Yrs:") * 9 + V("x"),
    "",
    "no tags",
    None,
]


def test_items_made_in_the_walk_equal_items_of_elements(spark):
    """Roles, labels and latest prompts read where the pages are walked are those read from elements, page by page."""
    from courtloom.sources.elements import html_items

    df = spark.createDataFrame([(p,) for p in ODD_PAGES], "html string").coalesce(1)
    df = df.select(html_items("html").alias("a"), html_elements("html").alias("elements"))
    got = df.select("a", blocks.items(F.col("elements")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert [x.since for x in got[2].a] == [None, 1, 2] and got[6].a is None and got[4].a == []
    assert spark.createDataFrame([], "html string").select(html_items("html")).collect() == []


def test_a_span_label_holds_until_the_next_prompt_behind_it(spark):
    """Prompts inside a span are gone with it: a value behind the span stands under the span's own prompt."""
    page = header("Charge Information") + P("Jail Term:") + P("Yrs:") + V("1") + P("Mos:") + V("2") + P("Days:")
    page += V("3") + P("Hours:") + V("4") + V("behind") + P("Plea:") + V("G")
    pages = spark.createDataFrame([("1", page)], "case_id string, html string")
    entry = normalize.parse_pages(pages).first().entries[0]
    assert entry["raw"] == {"jail_term": "behind", "plea": "G"}


def test_parse_writes_few_rows_between_its_stages(spark):
    """Stages share one expression where none needs the other's column, so arrays are not written out between them."""
    raw = spark.createDataFrame([("x", "<hr>")], "case_id string, html string")
    plan = normalize.parse_pages(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") <= 2


SPAN_PAGES = ODD_PAGES + [
    header("Charge Information") + "".join(STATUTE) + "<hr>" + P("Jail Term:") + "".join(TERM) + V("behind") + P("Plea:") + V("G"),
    "".join(STATUTE[:7]) + P("Probation:") + P("Supervised") + "".join(TERM) + "<i>Fine</i>" + V("MONEY JUDGMENT") + V("A") + V("B"),
    EVENTS + V("HEAR") + V("1/2/2016") + V("TRIAL") + "<hr>" + "<th>" + P("Event Type") + P("Event Type") + "</th>" + V("x") * 3,
    P("Jail Term:") + P("Yrs:") + V("2147483648") + P("Mos:") + V("13") + "".join(TERM[4:]),
    P("Article:") + V("CR") + P("Sec:"),
]


@pytest.mark.parametrize("lossy", [False, True])
def test_blocks_read_in_the_walk_equal_the_column_expressions(spark, lossy):
    from courtloom.functions.arrays import let
    from courtloom.sources.elements import html_items

    def built(xs):
        kept = blocks.keep_spans(blocks.spans(xs, lossy))
        return blocks.titled(blocks.blocks(let(blocks.live_items(xs, kept), blocks.labelled)))

    df = spark.createDataFrame([(p,) for p in SPAN_PAGES], "html string").coalesce(1)
    df = blocks.with_blocks(df, lossy, html_items("html")).withColumnRenamed("blocks", "a").withColumn("items", html_items("html"))
    got = blocks.with_blocks(df.withColumn("b", let(F.col("items"), built)), lossy).collect()
    assert [r.a for r in got] == [r.b for r in got] == [r.blocks for r in got]
    assert got[6].a is None and got[4].a == [] and len(got[-2].a[0].pairs) == 1


def test_items_of_a_parse_never_leave_the_worker(spark):
    """Items and blocks come out of one pass; the plan holds no item, span or header expression."""
    raw = spark.createDataFrame([("x", "<hr>")], "case_id string, html string")
    plan = normalize.parse_pages(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("build_blocks(explode_items(") == 1 and "holds_value" not in plan and "Event Date" in plan


def test_a_term_beyond_all_numbers_is_no_term(spark):
    """Years that overflow once months carry over gave an error that ended the job."""
    page = header("Charge Information") + P("Jail Term:") + P("Yrs:") + V("2147483647") + P("Mos:") + V("13") + "".join(TERM[4:])
    raw = spark.createDataFrame([("x", page)], "case_id string, html string")
    assert normalize.parse_pages(raw).first().entries[0]["attrs"] == {"jail_term": None}


def test_known_pieces_of_pages_are_read_once():
    from courtloom.sources import elements

    tokens = []
    read = lambda token: tokens.append(token) or elements.read_token(token)
    known = {}
    pages = ['<span class="a">x</span> y<hr/>'] * 3 + ["<i title='a > b'>&lt;</i><!-- <hr> --><i a=\"<i>\">z</i>< <hr/"]
    found = [elements.walk(page, frozenset({"span", "hr", "i"}), elements.class_list, read, known) for page in pages]
    assert tokens == ['<span class="a">', "</span>", "<hr/>", "<i title='a > b'>", "</i>", "<!-- <hr> -->", '<i a="<i>">']
    assert [f[3] for f in found] == [["x", ""]] * 3 + [["<", "z"]]
