"""Docket tables and case pages derived from the TPC-H-like sample tables.

`VIEWS` is the input specification in SQL that Spark and other engines share;
`raw_pages` renders the `facts` view as one HTML page per order. A page is built
from one joined row, so no page depends on the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtloom.functions.text import format_mdy
from courtloom.session import spread
from courtloom.sources.tables import parquet

CASES = """
SELECT CAST(o_orderkey AS string) AS case_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'District Court ' || o_orderstatus || ' - Criminal System'
    WHEN 1 THEN 'Circuit Court ' || o_orderstatus || ' - Criminal'
    WHEN 2 THEN 'District Court ' || o_orderstatus || ' - Traffic System'
    WHEN 3 THEN 'Circuit Court ' || o_orderstatus || ' - Civil System'
    ELSE 'District Court ' || o_orderstatus || ' Civil Citation System' END AS court_system,
  CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN o_orderpriority
    ELSE o_orderpriority || '/' || CAST(o_orderkey % 5 AS string) END AS type,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS date) END AS filing_date
FROM {orders}
"""

PERSON = """
  CASE c_custkey % 8 WHEN 0 THEN 'BLACK, AFRICAN AMERICAN' WHEN 1 THEN 'Black' WHEN 2 THEN 'White'
    WHEN 3 THEN 'Caucasian' WHEN 4 THEN 'INDIAN' WHEN 5 THEN 'Hispanic' WHEN 6 THEN 'UNKNOWN,OTHER' ELSE '' END AS race,
  CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS sex,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(60 + c_custkey % 18 AS int) END AS height,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(120 + c_custkey % 100 AS int) END AS weight,
  CASE c_nationkey % 4 WHEN 0 THEN 'MD' WHEN 1 THEN 'VA' WHEN 2 THEN 'DC' ELSE 'PA' END AS state, n_name AS city,
  CASE c_custkey % 6 WHEN 0 THEN '21201-1234' WHEN 1 THEN '2120'
    ELSE lpad(CAST(c_custkey AS string), 5, '0') END AS zip
"""

PARTIES = f"""
SELECT CAST(o_orderkey AS string) AS case_id, c_name AS name,
  CASE k WHEN 0 THEN 'Defendant' ELSE 'Plaintiff/Petitioner' END AS type, {PERSON}
FROM (SELECT o_orderkey, o_custkey, <both sides> AS k FROM {{orders}}) o
JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
WHERE k = 0 OR o_orderkey % 3 = 0
"""

CHARGES = """
SELECT CAST(l_orderkey AS string) AS case_id, p_name AS description,
  CASE l_partkey % 8 WHEN 0 THEN 'Guilty' WHEN 1 THEN '1:Guilty' WHEN 2 THEN 'Nolle Prosequi' WHEN 3 THEN 'Not Guilty'
    WHEN 4 THEN 'Stet' WHEN 5 THEN '1:Merged' WHEN 6 THEN '' ELSE 'Unlisted' END AS disposition
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

FACTS = f"""
SELECT o_orderkey AS k, CAST(o_orderkey AS string) AS case_id, c_name AS name, o_orderstatus AS status,
  o_orderpriority AS priority, CAST(o_orderdate AS date) AS day, {PERSON}
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
"""

VIEWS = {"docket_cases": CASES, "docket_parties": PARTIES, "docket_charges": CHARGES, "facts": FACTS}
BASE = ("orders", "customer", "nation", "lineitem", "part")


def view_sql(name: str) -> str:
    """Text of a view over tables of the usual names, in standard SQL."""
    return VIEWS[name].replace("<both sides>", "unnest([0, 1])").format(**{t: t for t in BASE}).strip()


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over the sample tables of a folder."""
    text = VIEWS[name].replace("<both sides>", "explode(array(0, 1))")
    used = {t: parquet(spark, folder, t) for t in BASE if "{" + t + "}" in text}
    return spark.sql(text, **used)


def _prompt(label: str) -> Column:
    return F.lit(f'<span class="Prompt">{label}</span>')


def _value(value) -> Column:
    content = value if isinstance(value, Column) else F.lit(value)
    return F.concat(F.lit('<td>\n<span class="big Value"> '), F.coalesce(content, F.lit("")), F.lit(" </span></td>"))


def _pair(label: str, value) -> Column:
    return F.concat(_prompt(label), _value(value))


def _header(title: str) -> Column:
    return F.lit(f"<h5>{title}</h5>")


def _when(condition: Column, *parts: Column) -> Column:
    return F.when(condition, F.concat(*parts)).otherwise("")


def _rule() -> Column:
    return F.lit("<hr>")


def _charge(j: int) -> Column:
    k, n = F.col("k"), F.col("k") + j
    term_names = F.when(n % 10 == 0, "Suspended Term:").otherwise("Yrs:")
    return F.concat(
        _pair("Charge Description:", F.concat(F.lit("Count "), F.lit(str(j)), F.lit(" &amp; "), F.col("priority"))),
        _when(
            n % 2 == 0,
            _pair("Article:", "CR"),
            _pair("Sec:", (n % 9).cast("string")),
            _pair("Sub-Sec:", F.when(n % 4 == 0, F.lit("")).otherwise(F.lit("203"))),
            _pair("Para:", ""),
            _pair("Code:", "a"),
        ),
        _pair("Plea:", F.when(n % 3 == 0, "NG").otherwise("G")),
        F.lit("<left><i>Disposition</i></left>"),
        _pair("Disposition:", F.element_at(F.array(*map(F.lit, ("Guilty", "Stet", "Not Guilty"))), (n % 3 + 1).cast("int"))),
        _pair("Disposition Date:", format_mdy(F.col("day"))),
        _when(
            n % 5 != 4,
            _prompt("Jail Term:"),
            F.concat(F.lit('<span class="FirstColumnPrompt">'), term_names, F.lit("</span>")),
            _value((n % 3).cast("string")),
            _pair("Mos:", (n % 20).cast("string")),
            _pair("Days:", F.when(n % 7 == 0, F.lit("")).otherwise((n % 7).cast("string"))),
            _pair("Hours:", (n % 24).cast("string")),
        ),
        _pair("Probable Cause Indicator:", F.when(n % 2 == 0, "YES").otherwise("no")),
        _pair("Personal Injury:", F.when(n % 4 == 0, "None").otherwise((n % 4).cast("string"))),
        _pair("Fine Amt:", F.concat(F.lit("$1,"), F.lpad((n % 1000).cast("string"), 3, "0"), F.lit(".50"))),
        _rule(),
    )


def _page() -> Column:
    k, day = F.col("k"), F.col("day")
    feet = F.concat(
        F.floor(F.col("height") / 12).cast("string"), F.lit("'"), (F.col("height") % 12).cast("string"), F.lit('"')
    )
    filed = F.when(k % 13 == 0, F.lit("")).when(k % 5 == 1, F.date_format(day, "MM/yyyy")).otherwise(format_mdy(day))
    person = F.concat(
        _pair("Name:", F.concat(F.col("name"), F.lit(",&nbsp; JR"))),
        _pair("Race:", F.col("race")),
        _pair("Sex:", F.when(F.col("sex") == "F", "female").otherwise("male")),
        _pair("Height:", feet),
        _pair("Weight:", F.col("weight").cast("string")),
        _pair("City:", F.col("city")),
        _pair("State:", F.col("state")),
        _pair("Zip Code:", F.col("zip")),
    )
    events = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.lit(3)),
            lambda j: F.when(
                j <= k % 4,
                F.concat(
                    _value(F.concat(F.lit("HEAR "), j.cast("string"))),
                    _value(format_mdy(day)),
                ),
            ).otherwise(""),
        ),
        "",
    )
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>Case</title><script>var t='<span>';</script></head><body><!-- <hr> -->"),
        _header("Case Information"),
        _pair("Court System:", F.concat(F.lit("Circuit Court "), F.col("status"), F.lit(" -\n Criminal"))),
        _when(k % 6 == 0, _pair("Citation Number:", F.concat(F.lit("C"), F.col("case_id")))),
        _when(k % 29 != 0, _pair("Case Number:", F.col("case_id"))),
        _pair("Case Type:", F.col("priority")),
        _pair("Filing Date:", filed),
        _pair("Case Status:", "Opened"),
        _value(F.col("status")),
        F.lit('<span class="AltBodyWindowDcCivil Value">ignored</span>'),
        _rule(),
        _header("Defendant Information"),
        person,
        F.lit('<h6 class="InfoChargeStatement">Statement</h6>'),
        _pair("DOB:", F.date_format(day, "MM/yyyy")),
        _rule(),
        _when(k % 3 == 0, _header("Plaintiff/Petitioner Information"), person, _rule()),
        _header("Attorney(s) for the Defendant"),
        _pair("Name:", F.concat(F.lit("ROE "), F.col("case_id"))),
        _pair("Appearance Date:", F.when(k % 2 == 0, format_mdy(day))),
        _rule(),
        _pair("Name:", F.when(k % 5 == 0, "State Attorney Office").otherwise("POE")),
        _rule(),
        _header("Related Persons Information"),
        _pair("Name:", F.concat(F.lit("MOE "), F.col("case_id"))),
        _pair("Party Type:", F.when(k % 4 == 0, "ATTORNEY for Plaintiff").otherwise("Witness")),
        _rule(),
        _header("Charge Information"),
        *[_when(k % 3 >= j, _charge(j)) for j in range(3)],
        _header("Case History Information"),
        F.lit("<table><tr><th>"),
        _prompt("Event Type"),
        F.lit("</th><th>"),
        _prompt("Event Date"),
        F.lit("</th></tr>"),
        events,
        _when(k % 7 == 0, _value("SHORT")),
        _rule(),
        _header("Document Tracking"),
        _pair("Document Name:", F.concat(F.lit("Form "), (k % 50).cast("string"))),
        _pair("File Date:", format_mdy(day)),
        _rule(),
        _header("Unknown Title"),
        _pair("Name:", "NOBODY"),
        _rule(),
        _when(
            k % 8 == 0,
            _header("Judgement Information"),
            _pair("Amount:", F.concat((k % 500).cast("string"), F.lit(".25"))),
            _value("MONEY JUDGMENT"),
            _pair("Is Awarded To The:", "Plaintiff"),
            _rule(),
        ),
        _when(
            k % 9 == 0,
            _header("Complaint Information"),
            _pair("Vs:", F.col("name")),
            _pair("Complaint Status:", "Open"),
            _rule(),
        ),
        F.lit("</body></html>"),
    )


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """`(case_id, html)`: a page per order. Every 29th names no case, every 31st comes twice under two raw ids."""
    copies = F.when(F.col("k") % 31 == 0, F.array(F.lit(""), F.lit("copy-"))).otherwise(F.array(F.lit("")))
    facts = spread(view(spark, folder, "facts"), "case_id")
    return facts.select(F.explode(copies).alias("prefix"), *facts.columns).select(
        F.concat("prefix", "case_id").alias("case_id"), _page().alias("html")
    )


def stored_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Case ids that count as stored already."""
    return (
        parquet(spark, folder, "orders")
        .where(F.col("o_orderkey") % 4 == 1)
        .select(F.col("o_orderkey").cast("string").alias("case_id"))
    )
