"""Independent SQL statement of each query's result, for comparison in another engine.

Page queries are stated over the `facts` the pages were rendered from, so they
check the whole way from HTML back to values.
"""

from __future__ import annotations

from pyspark.sql.types import IntegerType

from courtloom.schemas import TABLE_COLUMNS, column_fields
from courtloom.sources.demo import view_sql

CHECKS = {}


def _with(names: str, body: str) -> str:
    ctes = {n: view_sql(n) for n in ("docket_cases", "docket_parties", "docket_charges", "facts")}
    ctes["loaded"] = """SELECT *, CASE WHEN k % 29 <> 0 THEN case_id ELSE 'C' || case_id END AS cid,
      CAST(date_trunc('month', day) AS date) AS month, strftime(day, '%-m/%-d/%Y') AS mdy, strftime(day, '%m/01/%Y') AS my
      FROM facts WHERE k % 29 <> 0 OR k % 6 = 0"""
    ctes["paged"] = """SELECT *, prefix || case_id AS raw_case_id, strftime(day, '%-m/%-d/%Y') AS mdy, strftime(day, '%m/%Y') AS my
      FROM facts CROSS JOIN (SELECT '' AS prefix UNION ALL SELECT 'copy-' AS prefix) p WHERE prefix = '' OR k % 31 = 0"""
    ctes["counts"] = "SELECT unnest([0, 1, 2]) AS j"
    ctes["steps"] = "SELECT unnest([0, 1, 2, 3]) AS step"
    ctes["charge_facts"] = """SELECT *, k + j AS n, (k + j) % 3 AS yrs, (k + j) % 20 AS mos, (k + j) % 7 AS days, (k + j) % 24 AS hrs
      FROM loaded CROSS JOIN counts WHERE k % 3 >= j"""
    ctes["paged_charges"] = """SELECT *, k + j AS n, (k + j) % 3 AS yrs, (k + j) % 20 AS mos, (k + j) % 7 AS days, (k + j) % 24 AS hrs
      FROM paged CROSS JOIN counts WHERE k % 3 >= j"""
    ctes["paged_events"] = """SELECT *, 'HEAR ' || CAST(step AS varchar) AS event_type, mdy AS event_date FROM paged CROSS JOIN steps
      WHERE step >= 1 AND step <= k % 4 UNION ALL SELECT *, 'SHORT', CAST(NULL AS varchar) FROM paged CROSS JOIN steps WHERE step = 0 AND k % 7 = 0"""
    ctes["events_loaded"] = """SELECT cid, k, 'HEAR ' || CAST(step AS varchar) AS event_type, day AS event_date, mdy
      FROM loaded CROSS JOIN steps WHERE step >= 1 AND step <= k % 4
      UNION ALL SELECT cid, k, 'SHORT', NULL, NULL FROM loaded WHERE k % 7 = 0"""
    ctes["result_links"] = """SELECT page_id, k, i, 'inquiry-' || CASE WHEN i % 4 = 3 THEN 'results.jis?sort='
        WHEN i % 7 = 6 THEN 'detail.jis?case' WHEN k % 7 = 6 THEN 'detail.jis?case-' ELSE 'detail.jis?caseId=' END
        || CAST((k * 37 + i) % 15013 AS varchar) || '&loc=2' AS href, i AS pos,
        CASE WHEN i % 4 = 3 OR i % 7 = 6 OR k % 7 = 6 THEN NULL ELSE CAST((k * 37 + i) % 15013 AS varchar) END AS case_id
      FROM (SELECT page_id, page_id AS k, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS i FROM pages) WHERE i < k % 9 AND k % 10 <> 4"""
    ctes["families"] = """SELECT family, rank FROM (VALUES ('criminal', 1), ('civil', 2), ('civil citation', 3), ('traffic', 4)) f(family, rank)"""
    ctes["types"] = """SELECT DISTINCT family, type, rank FROM docket_cases JOIN families ON contains(lower(court_system), family)
      AND NOT (family = 'civil' AND contains(lower(court_system), 'civil citation')) WHERE nullif(type, '') IS NOT NULL"""
    ctes["extract"] = """SELECT c.case_id, h.disposition, c.court_system, c.type, c.filing_date, p.race, p.sex, p.height, p.weight, p.state,
        p.city, substr(p.zip, 1, 5) AS zip, h.description
      FROM docket_cases c JOIN docket_parties p ON c.case_id = p.case_id JOIN docket_charges h ON c.case_id = h.case_id
      WHERE nullif(h.disposition, '') IS NOT NULL AND nullif(c.court_system, '') IS NOT NULL AND nullif(c.type, '') IS NOT NULL
        AND c.filing_date IS NOT NULL AND nullif(p.race, '') IS NOT NULL AND nullif(p.sex, '') IS NOT NULL
        AND p.height IS NOT NULL AND p.weight IS NOT NULL AND nullif(p.state, '') IS NOT NULL AND nullif(p.city, '') IS NOT NULL
        AND nullif(p.zip, '') IS NOT NULL AND nullif(h.description, '') IS NOT NULL
        AND lower(p.type) LIKE '%defendant%' AND length(p.zip) = 5"""
    ctes["kinds"] = """SELECT case_id, filing_date, CASE split_part(court_system, '-', 2) WHEN ' Criminal System' THEN 'criminal'
        WHEN ' Criminal' THEN 'criminal' WHEN ' Traffic System' THEN 'traffic' WHEN '' THEN NULL
        ELSE split_part(court_system, '-', 2) END AS kind, court_system FROM docket_cases"""
    ctes["type_bucket"] = "SELECT type, arg_min(family, rank) AS family FROM types GROUP BY type"
    ctes["bucketed"] = """SELECT e.*, CASE WHEN contains(disposition, ':') THEN
          CASE split_part(disposition, ':', 2) WHEN 'Guilty' THEN 'guilty' WHEN 'Not Guilty' THEN 'not-guilty' ELSE 'in-process' END
        WHEN disposition = 'Guilty' THEN 'guilty' WHEN disposition IN ('Nolle Prosequi', 'Not Guilty') THEN 'not-guilty'
        WHEN disposition = 'Stet' THEN 'in-process' ELSE disposition END AS outcome,
        split_part(court_system, '-', 1) AS courtname, coalesce(family, e.type) AS casetype,
        CASE WHEN race IN ('BLACK, AFRICAN AMERICAN', 'Black') THEN 'black' WHEN race IN ('White', 'Caucasian') THEN 'white'
          WHEN race = 'INDIAN' THEN 'asian' WHEN race = 'Hispanic' THEN 'hispanic' WHEN race = 'UNKNOWN,OTHER' THEN 'other'
          ELSE race END AS race_bucket
      FROM extract e LEFT JOIN type_bucket t ON e.type = t.type"""
    ctes["extract_cases"] = "SELECT DISTINCT e.case_id, e.filing_date, k.kind FROM extract e JOIN kinds k ON e.case_id = k.case_id"
    ctes["filled"] = """SELECT case_id, coalesce(last_value(kind IGNORE NULLS) OVER (ORDER BY filing_date, substr(md5(case_id), 1, 2), case_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'courttype') AS courttype FROM extract_cases"""
    ctes["general"] = """SELECT b.case_id, outcome, courttype, courtname, casetype, race_bucket AS race, sex, height, weight, state, zip, description
      FROM bucketed b JOIN filled f ON b.case_id = f.case_id"""
    ctes["decided"] = "SELECT case_id, outcome, courttype, courtname, casetype, race, sex, height, weight, state, zip FROM general WHERE outcome IN ('guilty', 'not-guilty')"
    wanted = names.split()
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in ctes if n in wanted) + "\n" + body


PAGED = "facts paged"
LOADED = "facts loaded"
CHARGED = "facts loaded counts charge_facts"
EVENTFUL = "facts loaded steps events_loaded"
TYPED = "docket_cases families types"
EXTRACT = "docket_cases docket_parties docket_charges extract"
BUCKETED = f"{EXTRACT} families types type_bucket bucketed"
GENERAL = f"{BUCKETED} kinds extract_cases filled general decided"

# Texts as they stand on a page, by page fact.
HEIGHT = "CASE WHEN height IS NULL THEN '' ELSE CAST(height // 12 AS varchar) || '''' || CAST(height % 12 AS varchar) || '\"' END"
FILED = "CASE WHEN k % 13 = 0 THEN '' WHEN k % 5 = 1 THEN my ELSE mdy END"
STATUTE = "'CR.' || CAST(n % 9 AS varchar) || CASE WHEN n % 4 = 0 THEN '' ELSE '.203' END || '.a'"
TERM = """CAST(CASE WHEN mos > 12 THEN yrs + mos // 12 ELSE yrs END AS varchar) || '-' ||
 CAST(CASE WHEN mos > 12 THEN mos % 12 ELSE mos END AS varchar) || ' ' || CAST(days AS varchar) || ' ' || CAST(hrs AS varchar) || ':00:00'"""
FINE = "'$1,' || lpad(CAST(n % 1000 AS varchar), 3, '0') || '.50'"
DISPOSITION = "CASE n % 3 WHEN 0 THEN 'Guilty' WHEN 1 THEN 'Stet' ELSE 'Not Guilty' END"
COURT = "'Circuit Court ' || status || ' - Criminal'"
AMOUNT = "CAST(k % 500 AS varchar) || '.25'"


def _person(title, extra=""):
    return [
        (title, "Name", "name || ', JR'", extra),
        (title, "Race", "race", extra),
        (title, "Sex", "CASE sex WHEN 'F' THEN 'female' ELSE 'male' END", extra),
        (title, "Height", HEIGHT, extra),
        (title, "Weight", "coalesce(CAST(weight AS varchar), '')", extra),
        (title, "City", "city", extra),
        (title, "State", "state", extra),
        (title, "Zip Code", "zip", extra),
    ]


# Every label/value of a page: section, label, text, and the pages that have it.
PAIRS = [
    ("Case Information", "Court System", COURT, ""),
    ("Case Information", "Citation Number", "'C' || case_id", "k % 6 = 0"),
    ("Case Information", "Case Number", "case_id", "k % 29 <> 0"),
    ("Case Information", "Case Type", "priority", ""),
    ("Case Information", "Filing Date", FILED, ""),
    ("Case Information", "Case Status", "status", ""),
    *_person("Defendant Information"),
    ("Defendant Information", "DOB", "my", ""),
    *_person("Plaintiff/Petitioner Information", "k % 3 = 0"),
    ("Attorney(s) for the Defendant", "Name", "'ROE ' || case_id", ""),
    ("Attorney(s) for the Defendant", "Appearance Date", "CASE WHEN k % 2 = 0 THEN mdy ELSE '' END", ""),
    ("Attorney(s) for the Defendant", "Name", "CASE WHEN k % 5 = 0 THEN 'State Attorney Office' ELSE 'POE' END", ""),
    ("Related Persons Information", "Name", "'MOE ' || case_id", ""),
    ("Related Persons Information", "Party Type", "CASE WHEN k % 4 = 0 THEN 'ATTORNEY for Plaintiff' ELSE 'Witness' END", ""),
    ("Document Tracking", "Document Name", "'Form ' || CAST(k % 50 AS varchar)", ""),
    ("Document Tracking", "File Date", "mdy", ""),
    ("Unknown Title", "Name", "'NOBODY'", ""),
    ("Judgement Information", "Amount", AMOUNT, "k % 8 = 0"),
    ("Judgement Information", "Is Awarded To The", "'Plaintiff'", "k % 8 = 0"),
    ("Complaint Information", "Vs", "name", "k % 9 = 0"),
    ("Complaint Information", "Complaint Status", "'Open'", "k % 9 = 0"),
]
CHARGE_PAIRS = [
    ("Charge Description", "'Count ' || CAST(j AS varchar) || ' & ' || priority", ""),
    ("Statute Code", STATUTE, "n % 2 = 0"),
    ("Plea", "CASE WHEN n % 3 = 0 THEN 'NG' ELSE 'G' END", ""),
    ("Disposition", DISPOSITION, ""),
    ("Disposition Date", "mdy", ""),
    ("Jail Term", TERM, "n % 5 <> 4"),
    ("Probable Cause Indicator", "CASE WHEN n % 2 = 0 THEN 'YES' ELSE 'no' END", ""),
    ("Personal Injury", "CASE WHEN n % 4 = 0 THEN 'None' ELSE CAST(n % 4 AS varchar) END", ""),
    ("Fine Amt", FINE, ""),
]


def _pairs(extra: list[str]) -> str:
    where = lambda condition: f" WHERE {condition}" if condition else ""
    rows = [
        f"SELECT raw_case_id, '{t}' AS title, '{l}' AS label, {v} AS value FROM paged{where(c)}" for t, l, v, c in PAIRS
    ]
    rows += [
        f"SELECT raw_case_id, 'Charge Information', '{l}', {v} FROM paged_charges{where(c)}" for l, v, c in CHARGE_PAIRS
    ]
    return "\nUNION ALL ".join(rows + extra)


PAGE_NAMES = f"{PAGED} counts steps paged_charges paged_events"
CHECKS["doc_kv_pairs"] = _with(
    PAGE_NAMES, _pairs(["SELECT raw_case_id, 'Case Information', 'Case Status', 'Opened' FROM paged"])
)
CHECKS["doc_kv_last_wins"] = _with(
    PAGE_NAMES,
    _pairs(
        [
            "SELECT raw_case_id, 'Case History Information', 'Event Type', event_type FROM paged_events",
            "SELECT raw_case_id, 'Case History Information', 'Event Date', event_date FROM paged_events WHERE event_date IS NOT NULL",
        ]
    ),
)

# Entries of a page by section: how many, and which table keeps them.
SECTIONS = [
    ("Case Information", "cases", "1"),
    ("Defendant Information", "parties", "1"),
    ("Plaintiff/Petitioner Information", "parties", "CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END"),
    ("Attorney(s) for the Defendant", None, "2"),
    ("Related Persons Information", None, "1"),
    ("Charge Information", "charges", "k % 3 + 1"),
    ("Case History Information", "events", "k % 4 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END"),
    ("Document Tracking", "documents", "1"),
    ("Unknown Title", None, "1"),
    ("Judgement Information", "judgements", "CASE WHEN k % 8 = 0 THEN 1 ELSE 0 END"),
    ("Complaint Information", "complaints", "CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END"),
]
CHECKS["doc_blocks"] = _with(
    PAGED,
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT raw_case_id, '{t}' AS title, CAST({n} AS bigint) AS n_entries FROM paged" for t, _, n in SECTIONS)
    + ") WHERE n_entries > 0",
)
ROUTED = [(t, table, n) for t, table, n in SECTIONS if table] + [
    ("Attorney(s) for the Defendant", "attorneys", "CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END"),
    ("Related Persons Information", "attorneys", "CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END"),
    ("Related Persons Information", "parties", "CASE WHEN k % 4 = 0 THEN 0 ELSE 1 END"),
]


def _routed(source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{table}' AS \"table\", '{t}' AS title, {n} AS n FROM {source}" for t, table, n in ROUTED)


CHECKS["section_route"] = _with(
    PAGED, f'SELECT "table", title, CAST(sum(n) AS bigint) AS n_entries FROM ({_routed("paged")}) GROUP BY ALL HAVING sum(n) > 0'
)
CHECKS["load_counts"] = _with(
    LOADED, f'SELECT "table", CAST(sum(n) AS bigint) AS n_rows FROM ({_routed("loaded")}) GROUP BY ALL HAVING sum(n) > 0'
)
_per_case = " UNION ALL ".join(f"SELECT '{table}' AS \"table\", cid, {n} AS n FROM loaded" for _, table, n in ROUTED)
CHECKS["incremental_load"] = _with(
    LOADED,
    'SELECT "table", CAST(sum(n) AS bigint) AS n_rows, count(DISTINCT CASE WHEN n > 0 THEN cid END) AS n_cases '
    f"FROM ({_per_case}) GROUP BY ALL HAVING sum(n) > 0",
)
CHECKS["incremental_dedupe"] = _with(PAGED, "SELECT raw_case_id AS case_id, 1 AS copies FROM paged")

CHECKS["scan_raw_pages"] = _with(
    PAGED, "SELECT raw_case_id AS case_id, CASE WHEN k % 29 <> 0 THEN 'true' ELSE 'false' END AS names_case FROM paged"
)
CHECKS["unparsed_pages"] = _with(PAGED, "SELECT raw_case_id AS case_id FROM paged WHERE NOT (prefix = '' AND k % 4 = 1)")
CHECKS["page_slice"] = _with(PAGED, "SELECT raw_case_id AS case_id FROM paged ORDER BY raw_case_id LIMIT 50 OFFSET 100")
CHECKS["attr_collision"] = _with(
    PAGED,
    "SELECT raw_case_id, CASE WHEN k % 29 <> 0 THEN case_id WHEN k % 6 = 0 THEN 'C' || case_id END AS case_id FROM paged",
)
CHECKS["nonsense_rejects"] = _with(
    PAGED, "SELECT raw_case_id, 'nonsense' AS reason FROM paged WHERE k % 29 = 0 AND k % 6 <> 0"
)
CHECKS["duplicate_rejects"] = _with(
    PAGED,
    """SELECT raw_case_id, cid AS case_id, 'duplicate' AS reason, 1 AS pages FROM
    (SELECT *, CASE WHEN k % 29 <> 0 THEN case_id WHEN k % 6 = 0 THEN 'C' || case_id END AS cid FROM paged)
    WHERE cid IS NOT NULL AND (prefix <> '' OR (k % 29 <> 0 AND k % 4 = 1))""",
)
CHECKS["raw_after_rejects"] = _with(
    PAGED, "SELECT raw_case_id AS case_id FROM paged WHERE prefix = '' AND NOT (k % 29 = 0 AND k % 6 <> 0)"
)
CHECKS["value_rejects"] = """
SELECT CAST(o_orderkey AS varchar) AS raw_case_id, CAST(o_orderkey AS varchar) AS case_id, 'cases' AS "table", 'filing_date' AS attribute,
  'soon' AS value FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT CAST(o_orderkey AS varchar), CAST(o_orderkey AS varchar), 'parties', 'height', 'x''9"' FROM orders WHERE o_orderkey % 5 = 0"""

CHECKS["statute_code"] = _with(PAGE_NAMES, f"SELECT raw_case_id, {STATUTE} AS code FROM paged_charges WHERE n % 2 = 0")
CHECKS["term_interval"] = _with(
    PAGE_NAMES,
    f"""SELECT raw_case_id, 'Jail Term' AS label, {TERM} AS term, CAST(yrs * 12 + mos AS int) AS months, CAST(days AS int) AS days,
    CAST(hrs AS int) AS hours FROM paged_charges WHERE n % 5 <> 4""",
)
CHECKS["event_table_rows"] = _with(PAGE_NAMES, "SELECT raw_case_id, event_type, event_date FROM paged_events")
CHECKS["anchor_intervals"] = _with(
    PAGE_NAMES,
    """SELECT raw_case_id, CAST(1 + sum(CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN n % 5 <> 4 THEN 1 ELSE 0 END
    + CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END) AS int) AS n_spans,
    CAST(1 + sum(CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN n % 5 <> 4 THEN 1 ELSE 0 END) AS int) AS n_kept
    FROM paged_charges GROUP BY raw_case_id""",
)
CHECKS["attorney_entries"] = _with(
    PAGED,
    """SELECT raw_case_id, 'ROE ' || case_id AS name, 'Defendant' AS type FROM paged WHERE k % 2 = 0
    UNION ALL SELECT raw_case_id, 'State Attorney Office', 'Defendant' FROM paged WHERE k % 5 = 0""",
)
CHECKS["party_type"] = _with(
    PAGED,
    """SELECT raw_case_id, 'Defendant Information' AS title, 'Defendant' AS type FROM paged
    UNION ALL SELECT raw_case_id, 'Plaintiff/Petitioner Information', 'Plaintiff/Petitioner' FROM paged WHERE k % 3 = 0
    UNION ALL SELECT raw_case_id, 'Related Persons Information', 'Witness' FROM paged WHERE k % 4 <> 0""",
)
CHECKS["attorney_relocation"] = _with(
    PAGED,
    "SELECT raw_case_id, 'attorneys' AS \"table\", 'MOE ' || case_id AS name, 'Plaintiff' AS type FROM paged WHERE k % 4 = 0",
)

# Stored rows: table, source, condition, and the columns that are not NULL as (typed value, text value).
DAY = ("day", "mdy")
STORED = [
    (
        "cases",
        "loaded",
        "",
        {
            "court_system": (COURT,),
            "type": ("priority",),
            "filing_date": (
                "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 1 THEN month ELSE day END",
                "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 1 THEN my ELSE mdy END",
            ),
            "status": ("status",),
        },
    ),
    *[
        (
            "parties",
            "loaded",
            condition,
            {
                "name": ("name || ', JR'",),
                "type": (f"'{kind}'",),
                "race": ("nullif(race, '')",),
                "sex": ("sex",),
                "height": ("height", "CAST(height AS varchar)"),
                "weight": ("weight", "CAST(weight AS varchar)"),
                **({"dob": ("month", "my")} if kind == "Defendant" else {}),
                "city": ("city",),
                "state": ("state",),
                "zip": ("zip",),
            },
        )
        for kind, condition in (("Defendant", ""), ("Plaintiff/Petitioner", "k % 3 = 0"))
    ],
    ("parties", "loaded", "k % 4 <> 0", {"name": ("'MOE ' || case_id",), "type": ("'Witness'",)}),
    ("attorneys", "loaded", "k % 2 = 0", {"name": ("'ROE ' || case_id",), "type": ("'Defendant'",), "appearance_date": DAY}),
    ("attorneys", "loaded", "k % 5 = 0", {"name": ("'State Attorney Office'",), "type": ("'Defendant'",)}),
    ("attorneys", "loaded", "k % 4 = 0", {"name": ("'MOE ' || case_id",), "type": ("'Plaintiff'",)}),
    ("events", "events_loaded", "", {"type": ("event_type",), "date": ("event_date", "mdy")}),
    (
        "charges",
        "charge_facts",
        "",
        {
            "statute_code": (f"CASE WHEN n % 2 = 0 THEN {STATUTE} END",),
            "description": (CHARGE_PAIRS[0][1],),
            "probable_cause": ("CASE WHEN n % 2 = 0 THEN 'true' END",),
            "injuries": ("CAST(nullif(n % 4, 0) AS int)", "CAST(nullif(n % 4, 0) AS varchar)"),
            "plea": (CHARGE_PAIRS[2][1],),
            "disposition": (DISPOSITION,),
            "disposition_date": DAY,
            "jail_term": (
                ("yrs * 12 + mos", "days", "hrs"),
                f"CASE WHEN n % 5 <> 4 THEN {TERM} END",
            ),
            "fine_amt": (FINE,),
        },
    ),
    ("documents", "loaded", "", {"name": ("'Form ' || CAST(k % 50 AS varchar)",), "filing_date": DAY}),
    ("judgements", "loaded", "k % 8 = 0", {"in_favor_of": ("'Plaintiff'",), "amt": (AMOUNT,)}),
    ("complaints", "loaded", "k % 9 = 0", {"against": ("name",), "status": ("'Open'",)}),
]
LOAD_NAMES = "facts loaded counts steps charge_facts events_loaded"


def _typed(column: str, given: dict) -> str:
    fields = [f.name for f in column_fields(column)]
    if column not in given:
        kind = "int" if isinstance(column_fields(column)[0].dataType, IntegerType) else "varchar"
        return ", ".join(f"CAST(NULL AS {kind}) AS {_quoted(f)}" for f in fields)
    value = given[column][0]
    if column == "jail_term":
        return ", ".join(f"CAST(CASE WHEN n % 5 <> 4 THEN {v} END AS int) AS {f}" for f, v in zip(fields, value))
    if len(fields) == 2:
        return f"{value} AS {fields[0]}, replace(replace({value}, '$', ''), ',', '') AS {fields[1]}"
    if column.endswith("date") or column == "dob":
        value = f"CAST({value} AS varchar)"
    return f"{value} AS {_quoted(column)}"


def _quoted(name: str) -> str:
    return f'"{name}"'


for _table, _columns in TABLE_COLUMNS.items():
    CHECKS[f"table_{_table}"] = _with(
        LOAD_NAMES,
        "\nUNION ALL ".join(
            f"SELECT cid AS case_id, {', '.join(_typed(c, given) for c in _columns[1:])} FROM {source}"
            + (f" WHERE {condition}" if condition else "")
            for table, source, condition, given in STORED
            if table == _table
        ),
    )
CHECKS["load_eight_tables"] = _with(
    LOAD_NAMES,
    "SELECT * FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{table}' AS \"table\", cid AS case_id, '{column}' AS \"column\", {given[column][-1]} AS value FROM {source}"
        + (f" WHERE {condition}" if condition else "")
        for table, source, condition, given in STORED
        for column in given
    )
    + ") WHERE value IS NOT NULL",
)

# Frontier.
CHECKS["date_spine_asc"] = """SELECT o_orderkey, CAST(CAST(o_orderdate AS date) + CAST(i AS int) AS varchar) AS day
FROM orders CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i) WHERE i <= o_orderkey % 4"""
CHECKS["date_spine_desc"] = """SELECT o_orderkey, i AS step, CAST(CAST(o_orderdate AS date) - CAST(i AS int) AS varchar) AS day
FROM orders CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i) WHERE i <= o_orderkey % 4"""
CHECKS["date_parse_format"] = """SELECT o_orderkey, CAST(CAST(o_orderdate AS date) AS varchar) AS day,
strftime(o_orderdate, '%-m/%-d/%Y') AS form_date FROM orders"""
CHECKS["search_grid"] = """SELECT strftime(day, '%-m/%-d/%Y') AS filing_date, company_label, court_label, 104 AS n_searches, 'a' AS first_letter,
'z' AS last_letter, 4 AS n_sites FROM (SELECT DISTINCT CAST(o_orderdate AS date) AS day FROM orders)
CROSS JOIN (SELECT unnest(['Company', 'Person']) AS company_label) CROSS JOIN (SELECT unnest(['Circuit', 'District']) AS court_label)"""
CHECKS["page_links"] = _with("result_links", "SELECT page_id, pos, href FROM result_links")
CHECKS["page_links_filtered"] = _with("result_links", "SELECT page_id, pos, href FROM result_links WHERE i % 4 <> 3")
CHECKS["url_case_id"] = """SELECT page_id, split_part(split_part(url, '&', 1), '=', 2) AS case_id FROM pages
WHERE contains(split_part(url, '&', 1), '=')"""
CHECKS["frontier_unseen"] = _with(
    "result_links",
    "SELECT page_id, pos, case_id FROM result_links WHERE case_id IS NOT NULL AND case_id NOT IN (SELECT CAST(l_orderkey AS varchar) FROM lineitem)",
)
CHECKS["frontier_seen"] = _with(
    "result_links",
    "SELECT page_id, pos, case_id FROM result_links WHERE case_id IN (SELECT CAST(l_orderkey AS varchar) FROM lineitem)",
)
CHECKS["pagination_links"] = """SELECT page_id, '/results?page=' || CAST(i AS varchar) AS href FROM pages
CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) WHERE page_id % 3 <> 2 AND page_id % 9 > 0 AND page_id % 10 <> 4"""
CHECKS["retry_queue"] = "SELECT page_id, 503 AS status FROM pages WHERE page_id % 10 = 4"
CHECKS["web_elements"] = r"""SELECT page_id, tag, parent, CAST(n AS bigint) AS n_elements FROM (
SELECT page_id, 'a' AS tag, 'li' AS parent, len(regexp_extract_all(html, '<a\s')) AS n FROM pages
UNION ALL SELECT page_id, 'h1', 'article', len(regexp_extract_all(html, '<h1>')) FROM pages
UNION ALL SELECT page_id, 'nav', 'body', len(regexp_extract_all(html, '<nav>')) FROM pages
UNION ALL SELECT page_id, 'title', 'head', len(regexp_extract_all(html, '<title>')) FROM pages) WHERE n > 0"""
CHECKS["html_elements"] = r"""SELECT page_id, CAST(pos AS int) AS pos, tag, parent, replace(replace(text, '&quot;', '"'), '&amp;', '&') AS text FROM (
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos,
  CASE WHEN found[2] = 'a' THEN 'a' ELSE 'h1' END AS tag, CASE WHEN found[2] = 'a' THEN 'li' ELSE 'article' END AS parent,
  regexp_extract(found, '^<[^>]*>(.*)</[^>]*>$', 1, 's') AS text
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*>.*?</a>|<h1>.*?</h1>', 0, 's')) AS found,
  unnest(range(len(regexp_extract_all(html, '<a\s[^>]*>.*?</a>|<h1>.*?</h1>', 0, 's')))) AS i FROM pages))"""
CHECKS["whitespace_norm"] = r"""SELECT doc_id, length(clean) AS n_clean, md5(clean) AS digest FROM (SELECT doc_id, trim(regexp_replace(text,
'[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS clean FROM documents)"""
CHECKS["prompt_norm"] = """SELECT p_partkey, p_name || CASE p_partkey % 5 WHEN 2 THEN ':' WHEN 4 THEN ':' ELSE '' END AS label FROM part"""

# Attributes and values.
CHECKS["attr_rename"] = """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'case_id' WHEN 1 THEN 'practice_name' WHEN 2 THEN 'vehicle_tag'
WHEN 3 THEN 'amt' ELSE replace(lower(p_type), ' ', '_') END AS attribute FROM part"""
CHECKS["height_inches"] = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN CAST(c_custkey % 7 * 12 + c_custkey % 12 AS varchar)
WHEN 1 THEN CAST(c_custkey % 7 * 12 + c_custkey % 12 AS varchar) WHEN 2 THEN CAST(c_custkey % 12 * 12 AS varchar)
WHEN 3 THEN CAST(c_custkey % 12 AS varchar) WHEN 4 THEN CAST(c_custkey % 80 AS varchar) END AS height FROM customer"""
CHECKS["sex_code"] = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'M' WHEN 3 THEN '' WHEN 4 THEN 'U' END
AS sex FROM customer"""
CHECKS["month_year_date"] = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%m/01/%Y')
WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') END AS written,
CAST(CASE o_orderkey % 4 WHEN 0 THEN CAST(date_trunc('month', o_orderdate) AS date) WHEN 3 THEN NULL ELSE CAST(o_orderdate AS date) END AS varchar)
AS day FROM orders"""
CHECKS["bool_flags"] = """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'true' WHEN 2 THEN 'false' WHEN 3 THEN ''
WHEN 4 THEN 'false' END AS flag FROM orders"""
CHECKS["injuries_count"] = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE CAST(o_orderkey % 5 AS varchar) END AS injuries,
CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(o_orderkey % 5 AS varchar) END AS injuries_stored FROM orders"""

# Export.
_EXTRACT = """SELECT disposition, court_system, type, CAST(filing_date AS varchar) AS filing_date, race, sex, height, weight, state,
{city} AS city, zip, description FROM extract"""
CHECKS["training_extract"] = _with(EXTRACT, _EXTRACT.format(city="lower(city)"))
CHECKS["csv_pipe_roundtrip"] = CHECKS["training_extract"]
CHECKS["topic_extract"] = _with(EXTRACT, _EXTRACT.format(city="city") + " WHERE lower(description) LIKE '%ring%'")
CHECKS["defendant_filter"] = _with(
    "docket_parties", "SELECT case_id, name, type FROM docket_parties WHERE lower(type) LIKE '%defendant%'"
)
CHECKS["case_types_by_family"] = _with(TYPED, "SELECT family, type FROM types")
CHECKS["case_types_json"] = CHECKS["case_types_by_family"]

# Buckets.
CHECKS["comma_scrub"] = _with("docket_parties", "SELECT case_id, type, replace(race, ',', ' ') AS race FROM docket_parties")
CHECKS["court_split"] = _with(
    "docket_cases",
    """SELECT case_id, split_part(court_system, '-', 1) AS courtname,
    CASE WHEN contains(court_system, '-') THEN split_part(court_system, '-', 2) END AS raw_type FROM docket_cases""",
)
CHECKS["court_type_bucket"] = _with("docket_cases kinds", "SELECT case_id, kind AS courttype FROM kinds")
CHECKS["court_type_ffill"] = _with(
    "docket_cases kinds",
    """SELECT case_id, coalesce(last_value(kind IGNORE NULLS) OVER (ORDER BY filing_date NULLS LAST, substr(md5(case_id), 1, 2), case_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'courttype') AS courttype FROM kinds""",
)
CHECKS["case_type_bucket"] = _with(
    f"{TYPED} type_bucket",
    "SELECT c.case_id, coalesce(t.family, c.type) AS casetype FROM docket_cases c LEFT JOIN type_bucket t ON c.type = t.type",
)
CHECKS["category_bucket"] = _with(
    "docket_parties",
    """SELECT case_id, type, CASE WHEN race IN ('BLACK, AFRICAN AMERICAN', 'Black') THEN 'black' WHEN race IN ('White', 'Caucasian') THEN 'white'
    WHEN race = 'INDIAN' THEN 'asian' WHEN race = 'Hispanic' THEN 'hispanic' WHEN race = 'UNKNOWN,OTHER' THEN 'other' ELSE race END AS bucket,
    CASE WHEN race = 'Black' THEN 'black' WHEN race IN ('White', 'Caucasian') THEN 'white' WHEN race = 'INDIAN' THEN 'asian'
    WHEN race = 'Hispanic' THEN 'hispanic' ELSE replace(race, ',', ' ') END AS scrubbed_bucket FROM docket_parties""",
)
CHECKS["outcome_label"] = _with(
    "docket_charges",
    """SELECT case_id, description, CASE WHEN disposition IN ('Guilty', '1:Guilty') THEN 'guilty' WHEN disposition IN ('Nolle Prosequi', 'Not Guilty')
    THEN 'not-guilty' WHEN disposition IN ('Stet', '1:Merged') THEN 'in-process' ELSE disposition END AS outcome FROM docket_charges""",
)
_ROWS = "case_id, outcome, courttype, courtname, casetype, race, sex, height, weight, state, zip"
CHECKS["split_decided"] = _with(GENERAL, f"SELECT {_ROWS} FROM decided")
CHECKS["split_in_process"] = _with(GENERAL, f"SELECT {_ROWS} FROM general WHERE outcome = 'in-process'")
CHECKS["features_general"] = _with(GENERAL, f"SELECT {_ROWS.removeprefix('case_id, ')} FROM general")
CHECKS["csv_typed_roundtrip"] = _with(GENERAL, f"SELECT {_ROWS.removeprefix('case_id, ')} FROM decided")
_TOPIC = "FROM bucketed WHERE lower(description) LIKE '%ring%'"
CHECKS["features_topic"] = _with(
    BUCKETED, f"SELECT outcome, casetype, race_bucket AS race, sex, height, weight, state, zip {_TOPIC}"
)
CHECKS["split_sets_written"] = _with(
    BUCKETED,
    f"""SELECT CASE WHEN outcome = 'in-process' THEN 'in_process' ELSE 'decided' END AS bucket, outcome, count(*) AS n_rows {_TOPIC}
    AND outcome IN ('guilty', 'not-guilty', 'in-process') GROUP BY ALL""",
)

# Model.
_codes = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS int) AS {c}"
    for c in "outcome courttype courtname casetype race sex state zip".split()
)
CHECKS["label_encode"] = _with(GENERAL, f"SELECT case_id, height, weight, {_codes} FROM decided")
CHECKS["train_test_split"] = _with(
    GENERAL,
    """SELECT CASE WHEN CAST('0x' || substr(md5(case_id), 1, 4) AS int) < 43909 THEN 'train' ELSE 'test' END AS split, outcome,
    count(*) AS n_rows FROM decided GROUP BY ALL""",
)
