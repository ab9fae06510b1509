"""What to collect next: search grid, links of result pages, ids not stored yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom import vocab
from courtloom.functions.arrays import let
from courtloom.functions.text import format_mdy, url_case_id
from courtloom.operators.joins import salted_join
from courtloom.sources.elements import html_links


def date_spine(start: Column, end: Column) -> Column:
    """Every date from start to end, both included; backwards when start is the later one."""
    return F.explode(F.sequence(start, end))


def _label(code: str, labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in labels.items() for x in item])[F.col(code)]


def search_grid(days: DataFrame, day: str = "day") -> DataFrame:
    """All searches of each day: name kind x first letter x category x court.

    The domains are literals unfolded in place, so days stay where they are.
    """
    domain = lambda values: F.explode(F.array(*map(F.lit, values)))
    letters = F.explode(F.transform(F.sequence(F.lit(97), F.lit(122)), lambda c: F.char(c)))
    grid = (
        days.select(day, domain(vocab.COMPANY_CODES).alias("company"))
        .select("*", letters.alias("last_name"))
        .select("*", domain(vocab.CASE_CATEGORIES).alias("site"))
        .select("*", domain(vocab.COURT_CODES).alias("court_system"))
    )
    return grid.select(
        "*",
        format_mdy(F.col(day)).alias("filing_date"),
        _label("company", vocab.COMPANY_CODES).alias("company_label"),
        _label("court_system", vocab.COURT_CODES).alias("court_label"),
    )


def links_in(links: Column, holder: str, holder_class: str | None = None) -> Column:
    """Addresses of the anchors inside the given holders, in page order, each anchor once."""
    holds = lambda q: (q["tag"] == holder) & (F.lit(True) if holder_class is None else F.array_contains(q["classes"], holder_class))

    def inside(holders: Column) -> Column:
        anchors = F.filter(links, lambda a: (a["tag"] == "a") & a["href"].isNotNull())
        held = F.filter(
            anchors,
            lambda a: F.exists(holders, lambda q: (a["pos"] > q["pos"]) & (a["pos"] <= q["pos"] + q["inner"])),
        )
        return F.transform(held, lambda a: a["href"])

    return let(F.filter(links, holds), inside)


def with_page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds `case_links` and `page_links` arrays of a result page and drops its text."""
    linked = pages.withColumn("links", html_links(html)).drop(html)
    return linked.select(
        *[c for c in linked.columns if c != "links"],
        links_in(F.col("links"), "table", "results").alias("case_links"),
        links_in(F.col("links"), "span", "pagelinks").alias("page_links"),
    )


def explode_links(pages: DataFrame, links: str, *keys: str) -> DataFrame:
    """One row per link with its place on the page."""
    return pages.select(*keys, F.posexplode_outer(links).alias("pos", "href")).where("href is not null")


def drop_sort_links(links: DataFrame) -> DataFrame:
    """Case links only; column-sorting links lead nowhere new."""
    return links.where(~F.col("href").contains(vocab.SORT_LINK_MARK))


def with_case_id(links: DataFrame, url: str = "href") -> DataFrame:
    """Adds the case id a link names; links without one are dropped."""
    return links.withColumn("case_id", url_case_id(F.col(url))).where("case_id is not null")


def without_case_id(links: DataFrame, url: str = "href") -> DataFrame:
    """Links that name no case, as rejects."""
    return links.where(url_case_id(F.col(url)).isNull()).withColumn("reason", F.lit("no case id"))


def unseen(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Links whose case is not stored yet. Pass links that are written out: their ids are read twice."""
    return salted_join(links, stored.select("case_id"), "case_id", "left_anti")


def seen(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Links whose case is stored already, written out as for `unseen`."""
    return salted_join(links, stored.select("case_id"), "case_id", "left_semi")


def pagination(pages: DataFrame, *keys: str) -> DataFrame:
    """Further result pages that first-level pages with at least one link name, each once per page.

    Repeats collapse inside the page's own array: no shuffle.
    """
    first_level = pages.where(~F.col("is_sub_page") & (F.size("case_links") > 0))
    hrefs = F.explode_outer(F.array_distinct("page_links")).alias("href")
    return first_level.select(*keys, hrefs).where("href is not null")


def answered(responses: DataFrame) -> DataFrame:
    """Responses worth reading."""
    return responses.where("status = 200")


def retry_queue(responses: DataFrame) -> DataFrame:
    """Responses to ask for again."""
    return responses.where("status <> 200")
