"""URL filters: host rules first, then a verdict spread over the link graph of hosts.

Rules (host, path prefix, verdict) fit a host and all its subdomains; the longest fitting rule decides. Rules are a
short parameter list, so they compile into one projection, without a join. A page that no rule fits takes its host's
verdict from two personalised PageRanks over the edges between hosts that the pages' links form: trust flows along
links from hosts whose pages rules allow, distrust flows against links from hosts whose pages rules block (a host
that links to blocked hosts shares their blame). A host is blocked when its share of distrust, D / (T + D),
reaches THRESHOLD; a host that neither reaches is allowed. Every step is a DataFrame join or aggregate; edges are
counted map-side, and ranks are written to the shared folder every few rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom.llm.common import lower_ascii
from courtloom.session import durable

# Fixed values of the contract: the rules as (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING = 0.85
ROUNDS = 20
#: Rounds between two writes of the ranks.
EVERY = 5
THRESHOLD = 0.5
HREF = "(?i)href\\s*=\\s*[\"']?([^\"'\\s>]+)"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first `://` up to `/`, `?`, `#` or end, and the path after it up to `?` or `#`.

    A null url or one without `://` has both empty.
    """
    at = F.instr(url, "://")
    after = F.when(url.isNotNull() & (at > 0), url.substr(at + 3, F.lit(1 << 30))).otherwise(F.lit(""))
    raw = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = after.substr(F.length(raw) + 1, F.lit(1 << 30))
    return lower_ascii(raw), F.regexp_extract(rest, "^[^?#]*", 0)


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as `hostpath` text and its verdict, else nulls; equal lengths go to the earlier rule."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rh, rp, rv in reversed(ordered):
        hit = fits(host, path, rh, rp)
        name, verdict = F.when(hit, F.lit(rh + rp)).otherwise(name), F.when(hit, F.lit(rv)).otherwise(verdict)
    return name, verdict


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, rule_verdict, html of every page."""
    host, path = host_path(F.col("url"))
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.select("page_id", "html", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", name.alias("rule"), verdict.alias("rule_verdict"), "html")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links of `href` attributes between different non-empty hosts, counted map-side.

    A link with `://` names its host; one starting with `//` too; others stay on the page's host and are no edge.
    """
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1))).alias("href"))
    target = F.when(F.col("href").startswith("//"), F.concat(F.lit("x:"), F.col("href"))).otherwise(F.col("href"))
    dst, _ = host_path(target)
    edges = links.select("src", dst.alias("dst")).filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def shares(edges: DataFrame) -> DataFrame:
    """(src, dst, share): each edge's weight as the share of all weight leaving its src."""
    out = edges.groupBy("src").agg(F.sum("w").alias("out"))
    return edges.join(out, "src").select("src", "dst", (F.col("w") / F.col("out")).alias("share"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank (host, rank): seeds (host, p) with p summing to 1, edges (src, dst, share).

    r <- (1 - damping) * p + damping * sum of r(src) * share over edges into a host; mass at hosts without
    outgoing edges is not passed on. Ranks are written every EVERY rounds, so lineage stays short.
    """
    rank = seeds.select("host", F.col("p").alias("rank"))
    for i in range(rounds):
        flow = rank.join(edges, rank["host"] == edges["src"]).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("flow"))
        both = seeds.join(flow, "host", "full")
        rank = both.select("host", ((1 - damping) * F.coalesce("p", F.lit(0.0)) + damping * F.coalesce("flow", F.lit(0.0))).alias("rank"))
        if (i + 1) % EVERY == 0:
            rank = durable(rank, "host-rank")
    return rank


def url_filter(pages: DataFrame, rules=RULES, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict (and trust, distrust of the host) for every page.

    A page takes its rule's verdict; without one, its host's from the propagation. Seeds are hosts weighted by their
    pages whose rules allow (trust) or block (distrust), each set summing to 1. Null urls, urls without `://` and
    null html give empty hosts, paths and no links; a host no seed reaches, or the empty host, is allowed. Empty
    tables give no rows; repeated rows give equal rows; extra columns are not read.
    """
    pages = durable(judged(pages, rules), "judged-pages")
    edges = durable(host_edges(pages), "host-edges")
    forward = shares(edges)
    backward = shares(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))

    def seeds(verdict: str) -> DataFrame:
        hits = pages.filter((F.col("rule_verdict") == verdict) & (F.col("host") != "")).groupBy("host").agg(F.count(F.lit(1)).alias("c"))
        # One number reaches the driver: the count of seed pages, by which the personalisation sums to one.
        total = hits.agg(F.sum("c")).first()[0] or 1
        return hits.select("host", (F.col("c") / F.lit(total)).alias("p"))

    trust = propagate(seeds("allow"), forward, rounds).withColumnRenamed("rank", "trust")
    distrust = propagate(seeds("block"), backward, rounds).withColumnRenamed("rank", "distrust")
    hosts = trust.join(distrust, "host", "full")
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    hosts = hosts.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    hosts = hosts.withColumn("host_verdict", F.when((F.col("trust") + F.col("distrust") > 0) & (share >= threshold), "block").otherwise("allow"))
    out = pages.join(hosts, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"), "trust", "distrust")


def op13_link_propagation(pages: DataFrame) -> DataFrame:
    """The verdict of every `pages` url."""
    return url_filter(pages)
