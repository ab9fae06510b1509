"""A Merkle manifest of a table: leaves, subroots per source, one root, and a proof for every row.

Nodes of fan-out 16 are built level by level, but only every second level is written ("checkpoint"): a group of
the 256 stored nodes under one stored node two levels up, an aligned subtree, is enough to regenerate the level
between them. Proofs are taken the same way: for each aligned subtree the missing level is recomputed from its
stored descendants, each node's siblings at both levels are emitted, the recomputed nodes are thrown away, and the
segments are chained top-down by joins keyed on (tree, position), so no key ever holds more than 256 rows.

Positions within a tree come from a range partition over (tree, order) and counts per partition, so one tree with
a third of all rows is spread over many tasks. Every step is built-in Spark SQL and written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtloom.llm.common import lower_ascii
from courtloom.session import durable

FAN = 16
#: Levels between two stored ones; an aligned subtree holds FAN ** STRIDE stored nodes.
STRIDE = 2
SPAN = FAN**STRIDE
LOCAL = (1 << 33) - 1


def H(parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenation of an array of strings."""
    return F.sha2(F.array_join(parts, ""), 256)


def field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:` and the value (integers in decimal)."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return H(F.array(field(doc_id), field(source), field(lang), field(n_chars), field(text)))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where 5 divides the unsigned CRC-32 of the decimal doc_id; nulls stay."""
    hit = (F.crc32(doc_id.cast("string")) % 5 == 0) & doc_id.isNotNull()
    return F.when(hit, lower_ascii(text)).otherwise(text)


def positions(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add `pos` (gapless from 0 within `tree` by `order`) and `m` (nodes of the tree), both long.

    Rows are range-partitioned on (tree, order), so a large tree spans many tasks; a row's place is its index in its
    partition plus the rows of its tree in earlier partitions, summed over a table of one row per partition and tree.
    Rows equal in every sort key must be equal in all columns, since their order among each other is free.
    """
    spark = nodes.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    ranked = nodes.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    ranked = durable(ranked.withColumns({"_part": F.col("_mid").bitwiseAND(F.lit(~LOCAL)), "_local": F.col("_mid").bitwiseAND(F.lit(LOCAL))}).drop("_mid"), "merkle-ranked")
    tree_key = F.coalesce(F.col(tree), F.lit(""))
    counts = ranked.groupBy("_part", tree).agg(F.count(F.lit(1)).alias("_c"), F.min("_local").alias("_first"))
    by_tree = Window.partitionBy(tree_key, F.col(tree).isNull()).orderBy("_part")
    counts = counts.select(
        F.col("_part").alias("_p"),
        F.col(tree).alias("_t"),
        "_first",
        (F.sum("_c").over(by_tree.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")).alias("_before"),
        F.sum("_c").over(Window.partitionBy(tree_key, F.col(tree).isNull())).alias("m"),
    )
    joined = ranked.join(counts, (F.col("_part") == F.col("_p")) & F.col(tree).eqNullSafe(F.col("_t")))
    return joined.select(*nodes.columns, (F.col("_before") + F.col("_local") - F.col("_first")).alias("pos"), "m")


def entry(left: Column, right: Column) -> Column:
    return F.struct(left.alias("l"), right.alias("r"))


def empty_path() -> Column:
    """An empty array of (l, r) entries."""
    return F.filter(F.array(entry(F.lit(""), F.lit(""))), lambda e: F.lit(False))


def subtrees(level: DataFrame, tree: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Aligned subtrees of one stored level: (tree, q, m, nodes, hs); nodes at pos = q * SPAN + index, in order."""
    node = F.struct("pos", "hash", *extra)
    grouped = level.groupBy(tree, (F.col("pos") / SPAN).cast("long").alias("q"), "m").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    return grouped.withColumn("hs", F.transform("nodes", lambda n: n["hash"]))


def upper(hs: Column) -> Column:
    """The recomputed level above a subtree's stored nodes: H of every run of FAN (the last may be shorter)."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(hs) / FAN).cast("int") - 1)
    return F.transform(runs, lambda j: H(F.slice(hs, j * FAN + 1, FAN)))


def build(nodes: DataFrame, tree: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels (tree, pos, m, hash), lowest first, and the top of every tree (tree, top)."""
    stored, tops = [nodes], []
    level = nodes
    while True:
        done = level.filter(F.col("m") == 1).select(tree, F.col("hash").alias("top"))
        groups = subtrees(level.filter(F.col("m") > 1), tree).withColumn("up", upper(F.col("hs")))
        m1 = F.ceil(F.col("m") / FAN)
        # Trees whose level above is a single node end there; that node, recomputed, is their top.
        tops.append(done.unionByName(groups.filter(m1 == 1).select(tree, F.col("up")[0].alias("top"))))
        nxt = groups.filter(m1 > 1).select(tree, F.col("q").alias("pos"), F.ceil(m1 / FAN).alias("m"), H(F.col("up")).alias("hash"))
        nxt = durable(nxt, "merkle-level")
        if nxt.isEmpty():
            break
        stored.append(nxt)
        level = nxt
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return stored, durable(top, "merkle-tops")


def node_paths(groups: DataFrame, tree: str, extra: tuple[str, ...], carried: list[str]) -> DataFrame:
    """Explode aligned subtrees that carry their parent's `path` into nodes with their whole path.

    A node's path starts with its siblings in its run, then, if the level above has more than one node, the
    siblings of its recomputed parent; the recomputed level is dropped once these are taken.
    """
    rows = groups.withColumn("up", upper(F.col("hs"))).select(tree, "q", "m", "hs", "up", "path", *carried, F.posexplode("nodes").alias("i", "node"))
    i, k = F.col("i"), F.col("i") % FAN
    j = (i / FAN).cast("int")
    start = j * FAN + 1
    own = entry(F.array_join(F.slice("hs", start, k), ""), F.array_join(F.slice("hs", start + k + 1, FAN - 1 - k), ""))
    above = entry(F.array_join(F.slice("up", 1, j), ""), F.array_join(F.slice("up", j + 2, FAN), ""))
    m = F.col("m")
    seg = F.when(m == 1, empty_path()).when(F.ceil(m / FAN) > 1, F.array(own, above)).otherwise(F.array(own))
    keep = [F.col("node")[c].alias(c) for c in ("pos", "hash", *extra)]
    return rows.select(tree, *keep, F.concat(seg, F.col("path")).alias("path"), *carried)


def proofs(stored: list[DataFrame], tree: str, above: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per node of the lowest stored level: (tree, pos, hash, extra..., path, carried...).

    `path` lists (l, r) siblings from that level up through `above`, which gives each tree's own path beyond its
    top, with carried columns, keyed by `_tree`. Parents' paths join one row per aligned subtree, never per node:
    a subtree of a tree of more than FAN nodes at its level joins its stored parent two levels up, the others end
    below their tree's top and join its path. Levels above the lowest are written; the lowest is returned unwritten,
    so the long paths of its nodes are only ever computed where they are used.
    """
    carried = [c for c in above.columns if c not in ("_tree", "path")]
    chain = None
    for depth, level in reversed(list(enumerate(stored))):
        groups = subtrees(level, tree, extra if depth == 0 else ())
        ends = groups.filter(F.col("m") <= FAN).join(above, groups[tree].eqNullSafe(above["_tree"])).drop("_tree")
        if chain is not None:
            parent = chain.select(F.col(tree).alias("_tree"), F.col("pos").alias("_q"), "path", *carried)
            goes = groups.filter(F.col("m") > FAN).join(parent, groups[tree].eqNullSafe(parent["_tree"]) & (groups["q"] == parent["_q"])).drop("_tree", "_q")
            ends = ends.unionByName(goes)
        nodes = node_paths(ends, tree, extra if depth == 0 else (), carried)
        chain = nodes if depth == 0 else durable(nodes.select(tree, "pos", "path", *carried), "merkle-proofs")
    return chain


def fold(start: Column, path: Column) -> Column:
    """Recompute a root from a node and its path of (l, r) siblings."""
    return F.aggregate(path, start, lambda acc, e: F.sha2(F.concat(e["l"], acc, e["r"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are H of doc_id, source, lang, n_chars and text; per source they ascend by doc_id (nulls first, ties by leaf),
    subroots ascend by source (null first, UTF-8 bytewise). Null fields hash as `-`; an empty table gives no rows;
    repeated rows are separate leaves (in either order, with the same multiset of results); a source of one row has
    that leaf as its subroot, and one source makes its subroot the root. Only the five named columns are read, so
    extra columns of any name do not matter. `folded_root` folds the leaf of the tampered text (A-Z lower-cased where
    5 divides the unsigned CRC-32 of the decimal doc_id) with the untampered siblings; `verified` compares it with root.
    """
    c = F.col
    rows = docs.select(
        c("doc_id").cast("long").alias("doc_id"),
        c("source").cast("string").alias("source"),
        leaf(c("doc_id"), c("source"), c("lang"), c("n_chars"), c("text")).alias("hash"),
        leaf(c("doc_id"), c("source"), c("lang"), c("n_chars"), tampered(c("doc_id"), c("text"))).alias("tampered"),
    )
    leaves = positions(rows, "source", ["doc_id", "hash"])
    stored, tops = build(leaves.select("source", "pos", "m", "hash"), "source")

    # The tree of subroots: one tree, ordered by source; its own proofs start from an empty path.
    subroots = positions(tops.select(F.lit(0).alias("t"), c("source"), c("top").alias("hash")), "t", ["source"])
    upper_stored, root = build(subroots.select("t", "pos", "m", "hash"), "t")
    root_of = root.select(c("t").alias("_tree"), c("top").alias("root"), empty_path().alias("path"))
    upper_stored[0] = subroots.select("t", "pos", "m", "hash", "source")
    over_sources = proofs(upper_stored, "t", root_of, extra=("source",))
    above = durable(over_sources.select(c("source").alias("_tree"), c("hash").alias("subroot"), "root", "path"), "merkle-sources")

    stored[0] = leaves.select("source", "pos", "m", "hash", "doc_id", "tampered")
    out = proofs(stored, "source", above, extra=("doc_id", "tampered"))
    folded = fold(c("tampered"), c("path"))
    return out.select(
        "doc_id",
        "source",
        c("hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(F.transform("path", lambda e: F.concat(e["l"], e["r"])), ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == c("root")).alias("verified"),
        c("pos").alias("position"),
    )


def op11_checkpoint_merkle(docs: DataFrame) -> DataFrame:
    """The manifest of every `documents` row."""
    return manifest(docs)
