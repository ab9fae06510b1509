"""Placement of documents on shards by a hierarchical weighted hash tree.

A document descends region, rack and shard.  At every level each child draws `-ln(u) / weight`, where u is a uniform
hash of the document and the child's name, and the least draw wins.  A child whose weight does not change keeps its
draw, so rows only move between subtrees whose weights change.  A new shard is hung up as a region of its own: no
draw inside the other regions changes, hence rows move into the new shard and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom.session import durable

SHARDS = 40
ROWS_PER_SLICE = 200_000


@dataclass(frozen=True)
class Node:
    """A named child with a weight; a leaf carries its shard."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def tree(shards: int = SHARDS, racks: int = 2, per_rack: int = 4) -> Node:
    """Regions of `racks` racks of `per_rack` shards, all shards of weight 1; the last ones may be smaller."""
    leaves = [Node(f"shard{i}", 1.0, shard=i) for i in range(shards)]
    rack_nodes = [inner(f"rack{i}", leaves[i * per_rack : (i + 1) * per_rack]) for i in range(-(-shards // per_rack))]
    regions = [inner(f"region{i}", rack_nodes[i * racks : (i + 1) * racks]) for i in range(-(-len(rack_nodes) // racks))]
    return inner("root", regions)


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, as a region of its own."""
    leaf = Node(f"shard{shard}", weight, shard=shard)
    return inner(root.name, [*root.children, inner(f"region+{shard}", [inner(f"rack+{shard}", [leaf])])])


def draw(key: Column, child: Node) -> Column:
    """Exponential draw of a child: the least of draws with rates w is child i with probability w_i / sum w."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(child.name), key), 11).cast("double")  # 53 bits
    return -F.log((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(child.weight)


def choose(key: Column, node: Node) -> Column:
    """The shard that a key reaches below a node; only the winning branch is evaluated."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return choose(key, live[0])
    names = F.array_min(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    branches = [choose(key, c) for c in live]
    return F.element_at(F.array(*branches), names + 1) if all(c.shard is not None for c in live) else _switch(names, branches)


def _switch(index: Column, branches: list[Column]) -> Column:
    out = F.when(index == 0, branches[0])
    for i, branch in enumerate(branches[1:], 1):
        out = out.when(index == i, branch)
    return out


def place(df: DataFrame, root: Node, name: str, key: str = "doc_id") -> DataFrame:
    """Add the shard of each row's key; a null key is a key like any other."""
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    return df.withColumn(name, choose(text, root))


def slots(df: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """Add `slot`, gapless from 0 within each group.

    A group is numbered in slices by a hash of `keys`, each slice in a task of its own, and the slices' offsets come
    from their counts; so a group may outgrow any task.  Repeated keys get slots next to each other.
    """
    stored = durable(df, "placed")
    slices = max(1, -(-stored.count() // ROWS_PER_SLICE))
    sliced = stored.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
    order = ", ".join(keys)
    counts = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_n"))
    offsets = counts.selectExpr(group, "_slice", f"sum(_n) OVER (PARTITION BY {group} ORDER BY _slice) - _n AS _before")
    numbered = sliced.selectExpr("*", f"row_number() OVER (PARTITION BY {group}, _slice ORDER BY {order}) - 1 AS _at")
    return numbered.join(offsets, [group, "_slice"]).withColumn("slot", (F.col("_before") + F.col("_at")).cast("long")).drop("_slice", "_before", "_at")


def op7_hash_tree(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All documents on their shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A null text is no text: 16 bytes and the checksum of nothing.  Rows that repeat a doc_id go to its shard, each with
    a slot of its own; rows without one share a shard.  Other columns are dropped.
    """
    utf8 = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = documents.select("doc_id", (F.octet_length(utf8) + 16).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"), F.lit("key").alias("law"))
    root = tree(shards)
    placed = place(place(rows, root, "shard"), grown(root, shards), "grown_shard")
    return slots(placed, "shard", ["doc_id", "text_crc32", "size"])
