"""Near-duplicate documents by SetSketch registers.

A register holds the smallest of exponentially distributed values over a document's shingles, on a logarithmic scale:
`floor(1 - log_b x)`, truncated to 0..q+1.  The values of one shingle are a Poisson process of rate m whose points go
to registers at random, so a shingle stops as soon as its next point exceeds all current minima.  Registers of unions
are maxima, and two registers agree with a probability near the Jaccard similarity; bands of registers find pairs, the
joint likelihood of their agreement discards most false ones, and the full shingle sets decide.

With 24 bands of 5 registers, a pair at the threshold of 0.85 shares no band with probability below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtloom.llm.common import alike, byte_batches, fresh
from courtloom.llm.components import link_buckets
from courtloom.session import durable

WIDTH = 5
PERCENT = 85
BANDS = 24
ROWS = 5
REGISTERS = BANDS * ROWS
BASE = 1.001
LIMIT = (1 << 16) - 2
#: Pairs whose likeliest similarity is this far below the threshold go; about six standard errors of 120 registers.
SLACK = 0.2
CHUNK_BYTES = 1 << 20

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)])) if n else np.zeros(0, np.uint64)


_P = 0xD1342543DE82EF95
_P_INVERSE = pow(_P, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SLOT = mix(np.arange(1, 65, dtype=np.uint64))


class Hasher:
    """Distinct shingle hashes of texts, many texts at a time."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.up = self.down = np.zeros(0, np.uint64)

    def word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of a byte string, and where they start."""
        if len(self.up) <= len(data):
            self.up, self.down = _powers(_P, 2 * len(data) + 2), _powers(_P_INVERSE, 2 * len(data) + 2)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[data]] * self.up[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)), starts

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text; a text of fewer words than a shingle is one, without words none."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        hashes, starts = self.word_hashes(data)
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        bounds = np.searchsorted(starts, at)
        w = self.width
        windows = np.zeros(max(0, len(hashes) - w + 1), np.uint64)
        for i in range(w):
            windows += hashes[i : i + len(windows)] * _SLOT[i]
        windows = mix(windows)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= w:
                out.append(np.unique(windows[a : b - w + 1]))
            elif b > a:
                out.append(mix((hashes[a:b] * _SLOT[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers, one row per set; an empty set has zeros."""
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), m), np.inf)
    owner, element = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    x, step = np.zeros(len(element)), 0
    flat = least.reshape(-1)
    while len(element):
        step += 1
        bits = mix(element + np.uint64(step * int(_GOLD) % (1 << 64)))
        x = x - np.log(((bits >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / m
        register = (mix(bits) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
        np.minimum.at(flat, owner * m + register.astype(np.int64), x)
        go = x < least.max(axis=1)[owner]
        x, owner, element = x[go], owner[go], element[go]
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / np.log(BASE)) + LIMIT // 2, 0, LIMIT + 1).astype(np.uint16)


def band_keys(regs: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band: a hash of the band's number and its register values."""
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD), (len(regs), bands)).copy()
    for r in range(rows):
        keys = mix(keys * _M1 + regs[:, r::rows].astype(np.uint64) + np.uint64(1))
    return keys


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity given the counts of registers that are larger in one, in the other, or equal.

    With known set sizes, the chance of a larger register is `p(u - v J)` for shares u, v of the sizes, where p is
    `-log_b(1 - x (b - 1) / b)`; the log-likelihood is concave in J, so a ternary search finds its maximum.
    """
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - up - down
    u, v = na / (na + nb), nb / (na + nb)
    p = lambda x: np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def loglik(j: np.ndarray) -> np.ndarray:
        more, less = p(u - v * j), p(v - u * j)
        return up * np.log(more) + down * np.log(less) + same * np.log(np.maximum(1 - more - less, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        x, y = low + (high - low) / 3, high - (high - low) / 3
        left = loglik(x) > loglik(y)
        low, high = np.where(left, low, x), np.where(left, y, high)
    return (low + high) / 2


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and UTF-8 texts of a batch, about `CHUNK_BYTES` at a time."""
    ids, texts, size = [], [], 0
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        ids.append(key)
        texts.append((text or "").encode())
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def fixed_lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).reshape(-1)))


def sketch(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the shingle set, its registers and band keys."""
    byte_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(width)
        for batch in batches:
            for ids, texts in chunks(batch):
                sets = hasher.sets(texts)
                regs = registers(sets)
                first = np.array([mix(s).sum(dtype=np.uint64) for s in sets]).view(np.int64)
                second = np.array([mix(s ^ _GOLD).sum(dtype=np.uint64) for s in sets]).view(np.int64)
                columns = [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(first), pa.array(second)]
                columns += [pa.array([r.tobytes() for r in regs], pa.binary()), fixed_lists(band_keys(regs).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2", "regs", "bands"])

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, regs binary, bands array<long>")


def shingle_sets(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and the distinct shingle hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(width)
        for batch in batches:
            for ids, texts in chunks(batch):
                sets = hasher.sets(texts)
                offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "s"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, s array<long>")


def likely(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs whose likeliest similarity reaches `least`."""

    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        matrix = lambda s: np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1)
        return pd.Series(similarity(matrix(a), matrix(b), na.to_numpy(float), nb.to_numpy(float)))

    side = lambda x: sketches.select(F.col("doc_id").alias(x), F.col("regs").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(estimate("ra", "rb", "na", "nb") >= least).select("a", "b")


def confirmed(pairs: DataFrame, documents: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of their full shingle sets."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = durable(shingle_sets(documents.join(named, "doc_id", "left_semi"), width), "sets")
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("s").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(alike(F.col("sa"), F.col("sb"), percent)).select("a", "b").distinct()


def rare_buckets(ids: DataFrame, documents: DataFrame, percent: int, width: int) -> DataFrame:
    """(key, id, place, size): the rarest shingles of each document as buckets, in which all links among `ids` meet.

    Shingles are ordered by the number of these documents that have them.  Two sets at the threshold differ in so few
    shingles that the first `size - ceil(percent * size / 100) + 1` of both have one in common; `place` counts the
    shingles before it.  Shingles of one document only come first and fill these places, so documents that share a
    long passage, but also differ in many shingles, meet in no bucket.
    """
    sets = durable(shingle_sets(documents.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), width).distinct(), "open-sets")
    items = sets.select("doc_id", F.size("s").alias("size"), F.explode("s").alias("x"))
    common = items.groupBy("x").agg(F.count("*").alias("n")).where("n > 1")
    # The array of a document is no longer than its text.
    ordered = items.join(common, "x").groupBy("doc_id", "size").agg(F.array_sort(F.collect_list(F.struct("n", "x"))).alias("m"))
    own = ordered.withColumn("own", F.col("size") - F.size("m"))
    places = own.select(F.col("doc_id").alias("id"), "size", "own", F.posexplode("m").alias("k", "item"))
    early = F.col("size") - F.expr(f"({percent} * size + 99) div 100")
    return places.withColumn("place", F.col("own") + F.col("k")).where(F.col("place") <= early).select(F.col("item.x").alias("key"), "id", "place", "size")


def op3_setsketch(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Documents with equal shingle sets are one class, represented by the smallest doc_id; only representatives are
    banded.  Empty texts are linked with nothing.  Rows that repeat a doc_id are one document; rows without one are
    linked with nothing, have no component and are kept.  Other columns are dropped.
    """
    sketches = durable(sketch(documents, width), "sketches")
    usable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("class"))
    member = durable(usable.select("doc_id", "d1", "d2", "n_shingles").join(classes, ["d1", "d2", "n_shingles"]).select("doc_id", "class"), "classes")
    leads = durable(usable.join(member.where("doc_id = class").select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "n_shingles", "regs", "bands"), "leads")
    buckets = leads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    verify = lambda pairs, _: confirmed(durable(likely(pairs, leads, percent / 100 - SLACK), "likely"), documents, percent, width)
    refine = lambda ids: rare_buckets(ids, documents, percent, width)
    fits = f"least(sa - pa, sb - pb) * {100 + percent} >= {percent} * (sa + sb)"
    found = link_buckets(buckets, verify, refine=refine, fits=fits)
    by_class = member.join(found.withColumnRenamed("id", "class"), "class", "left").select("doc_id", F.coalesce("component", "class").alias("c"))
    ids = by_class.groupBy("doc_id").agg(F.min("c").alias("c"))
    component = F.coalesce("c", "doc_id")
    return sketches.join(ids, "doc_id", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_copies(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of every component, the one with the smallest doc_id; all columns stay.

    Rows that repeat a doc_id are one document and stay together; rows without one stay.
    """
    d = fresh(documents.columns, "_doc")
    gone = op3_setsketch(documents.select("doc_id", "text"), percent).where("NOT kept").select(F.col("doc_id").alias(d)).distinct()
    return documents.join(gone, F.col("doc_id").cast("long") == F.col(d), "left_anti")
