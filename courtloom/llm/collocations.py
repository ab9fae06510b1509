"""Phrase collocations: n-gram count automata built per shard, merged by summing weights, composed for part lookups.

The count table is a weighted acyclic automaton in table form: a path is an n-gram of one to three words of a
language, its weight the number of contiguous occurrences. Each input shard builds its own over dictionary-encoded
words, a stretch of texts at a time (so a word seen a billion times leaves each stretch as one row); the shards'
automata are unioned and their weights summed by key; words and phrases that can matter (weight 10 or more) are
written, sorted by (lang, gram) within each shard. Paths of three words follow in a second reading of the texts, and
only where both transitions, the word pairs in them, have that weight: most triples occur once, and none of those
leaves its task. A candidate's score composes it with the automaton twice, once for each part
of a cut, by joins on (lang, part). Products of counts are exact decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from courtloom.llm.common import byte_batches
from courtloom.session import durable

# Fixed values of the contract: least count of a candidate, phrase orders, report size.
LEAST = 10
ORDERS = (2, 3)
TOP = 2000
#: Salts of the two-phase top-k, so one language's candidates are ranked by many tasks first.
SALTS = 64
#: Bytes of text that are counted together before rows leave a task.
STRETCH_BYTES = 3 << 20
#: Rows that leave a task in one Arrow batch.
BATCH_ROWS = 1 << 15
#: Bits of the filter of frequent pairs, 8 MB whatever the corpus; a full filter lets more triples through, none less.
FILTER_BITS = 26
COUNTS = "lang string, k int, gram string, f long"

_BREAK, _BLANK, _LOWER = np.zeros(256, bool), np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK[list(b" \t")] = True
_LOWER[65:91] += 32


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Languages and texts of about `STRETCH_BYTES` of text at a time; texts stay whole."""
    held, size = [], 0
    for batch in batches:
        lengths = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(lengths):
            done = int(lengths[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(lengths, done + STRETCH_BYTES - size, "right")))
            held.append(batch.slice(start, stop - start))
            size += int(lengths[stop - 1]) - done
            start = stop
            if size >= STRETCH_BYTES or start < len(lengths):
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    whole = pa.Table.from_batches(held)
    return tuple(pa.concat_arrays([c.cast(pa.large_binary()) for c in whole.column(i).chunks]) for i in (0, 1))


def encoded(langs: pa.Array, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts, in order: languages and words of the nodes, the node of each word, and whether the next word follows it in its piece.

    A node is a word of a language. Words are told apart by their bytes; A-Z are lower-cased.
    """
    texts = pc.fill_null(texts, b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    parts = _BREAK[data]
    inside = ~(parts | _BLANK[data])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text begins a word of its own
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return pa.array([], pa.large_binary()), pa.array([], pa.large_binary()), starts, np.zeros(0, bool)
    doc = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.searchsorted(np.flatnonzero(parts), starts)
    follows = np.append((breaks[1:] == breaks[:-1]) & (doc[1:] == doc[:-1]), False)
    ends = np.concatenate([[0], np.add.reduceat(inside, starts, dtype=np.int64).cumsum()])
    packed = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_LOWER[data[inside]])])
    words, tongues = packed.dictionary_encode(), langs.dictionary_encode()
    many = len(words.dictionary)
    pairs = pa.array(tongues.indices.to_numpy().astype(np.int64)[doc] * many + words.indices.to_numpy()).dictionary_encode()
    keys = pairs.dictionary.to_numpy()
    return tongues.dictionary.take(pa.array(keys // many)), words.dictionary.take(pa.array(keys % many)), pairs.indices.to_numpy().astype(np.int64), follows


def rows(langs: pa.Array, k: int, grams: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    columns = [langs.cast(pa.binary()).cast(pa.string(), safe=False), pa.array(np.full(len(langs), k, np.int32)), grams.cast(pa.binary()).cast(pa.string(), safe=False), pa.array(counts.astype(np.int64))]
    whole = pa.RecordBatch.from_arrays(columns, names=["lang", "k", "gram", "f"])
    for start in range(0, len(whole), BATCH_ROWS):
        yield whole.slice(start, BATCH_ROWS)


def short_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, k, gram, f) of the words and word pairs of each stretch."""
    for langs, texts in stretches(batches):
        tongue, words, at, follows = encoded(langs, texts)
        if not len(at):
            continue
        yield from rows(tongue, 1, words, np.bincount(at, minlength=len(words)))
        here = np.flatnonzero(follows)
        pairs = pa.array(at[here] * len(words) + at[here + 1]).value_counts()
        left, right = (pa.array(x) for x in np.divmod(pairs.field(0).to_numpy(), len(words)))
        yield from rows(tongue.take(left), 2, pc.binary_join_element_wise(words.take(left), words.take(right), pa.scalar(b" ", pa.large_binary())), pairs.field(1).to_numpy())


def marks(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each byte string, the same in every task."""
    return pd.util.hash_array(words.cast(pa.binary()).to_numpy(zero_copy_only=False).astype(object), categorize=False)


def pair_bits(langs: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Place in the filter of pairs of words, given the hashes of their language and words."""
    x = (langs * np.uint64(0x9E3779B97F4A7C15) + left) * np.uint64(0xBF58476D1CE4E5B9) + right
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def frequent_pairs(table: DataFrame) -> Broadcast:
    """The filter of pairs of weight `LEAST` or more: a bit for each, of `FILTER_BITS` bits, in one broadcast of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, left, right = (marks(batch.column(i)) for i in range(3))
            bits = pair_bits(langs, left, right)
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 6), pa.array(np.int64(1) << (bits & 63))], names=["at", "bits"])

    spark = table.sparkSession
    ends = [F.substring_index("gram", " ", n).cast("binary") for n in (1, -1)]
    pairs = table.where((F.col("k") == 2) & (F.col("f") >= LEAST)).select(F.col("lang").cast("binary").alias("lang"), ends[0].alias("left"), ends[1].alias("right"))
    found = pairs.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most 2^20 rows
    whole = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    whole[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return spark.sparkContext.broadcast(whole.tobytes())


def long_grams(docs: DataFrame, pairs: Broadcast) -> DataFrame:
    """(lang, k, gram, f) of the word triples of each stretch whose two pairs are in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(pairs.value, np.uint8)
        for langs, texts in stretches(batches):
            tongue, words, at, follows = encoded(langs, texts)
            if not len(at):
                continue
            own, spoken = marks(words), tongue.dictionary_encode()
            speech = marks(spoken.dictionary)[spoken.indices.to_numpy()]
            here = np.flatnonzero(follows)
            bits = pair_bits(speech[at[here]], own[at[here]], own[at[here + 1]])
            frequent = np.zeros(len(at), bool)
            frequent[here] = bitmap[bits >> 3] >> (bits & 7).astype(np.uint8) & 1 == 1
            here = np.flatnonzero(frequent[:-1] & frequent[1:])
            if not len(here):
                continue
            firsts = pa.array(at[here] * len(words) + at[here + 1]).dictionary_encode()
            triples = pa.array(firsts.indices.to_numpy().astype(np.int64) * len(words) + at[here + 2]).value_counts()
            pair, third = np.divmod(triples.field(0).to_numpy(), len(words))
            one, two = np.divmod(firsts.dictionary.to_numpy()[pair], len(words))
            one, two, third = pa.array(one), pa.array(two), pa.array(third)
            yield from rows(tongue.take(one), 3, pc.binary_join_element_wise(words.take(one), words.take(two), words.take(third), pa.scalar(b" ", pa.large_binary())), triples.field(1).to_numpy())

    return docs.mapInArrow(run, COUNTS)


def automaton(docs: DataFrame) -> DataFrame:
    """Weighted n-grams (lang, k, gram, f) of all documents: every word, and the phrases of weight `LEAST` or more.

    Null lang is `und`, null texts are empty. Each stretch of a shard has its automaton; the aggregate sums them in
    hash shards of (lang, k, gram), each written sorted by (lang, gram). Only words (for n) and paths that can be a
    candidate or a part of one are kept. A triple occurs at most as often as the pairs in it, so those without two
    frequent pairs are never counted.
    """
    byte_batches(docs.sparkSession)
    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))

    def merged(shards: DataFrame, name: str) -> DataFrame:
        weights = shards.groupBy("lang", "k", "gram").agg(F.sum("f").alias("f"))
        return durable(weights.filter((F.col("k") == 1) | (F.col("f") >= LEAST)).sortWithinPartitions("lang", "gram"), name)

    short = merged(read.mapInArrow(short_grams, COUNTS), "automaton")
    pairs = frequent_pairs(short)
    return short.unionByName(merged(long_grams(read, pairs), "automaton-triples"))


def exact_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) by integral division of 38-digit decimals, exact past 64 bits.

    The quotient fits a long, since left and right are each at least a.
    """
    big = "decimal(38,0)"
    return F.expr(f"(cast({a} as {big}) * cast({a} as {big}) * cast(1000000 as {big})) div (cast({left} as {big}) * cast({right} as {big}))")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's best `top` phrases: lang, rank, phrase, a, l, r, n, score (all numbers long).

    Texts lower-case A-Z (null: empty), split into pieces at `[.,;:!?\\x0A-\\x0D]` and into words `[^\\x20\\x09]+`; null lang counts as `und`.
    n counts all words of the language, f all contiguous occurrences of a phrase within pieces, overlaps included.
    Candidates are phrases of 2 or 3 words with a = f >= 10; a cut after k words scores floor(1e6*a*a/(l*r)), the
    lowest cut counts, ties to the smaller k. Two-word candidates inside a three-word candidate with 100*f >= 50*a
    are dropped. Ranks follow score desc, a desc, phrase asc (UTF-8 bytes); equal rows rank apart by that order only.
    Empty tables, empty or null texts give no rows; only doc text and lang are read, so extra columns do not matter.
    """
    table = automaton(docs)
    n = table.filter(F.col("k") == 1).groupBy("lang").agg(F.sum("f").alias("n"))
    # Every part of a candidate occurs wherever the candidate does, so parts below LEAST are never looked up.
    frequent = table.filter(F.col("f") >= LEAST)
    cands = frequent.filter(F.col("k").isin(*ORDERS)).select("lang", "k", "gram", F.col("f").alias("a"), F.split("gram", " ").alias("ws"))

    cuts = cands.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "gram", "k", "a", "cut", F.array_join(F.slice("ws", 1, F.col("cut")), " ").alias("lp"), F.array_join(F.slice("ws", F.col("cut") + 1, 3), " ").alias("rp"))
    left = frequent.select(F.col("lang").alias("_ll"), F.col("gram").alias("lp"), F.col("f").alias("l"))
    right = frequent.select(F.col("lang").alias("_rl"), F.col("gram").alias("rp"), F.col("f").alias("r"))
    scored = cuts.join(left, (cuts["lang"] == left["_ll"]) & (cuts["lp"] == left["lp"])).drop("_ll", left["lp"])
    scored = scored.join(right, (scored["lang"] == right["_rl"]) & (scored["rp"] == right["rp"])).drop("_rl", right["rp"])
    scored = scored.withColumn("score", exact_score("a", "l", "r"))
    best = scored.groupBy("lang", "gram", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("lang", "gram", "k", "a", "b.score", "b.l", "b.r")

    three = cands.filter(F.col("k") == 3)
    inner = three.select("lang", "a", F.explode(F.array(F.array_join(F.slice("ws", 1, 2), " "), F.array_join(F.slice("ws", 2, 2), " "))).alias("gram"))
    covers = inner.groupBy("lang", "gram").agg(F.max("a").alias("outer"))
    best = best.join(covers, ["lang", "gram"], "left")
    kept = best.filter(F.col("outer").isNull() | (100 * F.col("outer") < 50 * F.col("a"))).join(n, "lang")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("gram").asc()]
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64("gram"), F.lit(SALTS)))
    local = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_r") <= top)
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), F.col("gram").alias("phrase"), *[F.col(c).cast("long") for c in ("a", "l", "r", "n", "score")])


def op12_phrase_automata(docs: DataFrame) -> DataFrame:
    """The collocation report of all `documents`, 2000 phrases a language."""
    return collocations(docs)


#: DuckDB SQL of the same report over the `documents` view.
ORACLE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS gram
  FROM w, range(1, 4) AS o(k), LATERAL (SELECT unnest(range(1, len(ws) - k + 2)) AS i)),
f AS (SELECT lang, k, gram, count(*) AS f FROM g GROUP BY lang, k, gram),
nn AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, gram, f AS a, string_split(gram, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.gram, c.k, c.a, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp
  FROM c, range(1, 3) AS q(j) WHERE j < c.k),
sc AS (
  SELECT cuts.*, fl.f AS l, fr.f AS r,
         CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(fl.f AS HUGEINT) * fr.f) AS BIGINT) AS score
  FROM cuts JOIN f AS fl ON fl.lang = cuts.lang AND fl.gram = cuts.lp
            JOIN f AS fr ON fr.lang = cuts.lang AND fr.gram = cuts.rp),
best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) = 1),
kept AS (
  SELECT b.* FROM best AS b
  WHERE NOT EXISTS (
    SELECT 1 FROM c AS c3
    WHERE c3.k = 3 AND c3.lang = b.lang AND 100 * c3.a >= 50 * b.a
      AND (array_to_string(c3.ws[1:2], ' ') = b.gram OR array_to_string(c3.ws[2:3], ' ') = b.gram))),
ranked AS (
  SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, gram ASC) AS rank,
         gram AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
  FROM kept JOIN nn ON nn.lang = kept.lang)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
