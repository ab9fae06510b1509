"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Tokenising runs in Arrow batches where the documents lie and hands on one small row per piece.  Pieces that fill
a sequence are done; the others are dealt by hash into lanes of about `LANE_PIECES` pieces, and every lane is
packed by itself, so that no group grows with the corpus.  A lane leaves at most a few sequences unfilled, against
tens of thousands that it fills.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtloom.llm.common import byte_batches, tasks_for
from courtloom.session import durable

CAPACITY = 2048
LANE_PIECES = 200_000
VOCABULARY = "byte_bpe_50k.json"
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_of_symbol() -> dict[str, int]:
    """The byte behind each printable symbol of a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes follow from U+0100 on in rising order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    """Text to token ids as little-endian unsigned 32-bit bytes, by the byte-level BPE of a tokenizers file.

    Merges have the order of the ids, so the vocabulary is the ranking.  Added tokens of the file (such as
    `<|endoftext|>`) are found in the text first and give their own ids, as the tokenizer does; the text between them
    is split by the pattern.  Only a run of several white-space characters needs the pattern's look-ahead; the other
    texts are split without it, which gives the same pieces in less time.
    """

    LOOK_AHEAD = r"|\s+(?!\S)"
    RUN = re.compile(r"\s\s")

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        to_byte = byte_of_symbol()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        def made(pattern: str):
            encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
            return lambda text: encoding.encode(text, allowed_special="all", disallowed_special=())

        self.full, self.plain = made(public_tokenizers.PATTERN), made(public_tokenizers.PATTERN.replace(self.LOOK_AHEAD, ""))

    def encode(self, text: str) -> bytes:
        ids = (self.full if self.RUN.search(text) else self.plain)(text)
        return np.array(ids, "<u4").tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of `n` ids; only the first may be short of the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document is the ids of its text, then id 0; a null or empty text is id 0 alone.  Repeated rows and rows without
    doc_id are documents of their own.  Other columns are not looked at.
    """
    byte_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        encoder = Encoder(path)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + b"\0\0\0\0"
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [()] * 5, schema)], schema=schema)

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, PIECE_SCHEMA)


class OpenBins:
    """Segment tree over remaining capacities: how many open bins have each, and the tightest that holds a length."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.open[node] += by
            node >>= 1

    def put(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of an open bin with the least room of at least `length`."""
        node, tree = length + self.size, self.open
        while not tree[node]:
            while node & 1:  # no room further right below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per item, for items given in falling order of length."""
    tree, out, bins = OpenBins(capacity), [], 0
    for length in lengths:
        found = tree.take(length) if length else (0, 0)
        if found is None:
            found = (capacity, bins)
            bins += 1
        room, bin_ = found
        out.append((bin_, capacity - room))
        if room > length:
            tree.put(room - length, bin_)
    return out


def pack(items: DataFrame, capacity: int = CAPACITY, lane_pieces: int = LANE_PIECES) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece and length (1 to `capacity`).

    Rows of full length take a sequence each.  Ties in length are taken in the order of doc_id and piece.
    """
    stored = durable(items, "pieces")
    lanes = tasks_for(items.sparkSession, stored.where(F.col("length") < capacity).count(), lane_pieces)
    lane = F.when(F.col("length") >= capacity, -1).otherwise(F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(lanes))).cast("long")
    dealt = stored.withColumn("_lane", lane)
    full = dealt.where("_lane = -1").withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))

    def one_lane(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        placed = best_fit(rows["length"].tolist(), capacity)
        lane_id = int(rows["_lane"].iloc[0])
        return rows.assign(sequence_id=[(lane_id << 32) + b for b, _ in placed], offset=[o for _, o in placed])

    packed = dealt.where("_lane >= 0").groupBy("_lane").applyInPandas(one_lane, full.schema)
    return full.unionByName(packed).drop("_lane")


def op8_best_fit(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return pack(pieces(documents, vocabulary))
