"""Toxicity of documents: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Every word has word inputs (its evidence in the training texts and a hashed embedding) and character inputs (the mean
and the largest evidence of its character n-grams).  The network reads overlapping windows of `WINDOW` words in both
directions; attention pools the states of a window into a logit, and a document has the logit of its worst window.
Training fits the network to a bounded sample of labelled rows; scoring runs in Arrow batches over whole texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom.llm.common import byte_batches, fresh
from courtloom.llm.sketches import Hasher, mix

#: Labelled rows that training uses at most of either label; the choice follows a hash of doc_id.
TRAIN_ROWS = 2000
WINDOW = 32
STRIDE = 16
HIDDEN = 8
BUCKETS = 1 << 17
EMBED = 6
GRAMS = (3, 4, 5)
INPUTS = EMBED + 3
EPOCHS = 6
LEAST_STEPS = 400
BATCH = 128
RATE = 0.02
SEED = 7
SLICE_WINDOWS = 20_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_EDGE = b" \t\n\r\x0b\x0c"
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def split(text: str | None) -> list[bytes]:
    """Lower-case words without the punctuation at their edges."""
    found = (w.strip(_PUNCTUATION) for w in (text or "").lower().encode().split())
    return [w for w in found if w]


def word_slots(vocabulary: list[bytes]) -> np.ndarray:
    """Bucket of each word."""
    data = np.frombuffer(b"\n".join(vocabulary) + b"\n", np.uint8)
    return (Hasher().word_hashes(data)[0] % np.uint64(BUCKETS)).astype(np.int64)


def gram_slots(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of the character n-grams of every word, its edges marked by blanks; each word has one or more."""
    data = np.frombuffer(b" " + b"  ".join(vocabulary) + b" ", np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in vocabulary])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(vocabulary)), sizes)
    at = np.arange(len(data))
    owners, slots = [], []
    for n in GRAMS:
        start = at[: max(0, len(data) - n + 1)]
        start = start[start + n <= ends[owner[start]]]
        value = np.zeros(len(start), np.uint64)
        for i in range(n):
            value = value * np.uint64(257) + data[start + i] + np.uint64(1)
        owners.append(owner[start])
        slots.append((mix(value + np.uint64(n * int(_GOLD) % (1 << 64))) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(slots)


def evidence(slots: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log-odds of the label given that a bucket occurs in a text, shrunk to nothing for buckets seen once."""
    counts = np.zeros((2, BUCKETS))
    for own, label in zip(slots, labels):
        counts[label, np.unique(own)] += 1
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    odds = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
    seen = counts.sum(0)
    return (odds * np.maximum(seen - 1, 0) / (seen + 3)).astype(np.float32)


def features(model: dict, vocabulary: list[bytes]) -> np.ndarray:
    """Input vectors of words."""
    if not vocabulary:
        return np.zeros((0, INPUTS), np.float32)
    words = word_slots(vocabulary)
    owner, grams = gram_slots(vocabulary)
    value = model["grams"][grams]
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(vocabulary)))
    total = np.add.reduceat(value[order], starts) / np.bincount(owner, minlength=len(vocabulary))
    most = np.maximum.reduceat(value[order], starts)
    bits = mix(words.astype(np.uint64) + _GOLD)[:, None] >> (np.arange(EMBED, dtype=np.uint64) * np.uint64(10))
    hashed = (bits & np.uint64(1023)).astype(np.float32) / 512 - 1
    return np.column_stack([model["words"][words], total, most, 0.3 * hashed]).astype(np.float32)


def windows(n: int) -> list[int]:
    """Starts of the windows over `n` words; together they cover all, and a text without words has an empty one."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def layout(documents: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Vocabulary, window rows of word numbers (-1 beyond the end) and the document of each window."""
    known: dict[bytes, int] = {}
    numbers = [np.fromiter((known.setdefault(w, len(known)) for w in d), np.int64, len(d)) for d in documents]
    starts = [windows(len(d)) for d in documents]
    owner = np.repeat(np.arange(len(documents)), [len(s) for s in starts])
    padded = np.full(sum(len(d) for d in documents) + WINDOW, -1)
    rows, base = [], 0
    for d, s in zip(numbers, starts):
        padded[base : base + len(d)] = d
        rows.append(base + np.array(s))
        base += len(d)
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    ends = np.cumsum([len(d) for d in documents])
    place = at[:, None] + np.arange(WINDOW)
    return list(known), np.where(place < ends[owner][:, None], padded[place], -1), owner


def new_model() -> dict:
    rng = np.random.default_rng(SEED)
    model = {}
    for way in "fb":
        model[f"W{way}"] = rng.normal(0, 0.4, (INPUTS, 3 * HIDDEN))
        model[f"U{way}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        model[f"c{way}"] = np.zeros(3 * HIDDEN)
    model |= {"A": rng.normal(0, 0.3, (2 * HIDDEN, HIDDEN)), "a": np.zeros(HIDDEN), "v": rng.normal(0, 0.3, HIDDEN), "o": rng.normal(0, 0.3, 2 * HIDDEN), "b": np.zeros(1)}
    return {k: x.astype(np.float32) for k, x in model.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def recur(gates: np.ndarray, rows: np.ndarray, u: np.ndarray, order: range) -> tuple[np.ndarray, list]:
    """States of a gated recurrent unit after every word, and what the way back needs.

    `gates` holds the input part of every word's gates, with a row of zeros behind them for places beyond the end.
    """
    h, k = np.zeros((len(rows), HIDDEN), np.float32), HIDDEN
    states, kept = np.zeros((rows.shape[1], len(rows), HIDDEN), np.float32), []
    for t in order:
        g, live = gates[rows[:, t]], (rows[:, t] >= 0)[:, None].astype(np.float32)
        zr = sigmoid(g[:, : 2 * k] + h @ u[:, : 2 * k])
        z, r = zr[:, :k], zr[:, k:]
        n = np.tanh(g[:, 2 * k :] + (r * h) @ u[:, 2 * k :])
        kept.append((h, z, r, n, live))
        h = h + live * (1 - z) * (n - h)
        states[t] = h
    return states, kept


def forward(model: dict, gates: dict[str, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logit of every window."""
    span = range(rows.shape[1])
    f, kf = recur(gates["f"], rows, model["Uf"], span)
    b, kb = recur(gates["b"], rows, model["Ub"], span[::-1])
    both = np.concatenate([f, b], axis=2)
    hidden = np.tanh(both @ model["A"] + model["a"])
    energy = np.where(rows.T >= 0, hidden @ model["v"], -1e9)
    weight = np.exp(energy - energy.max(0)) * (rows.T >= 0)
    weight = weight / np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[:, :, None] * both).sum(0)
    return pooled @ model["o"] + model["b"][0], (both, hidden, weight, pooled, kf, kb)


def gates_of(model: dict, inputs: np.ndarray) -> dict[str, np.ndarray]:
    pad = np.zeros((1, 3 * HIDDEN), np.float32)
    return {way: np.concatenate([inputs @ model[f"W{way}"] + model[f"c{way}"], pad]) for way in "fb"}


def backward(model: dict, inputs: np.ndarray, rows: np.ndarray, state: tuple, dlogit: np.ndarray) -> dict:
    """Gradients of all weights for the gradients of the logits."""
    both, hidden, weight, pooled, kf, kb = state
    k = HIDDEN
    out = {"o": pooled.T @ dlogit, "b": dlogit.sum(keepdims=True)}
    dpooled = dlogit[:, None] * model["o"]
    dweight = (both * dpooled).sum(2)
    denergy = weight * (dweight - (weight * dweight).sum(0))
    out["v"] = np.einsum("tbh,tb->h", hidden, denergy)
    dpre = denergy[:, :, None] * model["v"] * (1 - hidden**2)
    out["A"], out["a"] = np.einsum("tbi,tbh->ih", both, dpre), dpre.sum((0, 1))
    dboth = weight[:, :, None] * dpooled + dpre @ model["A"].T
    padded = np.concatenate([inputs, np.zeros((1, INPUTS), np.float32)])
    for way, kept, order, part in (("f", kf, range(rows.shape[1]), dboth[:, :, :k]), ("b", kb, range(rows.shape[1])[::-1], dboth[:, :, k:])):
        u = model[f"U{way}"]
        dw, du, dc, dh = np.zeros_like(model[f"W{way}"]), np.zeros_like(u), np.zeros(3 * k, np.float32), np.zeros((len(rows), k), np.float32)
        for t, (h, z, r, n, live) in zip(reversed(order), reversed(kept)):
            dh = dh + part[t]
            dn = dh * live * (1 - z) * (1 - n**2)
            dz = dh * live * (h - n) * z * (1 - z)
            drh = dn @ u[:, 2 * k :].T
            dr = drh * h * r * (1 - r)
            dg = np.concatenate([dz, dr, dn], axis=1)
            dw += padded[rows[:, t]].T @ dg
            dc += dg.sum(0)
            du[:, : 2 * k] += h.T @ dg[:, : 2 * k]
            du[:, 2 * k :] += (r * h).T @ dn
            dh = dh * (1 - live * (1 - z)) + drh * r + dg[:, : 2 * k] @ u[:, : 2 * k].T
        out |= {f"W{way}": dw, f"U{way}": du, f"c{way}": dc}
    return out


def logits(model: dict, inputs: np.ndarray, rows: np.ndarray) -> np.ndarray:
    gates = gates_of(model, inputs)
    parts = [forward(model, gates, rows[i : i + SLICE_WINDOWS])[0] for i in range(0, len(rows), SLICE_WINDOWS)]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def worst(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of the largest value of each owner, owners being sorted."""
    order = np.lexsort((-values, owner))
    return order[np.flatnonzero(np.diff(owner[order], prepend=-1))]


def one_of_copies(documents: list[list[bytes]]) -> list[int]:
    """Documents without those that share the least shingle hash of an earlier one, so copies do not count as evidence."""
    seen: dict[int, int] = {}
    hasher = Hasher()
    for i, d in enumerate(documents):
        own = hasher.sets([b" ".join(d)])[0]
        seen.setdefault(int(own[0]) if len(own) else -1, i)
    return sorted(seen.values())


def train(texts: list[str], labels: list[int]) -> dict:
    """Fit a model to texts with labels 0 or 1; without any label 1 it scores everything low."""
    documents = [split(t) for t in texts]
    chosen = one_of_copies(documents)
    documents, label = [documents[i] for i in chosen], np.array([labels[i] for i in chosen], np.int64)
    vocabulary, rows, owner = layout(documents)
    model = new_model()
    numbers = [np.unique(r[r >= 0]) for r in np.split(rows, np.flatnonzero(np.diff(owner)) + 1)] if len(rows) else []
    if vocabulary:
        slots = word_slots(vocabulary)
        gram_owner, grams = gram_slots(vocabulary)
        order = np.argsort(gram_owner, kind="stable")
        grams, bounds = grams[order], np.searchsorted(gram_owner[order], np.arange(len(vocabulary) + 1))
        model["words"] = evidence([slots[n] for n in numbers], label)
        model["grams"] = evidence([np.concatenate([grams[bounds[i] : bounds[i + 1]] for i in n]) if len(n) else n for n in numbers], label)
    else:
        model["words"] = model["grams"] = np.zeros(BUCKETS, np.float32)
    if not label.any() or label.all():
        model["o"][:] = 0
        model["b"][:] = 4.0 if len(label) and label.all() else -4.0
        return model
    inputs = features(model, vocabulary)
    trained = [k for k in model if k not in ("words", "grams")]
    first, second = ({k: np.zeros_like(model[k]) for k in trained} for _ in range(2))
    rng, step = np.random.default_rng(SEED), 0
    epochs = max(EPOCHS, LEAST_STEPS * BATCH // (2 * len(documents)))
    for epoch in range(epochs):
        # Each text is represented by its worst window, and by a random one if it is clean.
        picked = worst(owner, logits(model, inputs, rows) if epoch else rng.random(len(rows)) + np.maximum(inputs[:, 0], 0)[rows].max(1) * (rows >= 0).any(1))
        clean = np.flatnonzero(label[owner] == 0)
        extra = rng.choice(clean, min(len(clean), len(picked) // 2), replace=False)
        batch_rows, batch_label = np.concatenate([rows[picked], rows[extra]]), np.concatenate([label[owner[picked]], np.zeros(len(extra), np.int64)])
        order = rng.permutation(len(batch_rows))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            r, y = batch_rows[some], batch_label[some]
            used, back = np.unique(r, return_inverse=True)
            own_inputs = inputs[used[used >= 0]]
            r = back.reshape(r.shape) - (used[0] < 0)
            logit, state = forward(model, gates_of(model, own_inputs), r)
            grads = backward(model, own_inputs, r, state, ((sigmoid(logit) - y) / len(y)).astype(np.float32))
            step += 1
            for k in trained:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.99 * second[k] + 0.01 * grads[k] ** 2
                fair = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                model[k] = (model[k] - RATE * 0.1 ** (epoch / epochs) * fair).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    """Train on at most `rows` labelled rows of either label, in one task; rows held out never take part.

    Labels that repeat a doc_id count as toxic if one of them is; rows without doc_id or label are not used.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    usable = known.where(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)).withColumn("_order", F.xxhash64("doc_id"))
    parts = [usable.where(F.col("label") == y).orderBy("_order", "doc_id").limit(rows) for y in (0, 1)]
    chosen = parts[0].union(parts[1]).select("doc_id", "label")
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches]
        rows_ = pd.concat(got).sort_values(["doc_id", "text"]).drop_duplicates("doc_id") if got else pd.DataFrame({"text": [], "label": []})
        model = train([t or "" for t in rows_["text"]], rows_["label"].astype(int).tolist())
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    fitted = sample.repartition(1).mapInPandas(run, "model binary").first()  # no task runs over an empty table
    return bytes(fitted["model"]) if fitted else pickle.dumps(train([], []))


def score(documents: DataFrame, model: bytes) -> DataFrame:
    """doc_id, row (hash of the text) and score of every document."""
    spark = documents.sparkSession
    byte_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # about a megabyte, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = pickle.loads(shared.value)
        for batch in batches:
            scores, held, size = [], [], 0
            texts = batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                held.append(split(text))
                size += len(held[-1])
                if size >= 200_000 or i + 1 == len(texts):
                    vocabulary, rows, owner = layout(held)
                    values = logits(weights, features(weights, vocabulary), rows)
                    scores.append(sigmoid(values[worst(owner, values)].astype(float)))
                    held, size = [], 0
            columns = [batch.column(0), batch.column(2), pa.array(np.concatenate(scores) if scores else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "score"])

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("row"))
    return chosen.mapInArrow(run, "doc_id long, row long, score double")


def op10_windows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts have the score of an empty window.  Repeated rows, and rows without doc_id, are scored like
    any other; a row without doc_id is not held out.  Other columns are dropped.
    """
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents with a score below `least`; all columns stay."""
    d, r, t = (fresh(documents.columns, n) for n in ("_doc", "_row", "_text"))
    texts = documents.select("doc_id", "text")
    bad = score(texts, fit(texts, labels)).where(F.col("score") >= least).select(F.col("doc_id").alias(d), F.col("row").alias(r)).distinct()
    keyed = documents.withColumn(t, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return keyed.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.col(t) == F.col(r)), "left_anti").drop(t)
