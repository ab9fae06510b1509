"""op11: the Merkle manifest against a plain build of the whole tree, and its corner cases."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from courtloom.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(d, s, l, n, t):
    return H([field(d), field(s), field(l), field(n), field(t)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        cur = out[-1]
        out.append([H(cur[i : i + 16]) for i in range(0, len(cur), 16)])
    return out


def path(levs, i):
    p = []
    for lev in levs[:-1]:
        j = i // 16 * 16
        p.append(("".join(lev[j : i]), "".join(lev[i + 1 : j + 16])))
        i //= 16
    return p


def plain(rows):
    """Every tree built whole in memory; rows (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], leaf(*r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by[s], key=lambda x: ((x[0] is not None, x[0] or 0), x[1])) for s in sources}
    levs = {s: levels([x[1] for x in trees[s]]) for s in sources}
    top = levels([levs[s][-1][0] for s in sources])
    out = []
    for si, s in enumerate(sources):
        for i, (d, h, r) in enumerate(trees[s]):
            p = path(levs[s], i) + path(top, si)
            t = r[4]
            if d is not None and t is not None and zlib.crc32(str(d).encode()) % 5 == 0:
                t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            x = leaf(d, s, r[2], r[3], t)
            for left, right in p:
                x = H([left, x, right])
            out.append((d, h, levs[s][-1][0], top[-1][0], H([a + b for a, b in p]), x, x == top[-1][0]))
    return out


def norm(rows):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


def run(frame):
    return manifest.manifest(frame).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()


def test_equals_plain_build_with_hot_source_nulls_and_repeats(spark):
    random.seed(7)
    rows = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else random.choice([None, "", "a", "b", "é", "Z", f"s{random.randint(0, 30)}"])
        rows.append((random.choice([None, i, i]), source, random.choice([None, "en"]), random.choice([None, 7]), random.choice([None, "", "Hello World", f"abc {i}", "Ünïcode ÀB"])))
    rows += rows[:25]
    assert norm(run(spark.createDataFrame(rows, SCHEMA))) == norm(plain(rows))


def test_small_trees_and_tampering(spark):
    rows = [(1, "one", "en", 3, "ABC"), (2, "two", None, None, None), (3, "two", "de", 1, "x")]
    got = run(spark.createDataFrame(rows, SCHEMA))
    assert norm(got) == norm(plain(rows))
    # A lone leaf is its subroot; a text without capitals, or a null one, folds back to the root.
    assert [r.leaf == r.subroot for r in got if r.doc_id == 1] == [True]
    assert all(r.verified == (r.folded_root == r.root) for r in got)


def test_tampered_rows_fail_only_with_capitals(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "s", "en", 4, "Text" if i % 2 else "text") for i in ids] + [(1000 + i, "s", "en", 4, "Text") for i in range(40)]
    got = {r.doc_id: r for r in run(spark.createDataFrame(rows, SCHEMA))}
    for i in ids:
        assert got[i].verified is (i % 2 == 0)
    assert norm(got.values()) == norm(plain(rows))


def test_empty_table_and_clashing_columns(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    rows = [(5, "s", "en", 1, "a"), (6, "s", "en", 1, "b")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit(1) for name in ("pos", "m", "hash", "path", "_tree", "_part", "t", "q", "root")})
    assert norm(run(frame)) == norm(plain(rows))


def test_long_text(spark):
    rows = [(1, "s", "en", 1, "Word " * 200_000), (2, "s", "en", 1, "x")]
    assert norm(run(spark.createDataFrame(rows, SCHEMA))) == norm(plain(rows))
