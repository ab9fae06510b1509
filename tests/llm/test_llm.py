"""Operators of the llm folder against plain versions of what they compute, and their corner cases."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtloom.llm import components, html, language_model, lines, packing, quality, sharding, sketches, templates, toxicity, warc

SAMPLES = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, LONG), (6, "Same line here is long enough\nsame line here is long enough"), (6, "other text for the id"), (None, "no id at all but some words"), (7, "one two three"), (7, "one two three")]
#: Columns with names that operators use inside.
EXTRA = {"row": 1, "key": 2, "component": 3, "h1": 4, "id": 5, "c": 6, "n": 7, "chunk": 8}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SAMPLES}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", 0) for i, t in ODD]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({k: F.lit(v) for k, v in EXTRA.items()})


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def similar(sets, percent):
    """Pairs of keys whose sets reach a similarity in percent."""
    holders = defaultdict(list)
    for key, s in sets.items():
        for x in s:
            holders[x].append(key)
    common = Counter()
    for keys in holders.values():
        common.update((a, b) for i, a in enumerate(keys) for b in keys[:i])
    return [(a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]


def test_main_text_of_an_article_without_furniture():
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice">We use cookies, many, of them.</div><main><article><h1>Head &amp; line</h1><p>First,
    part&nbsp;one <a href=x>link</a>.<p><b>Second <script>no()</script>part<br>ends</p><ul><li>Item one<li>Item two</ul></article>
    <section id="comments"><p>A very long comment, with commas, by a reader who writes more than the article does, often.</p></section></main>
    <aside><p>Side, bar, text.</p></aside><form><p>Name</p></form><footer>End</footer></body></html>"""
    assert html.main_text(page) == "Head & line\nFirst, part one link.\nSecond part ends\nItem one\nItem two"


def test_main_text_without_an_article_element_keeps_siblings():
    paragraph = "<p>" + "Some words, more words, and still more words in a row. " * 4 + "</p>"
    page = f"<body><div class=menu><a href=1>a</a><a href=2>b</a></div><div><div>{paragraph}{paragraph}</div><div>{paragraph}</div></div></body>"
    assert html.main_text(page).count("\n") == 2


def test_main_text_keeps_title_lead_and_end_beside_the_container():
    paragraph = "<p>" + "Some words, more words, and still more words in a row. " * 4 + "</p>"
    sources = "<ul><li><a href=1>First source of it</a><li><a href=2>Second source</a></ul>"
    links = "<ul><li><a href=3>Elsewhere one</a><li><a href=4>Elsewhere two</a></ul>"
    page = f"<body><div class=post><h1>Title</h1><p>A lead in short.</p><div class=body>{paragraph * 8}{sources}</div><p>It ends here.</p><p><a href=5>All the posts of this site</a></p>{links}</div></body>"
    got = html.main_text(page).split("\n")
    assert got[:2] == ["Title", "A lead in short."] and got[-3:] == ["First source of it", "Second source", "It ends here."] and len(got) == 13


@pytest.mark.parametrize("page", [None, "", "<", "plain", "<p>", "<div>" * 5000 + "x", "<p>a" * 5000, "</p></div>", "<b><a><!-- x", "&#0;&bogus;&am"])
def test_main_text_of_broken_pages(page):
    assert isinstance(html.main_text(page), str)


def test_quality_measures_match_a_plain_count(docs, odd, texts):
    def plain(text):
        ws = WORDS.findall(text or "")
        seen, hits, first = Counter(), 0, set()
        windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
        counts = Counter(windows)
        covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
        for line in (text or "").split("\n"):
            if WORDS.search(line):
                hits += line in first
                first.add(line)
        failed = len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
        return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), hits, len(covered), failed)

    for frame, want in ((docs, Counter(map(plain, texts.values()))), (odd, Counter(plain(t) for _, t in ODD))):
        rows = quality.op2_threshold_table(frame).collect()
        assert Counter(tuple(r)[1:7] for r in rows) == want
        assert not any(r.kept and r.base_failed for r in rows)


def test_quality_verdict_follows_labels(spark, docs):
    kept = quality.op2_threshold_table(docs).where("NOT base_failed").join(spark.read.parquet(f"{SAMPLES}/labels.parquet"), "doc_id")
    assert kept.where("quality <> kept::int").count() == 0


def test_near_copies_match_all_pairs(spark, docs, odd, texts):
    def shingles(text):
        ws = WORDS.findall(lower(text))
        return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} - {()}

    base = " ".join(f"a{i}" for i in range(400))
    chain = {10_000 + i: base.replace("a100 ", f"b{i} ").replace(f"a{200 + i} ", f"c{i} ") for i in range(40)}
    every = {**texts, **chain}
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(list(chain.items()), "doc_id long, text string"))
    sets = {k: shingles(t) for k, t in every.items()}
    want = roots(similar(sets, 85), sets)
    got = {r.doc_id: r for r in sketches.op3_setsketch(frame).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    found = sketches.op3_setsketch(odd).collect()
    assert len(found) == len(ODD) and {r.component_id for r in found if r.doc_id in (4, 7)} == {4}
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert sketches.op3_setsketch(odd.limit(0)).count() == 0


def test_rare_buckets_find_the_links_of_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(components, "PAIRS_PER_ROW", -1)
    passage = [f"p{i}" for i in range(150)]
    texts = {i: passage.copy() for i in range(60)}
    for i, words in texts.items():
        for j in range(i % 12):
            words[(i * 7 + j * 11) % 150] = f"own{i if i % 5 else 0}x{j}"
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in texts.items()}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in sketches.op3_setsketch(frame).collect()}
    assert got == roots(similar(sets, 85), sets)


def test_registers_are_mergeable_and_estimate_similarity():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 1 << 63, n, np.uint64) for n in (300, 300, 600))
    left, right = np.concatenate([a, c]), np.concatenate([b, c])
    one, two, three, both = sketches.registers([left, right, a, np.unique(np.concatenate([left, right]))])
    assert (np.maximum(one, two) == both).all()
    found = sketches.similarity(one[None], two[None], np.array([900.0]), np.array([900.0]))[0]
    assert abs(found - 0.5) < 0.15


def test_language_model_base_is_exact_and_model_is_a_distribution(docs, odd, texts):
    def check(frame, rows_):
        words = [(k, [w.encode() for w in WORDS.findall(lower(t))] + [b""]) for k, t in rows_]
        held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
        count = Counter(w for k, ws in words if not held(k) for w in ws)
        n, v = sum(count.values()), len(count)
        want = Counter((k, held(k), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 4)) for k, ws in words)
        rows = language_model.op4_pitman_yor(frame).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == want
        assert all(r.score < 0 for r in rows)
        return rows

    rows = [r for r in check(docs, texts.items()) if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    check(odd, ODD)
    assert language_model.op4_pitman_yor(odd.limit(0)).count() == 0


def test_rare_words_have_contexts(spark):
    train = [f"a{i} b{i} z" for i in range(6000)] * 3
    rows = [(7_000_000 + i, t) for i, t in enumerate(train)]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2] + list(zip(held, ["a9 b9 z", "a9 b4009 z", "a9 never z"]))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in language_model.op4_pitman_yor(frame).where("held_out").collect()}
    seen, other, unknown = (score[k] for k in held)
    assert seen > other + 2 and other > unknown


def test_model_does_not_depend_on_chunks(docs, odd, monkeypatch):
    key = lambda r: (r.doc_id or -1, r.n_tokens, r.score)
    frame = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    want = sorted(map(key, language_model.op4_pitman_yor(frame).collect()))
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 2000)
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 20_000)
    got = sorted(map(key, language_model.op4_pitman_yor(frame).collect()))
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])


def test_drawn_numbers_are_binomial():
    rng = np.random.default_rng(4)
    got = language_model.drawn(np.full(40_000, 90), np.full(40_000, 0.1), rng.random(40_000))
    assert abs(got.mean() - 9) < 0.1 and abs(got.var() - 8.1) < 0.3


def test_packed_columns_come_back():
    columns = [np.array([5, -3, 1 << 62, 0]), np.arange(4)]
    assert all((a == b).all() for a, b in zip(columns, language_model.unpacked(language_model.packed(*columns), 2)))


def test_context_restaurants_sum_to_one():
    import pandas as pd

    sizes = np.full(6, 1 / 6)
    rows = pd.DataFrame({"chain": 0, "cls": [0, 0, 1], "f": [0, 3, 3], "n": [50, 1, 7]})
    p = language_model.seat_contexts(rows, sizes).groupby("cls")["p"].sum()
    assert np.allclose(p, 1)


def test_seating_of_few_customers_has_the_expected_mean():
    rng = np.random.default_rng(3)
    tables = language_model.seat(rng, np.full(20_000, 2), np.full(20_000, 0.5), np.zeros(20_000, np.int64), 0.5)
    assert abs(tables.mean() - (1 + 0.75 / 1.25)) < 0.02  # (1 + d) * base : 1 - d


def test_archives_round_trip(spark, odd):
    pages = odd.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"), "row", "key")
    rows = warc.op5_index_first(spark, pages).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in rows) == Counter((i, len((t or "").encode()), digest(t)) for i, t in ODD)
    assert all(r.intact for r in rows)
    by = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert by[1] == ("revisit", 2) and by[2] == ("response", None) and by[4] == ("revisit", 7)
    assert warc.op5_index_first(spark, pages.limit(0)).count() == 0


def test_ranges_coalesce():
    reads = list(warc.coalesced([("a", 0, 10), ("a", 10, 5), ("a", 10_000_000, 5), ("b", 0, 1)]))
    assert [(f, s, e, len(h)) for f, s, e, h in reads] == [("a", 0, 15, 2), ("a", 10_000_000, 10_000_005, 1), ("b", 0, 1, 1)]


def test_templates_read_each_text_once(spark, monkeypatch):
    plans, real = {}, templates.durable

    def durable(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(templates, "durable", durable)
    item = "a cow saw five dogs that had two small cats"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, "x"), (3, None)], "doc_id long, text string")
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    try:
        assert [r.doc_id for r in templates.op6_templates(docs, bench).collect()] == [1]
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")
    assert plans["hits"].count("regexp_extract_all") == 1


def test_template_tokens_of_odd_words(spark):
    text = "m 5 m in Big abc\u0085 \u00e9t\u00e9, (x). Old 7kg KM 3 Km. ... 9 kg, a\nb New"
    row = spark.createDataFrame([(text,)], "t string").select(templates.tokens(F.col("t")).alias("ts")).first()
    want = [("m", "m", "m"), ("<number>", "5", "<number>"), ("<unit>", "m", "<unit>"), ("in", "in", "in"), ("<name>", "big", "<name>"), ("abc", "abc", "abc")]
    want += [("\u00e9t\u00e9", "\u00e9t\u00e9", "\u00e9t\u00e9"), ("x", "x", "x"), ("old", "old", "<name>"), ("<number>", "7kg", "<number>"), ("<name>", "km", "<name>")]
    want += [("<number>", "3", "<number>"), ("<name>", "km", "<name>"), ("<number>", "9", "<number>"), ("<unit>", "kg", "<unit>"), ("a", "a", "a"), ("b", "b", "b"), ("<name>", "new", "<name>")]
    assert [tuple(t) for t in row.ts] == want


def test_templates_find_items_with_other_slots(spark, odd):
    item = "Maria had 12 apples and gave 5 kg of the apples to Peter before the long winter began"
    other = "Alice had 30 apples and gave 7 lb of the apples to Robert before the long winter began"
    mixed = "Maria had 12 apples and gave 5 kg of the apples to Peter before the other summer ended and more"
    bench = spark.createDataFrame([(1, item), (2, "x " * 40), (3, None), (None, item), (4, "too short")], "item_id long, text string")
    rows = [(1, f"Some text first.\n{item}.\nMore."), (2, f"Some words. {other}."), (3, mixed), (4, "clean " * 100), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1))
    found = {(r.doc_id, r.item_id): r.changed for r in templates.op6_templates(frame, bench).collect()}
    assert found == {(1, 1): False, (2, 1): True, (3, 1): False}
    assert sorted(r.doc_id for r in templates.without_leaks(frame, bench).collect()) == [4, 5]
    assert templates.op6_templates(odd, bench.limit(0)).count() == 0
    assert templates.without_leaks(odd, bench).columns == odd.columns


def leaked(spark, pairs):
    """Which documents leak the item beside them."""
    bench = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "item_id long, text string")
    frame = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(pairs)], "doc_id long, text string")
    return {r.doc_id for r in templates.op6_templates(frame, bench).where("doc_id = item_id").collect()}


def test_edited_and_long_quotes_leak(spark):
    words = [[f"{a}{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(100)] for a in "uvwx"]
    one, two, long, none = words[0][:39], words[1][:39], words[2], words[3][:60]
    pairs = [(one, one[:20] + ["more"] + one[20:]), (two, two[:13] + ["more"] + two[13:26] + ["word"] + two[26:]), (long, long[30:70]), (none, none[:20])]
    assert leaked(spark, [(" ".join(a), " ".join(b)) for a, b in pairs]) == {0, 1, 2}


def test_names_that_open_sentences_and_equal_values_leak(spark):
    story = "{0} has 12 apples in a bag. {0} gives away a few of the. {0} then eats one of the rest."
    sums = "there were once {} apples and also {} pears lying in the old bowl"
    assert leaked(spark, [(story.format("Tom"), story.format("Anna")), (sums.format(12, 5), sums.format(7, 7))]) == {0, 1}


def test_inconsistent_slots_are_no_leak(spark):
    item = "take 7 red balls and 9 blue balls then add 7 red balls and drop 9 blue balls again today"
    bad = "take 3 red balls and 4 blue balls then add 5 red balls and drop 6 blue balls again today"
    good = "take 3 red balls and 4 blue balls then add 3 red balls and drop 4 blue balls again today"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    frame = spark.createDataFrame([(1, bad), (2, good)], "doc_id long, text string")
    assert [r.doc_id for r in templates.op6_templates(frame, bench).collect()] == [2]


def test_leaks_match_plain_search(spark, docs, texts):
    bench = spark.read.parquet(f"{SAMPLES}/benchmark.parquet")
    flat = lambda t: " ".join(WORDS.findall(lower(t)))
    want = {(d, b.item_id) for b in bench.collect() for d, t in texts.items() if flat(b.text) in flat(t)}
    assert {(r.doc_id, r.item_id) for r in templates.op6_templates(docs, bench).collect()} == want


def test_shards_move_rows_into_the_new_one_only(docs, odd):
    for frame, n in ((docs, 200), (odd, len(ODD))):
        rows = sharding.op7_hash_tree(frame).collect()
        assert len(rows) == n and all(r.grown_shard in (r.shard, 40) for r in rows)
        by = defaultdict(list)
        for r in rows:
            by[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.op7_hash_tree(odd.limit(0)).count() == 0


def test_weights_steer_shards_and_confine_movement(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    leaf = lambda i, w: sharding.Node(f"shard{i}", w, shard=i)
    rack = lambda name, *ls: sharding.inner(name, list(ls))
    tree = lambda w: sharding.inner("root", [rack("r0", rack("k0", leaf(0, 1.0), leaf(1, w)), rack("k1", leaf(2, 1.0))), rack("r1", rack("k2", leaf(3, 1.0)))])
    rows = sharding.place(sharding.place(keys, tree(2.0), "a"), tree(1.0), "b").collect()
    share = Counter(r.a for r in rows)
    assert abs(share[1] / len(rows) - 0.4) < 0.02
    assert all(r.a == r.b for r in rows if r.a == 3)  # less weight in one region only sends rows away from it


def test_packing_is_whole_and_tight(docs, odd):
    for frame in (docs, odd):
        rows = packing.op8_best_fit(frame).collect()
        at = defaultdict(list)
        for r in rows:
            at[r.sequence_id].append((r.offset, r.length))
        for places in at.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= packing.CAPACITY
        total = sum(r.length for r in rows)
        assert len(at) <= 1.05 * math.ceil(total / packing.CAPACITY) + 1
    assert packing.op8_best_fit(odd.limit(0)).count() == 0


def test_tokens_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.VOCABULARY)
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    texts = ["", "a  b", " x", "a\n b", "a \nb", "it's 's", "<|endoftext|> a", "a <|endoftext|> b", "x  <|endoftext|><|endoftext|>\n\n y", "<|endoftext", "日本 x’s   é", "a\r\n\r\nb  "]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_cut(n, want):
    assert packing.cut(n, 8) == want


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(5)
    lengths = sorted(rng.integers(1, 101, 500).tolist(), reverse=True)
    rooms, want = [], []
    for n in lengths:
        fits = [i for i, r in enumerate(rooms) if r >= n]
        want.append(min((rooms[i] for i in fits), default=100))
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(100 - n)
    assert [100 - offset for _, offset in packing.best_fit(lengths, 100)] == want


def test_lines_match_all_pairs(docs, odd, texts):
    def plain(rows):
        found = [(k, i, " ".join(WORDS.findall(x)).lower()) for k, t in rows for i, x in enumerate((t or "").split("\n")) if WORDS.search(x)]
        classes = sorted({x for _, _, x in found})
        sets = {x: {x[i : i + 5] for i in range(len(x) - 4)} or {x} for x in classes}
        root = roots(similar(sets, 80), classes)
        groups = defaultdict(list)
        for k, i, x in sorted(found):
            groups[root[x]].append((k, i))
        return {p for g in groups.values() for p in g[1:]}

    want = plain(texts.items())
    got = {(r.doc_id, r.line) for r in lines.op9_fuzzy_lines(docs).where("dropped").collect()}
    assert got <= want and len(got) >= 0.97 * len(want)
    kept = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    for k, t in texts.items():
        rest = [x for i, x in enumerate(t.split("\n")) if (k, i) not in got]
        assert kept[k].text == "\n".join(rest) if any(map(WORDS.search, rest)) else k not in kept
    rows = lines.dedup_lines(odd)
    assert rows.columns == odd.columns
    left = [(r.doc_id, r.text) for r in rows.collect()]
    assert (1, None) in left and (2, "") in left and (6, "Same line here is long enough") in left and not any(k == 7 for k, _ in left)
    assert lines.op9_fuzzy_lines(odd.limit(0)).count() == 0


def test_short_lines_with_edits_meet(spark):
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    pairs = []
    while len(pairs) < 600:
        line = " ".join("".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(rng.integers(6, 10)))
        line = line if len(pairs) % 3 else line.replace(" ", "-")  # one word
        at = rng.integers(0, len(line), rng.integers(1, 4))
        other = "".join("9" if i in at else x for i, x in enumerate(line))
        a, b = ({x[i : i + 5] for i in range(len(x) - 4)} for x in (line, other))
        if 100 * len(a & b) >= 80 * len(a | b):
            pairs.append((line, other))
    frame = spark.createDataFrame([(i, "\n".join(p[side] for p in pairs)) for i, side in ((1, 0), (2, 1))], "doc_id long, text string")
    found = {r.line: r.component for r in lines.op9_fuzzy_lines(frame).where("doc_id = 2 AND dropped").collect()}
    assert len(found) >= 0.985 * len(pairs)


def test_toxicity_learns_planted_words(spark, odd):
    rng = np.random.default_rng(2)
    vocabulary = [f"{a}{b}" for a in ("the", "on", "er", "in", "th", "re") for b in ("at", "en", "ou", "nd", "ti", "ha")]
    plain = [" ".join(rng.choice(vocabulary, 60)) for _ in range(240)]
    texts_ = [t if i % 3 else t + " vil" + "aeio"[i % 4] + "xx " + t for i, t in enumerate(plain)]
    frame = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    rows = toxicity.op10_windows(frame, labels).where("held_out").collect()
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in rows) >= 0.95 * len(rows)
    found = toxicity.op10_windows(odd, labels.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.op10_windows(odd.limit(0), labels.limit(0)).count() == 0


def test_windows_cover_a_text():
    for n in (0, 1, 32, 33, 48, 100):
        starts = toxicity.windows(n)
        assert {j for s in starts for j in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))


def test_gradients_match_differences():
    model = {k: v.astype(np.float64) for k, v in toxicity.new_model().items()}
    rng = np.random.default_rng(0)
    inputs, rows = rng.normal(size=(6, toxicity.INPUTS)), np.array([[0, 1, 2, -1], [3, 4, 5, 0]])
    loss = lambda: toxicity.forward(model, toxicity.gates_of(model, inputs), rows)[0].sum()
    state = toxicity.forward(model, toxicity.gates_of(model, inputs), rows)[1]
    grads = toxicity.backward(model, inputs, rows, state, np.ones(2))
    for name in ("Wf", "Ub", "cb", "A", "v", "o"):
        flat, e = model[name].reshape(-1), 1e-3
        old = flat[1]
        flat[1] = old + e
        up = loss()
        flat[1] = old - e
        down = loss()
        flat[1] = old
        assert abs((up - down) / (2 * e) - grads[name].reshape(-1)[1]) < 2e-3


def test_pipeline_stages_keep_columns(spark, docs):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, SAMPLES).cache()
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= frame.count()
        frame = after
    assert corpus_pipeline.STAGES[-1][1](spark, frame, SAMPLES).count() >= frame.count()
