"""Benchmark decontamination by templates; DataFrame operations only.

Numbers, names and units become typed placeholders, so a question with other numbers has the template of the original.
Windows of eight template tokens of the benchmark are hash-joined with those of the documents.  Matches of a document
and an item with the same shift are one alignment; alignments of near shifts, which inserted or missing words part, are
taken together.  A value of the item stands for one value of the document there, and windows that clash with it go.  A
document leaks an item if what is left covers half of its windows, or half of those with literals enough, or if one
alignment holds a long run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom.functions.arrays import let
from courtloom.llm.common import fresh, words
from courtloom.session import durable

WINDOW = 8
LITERALS = 4
#: Shifts this near belong together, or a quarter of the windows of the item.
NEAR = 4
#: Neighbouring windows of one alignment that are a leak by themselves: 32 tokens.
RUN = 25
#: Windows with literals enough below which they do not stand for an item.
LEAST_USABLE = 4
COVERAGE = 50
#: Benchmark windows up to which they are broadcast: about 100 bytes each.
BROADCAST_WINDOWS = 500_000
#: Unit words; they are placeholders only after a number.
UNITS = (
    "mm cm m km mg g kg t ml l s h min in ft yd mi oz lb lbs gal mph kmh hz kw w v a kb mb gb "
    "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers gram grams kilogram kilograms pound pounds ounce ounces "
    "liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years percent degree degrees "
    "dollar dollars cent cents euro euros"
).split()
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def tokens(text: Column) -> Column:
    """Template tokens of a text: structs of c (placeholder or lower-case word), v (what stood there) and o.

    A number has a digit first; a name is a capitalised word that opens no sentence; a unit follows a number.  A
    capitalised opener may be a name or not, so it has a second reading, o, as a name; for all others o is c.  Words
    lose the punctuation at their edges.
    """
    digit = lambda w: w.rlike(r"^[^\p{L}\p{N}]*\p{N}")
    ends = lambda w: w.rlike(r"[.!?:\n]['\")\]]*$")
    # A line break ends a sentence too: it becomes a mark at the word before it.
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09]*\n", ". ")

    def typed(ws: Column) -> Column:
        def entry(c: Column | str, v: Column, o: Column | str) -> Column:
            return F.struct(*[(F.lit(x) if isinstance(x, str) else x).alias(n) for n, x in zip("cvo", (c, v, o))])

        # Lambdas are interpreted and share nothing, so each word is matched once and what several fields need is bound.
        def one(w: Column, i: Column) -> Column:
            measured = w.isin(UNITS) & (i > 0) & F.coalesce(digit(F.get(ws, i - 1)), F.lit(False))
            lower = F.when(measured, entry(UNIT, w, UNIT)).otherwise(entry(w, w, w))
            return F.when(w.rlike(r"^[a-z]+\z"), lower).otherwise(let(F.lower(F.regexp_replace(w, EDGES, "")), lambda bare: other(w, i, bare)))

        def other(w: Column, i: Column, bare: Column) -> Column:
            before = F.get(ws, i - 1)
            capital = w.rlike(r"^[^\p{L}\p{N}]*\p{Lu}")
            opener = (i == 0) | ends(before)
            name = capital & ~F.coalesce(opener, F.lit(False))
            unit = bare.isin(UNITS) & (i > 0) & digit(before)
            special = F.when(digit(w), NUMBER).when(name, NAME).when(unit, UNIT).otherwise(bare)
            plain = ~w.rlike(r"[\p{Lu}\p{N}]") & ~(bare.isin(UNITS))
            typed_ = let(special, lambda c: entry(c, bare, F.when((c == bare) & capital, NAME).otherwise(c)))
            return F.when(plain, entry(bare, bare, bare)).otherwise(typed_)

        return F.filter(F.transform(ws, one), lambda t: t["v"] != "")

    return let(words(marked), typed)


def window_hashes(ts: Column, width: int, reading: str) -> Column:
    """Hash of every window's template in one reading, in order: of the hashes of its tokens, so that each is hashed once."""
    whole = F.transform(ts, lambda t: F.xxhash64(t[reading]))
    starts = F.sequence(F.lit(1), F.size(ts) - (width - 1))
    hashes = let(whole, lambda cs: F.transform(starts, lambda i: F.xxhash64(F.slice(cs, i, width))))
    return F.when(F.size(ts) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def both_readings(ts: Column, width: int) -> Column:
    """Structs of at, h and second (whether it is the second reading) of every window; a second reading only where it differs."""

    def found(hs: Column) -> Column:
        one = F.transform(hs["c"], lambda h, i: F.struct(i.alias("at"), h.alias("h"), F.lit(False).alias("second")))
        two = F.transform(hs["o"], lambda h, i: F.struct(i.alias("at"), h.alias("h"), F.lit(True).alias("second")))
        return F.concat(one, F.filter(two, lambda x: x["h"] != F.get(hs["c"], x["at"])))

    return let(F.struct(window_hashes(ts, width, "c").alias("c"), window_hashes(ts, width, "o").alias("o")), found)


def joint_hashes(ts: Column, width: int) -> Column:
    """Window hashes of the first reading, then as many of the second, null where they do not differ: numbers only, for whole texts."""
    hashes = F.struct(window_hashes(ts, width, "c").alias("c"), window_hashes(ts, width, "o").alias("o"))
    return let(hashes, lambda hs: F.concat(hs["c"], F.zip_with(hs["c"], hs["o"], lambda c, o: F.nullif(o, c))))


def slots(ts: Column, start: Column, width: Column | int, second: Column) -> Column:
    """Placeholders of a window with their values, in the reading asked for: structs of c and v."""
    read = F.transform(F.slice(ts, start, width), lambda t: F.struct(F.when(second, t["o"]).otherwise(t["c"]).alias("c"), t["v"].alias("v")))
    return F.filter(read, lambda t: t["c"].startswith("<"))


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, at, h, windows (of the item), usable (windows with literals enough), slots and literals of every window.

    An item of fewer tokens than a window, but five or more, is one window of its own width.
    """
    ts = benchmark.where("item_id IS NOT NULL").select("item_id", tokens(F.col("text")).alias("ts")).distinct().where(F.size("ts") >= 5)
    wide = ts.withColumn("width", F.least(F.size("ts"), F.lit(width)))
    parts = [wide.where(F.col("width") == n).select("item_id", "width", "ts", F.explode(both_readings(F.col("ts"), n)).alias("w")) for n in range(5, width + 1)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    rows = rows.select("item_id", "width", "ts", "w.*")
    own = rows.withColumn("slots", slots(F.col("ts"), F.col("at") + 1, F.col("width"), F.col("second")))
    own = own.withColumns({"windows": F.size("ts") - F.col("width") + 1, "literals": F.col("width") - F.size("slots")}).drop("ts", "second").distinct()
    usable = own.groupBy("item_id", "windows").agg(F.count_distinct(F.when(F.col("literals") >= LITERALS, F.col("at"))).alias("usable"))
    return own.join(usable, ["item_id", "windows"])


def leaks(documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """(doc_id, row, item_id, matched, windows, changed) of documents that leak an item.

    `row` is the hash of the text, `matched` counts windows of the item, `changed` tells that slots hold other values.
    """
    items = durable(item_windows(benchmark, width), "items")
    wanted = items.select("h").distinct()
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # at most `width` numbers
    keys = F.broadcast(wanted) if items.count() <= BROADCAST_WINDOWS else wanted
    docs = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("row"))
    template = docs.select("doc_id", "row", tokens(F.col("text")).alias("ts"))
    hits = None
    for n in sorted(widths):
        # An inner explode would add a filter on the size of the array, and with it read every text twice and more.
        read = template.select("doc_id", "row", joint_hashes(F.col("ts"), n).alias("hs")).select("doc_id", "row", F.shiftright(F.size("hs"), 1).alias("n"), F.posexplode_outer("hs").alias("place", "h"))
        found = read.join(keys, "h").select("doc_id", "row", (F.col("place") % F.col("n")).alias("pos"), "h", (F.col("place") >= F.col("n")).alias("second"), F.lit(n).alias("width"))
        hits = found if hits is None else hits.union(found)
    if hits is None:  # nothing to look for
        return docs.limit(0).select("doc_id", "row", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), *[F.lit(0).cast("long").alias(c) for c in ("matched", "windows")], F.lit(False).alias("changed"))
    hits = durable(hits, "hits")
    places = hits.groupBy("doc_id", "row").agg(F.collect_set(F.struct("pos", "h", "width", "second")).alias("places"))  # at most two per word of a text
    again = docs.join(places.withColumnRenamed("doc_id", "_doc"), (F.col("doc_id").eqNullSafe(F.col("_doc"))) & (docs["row"] == places["row"])).select("doc_id", docs["row"], "text", "places")
    again = again.select("doc_id", "row", tokens(F.col("text")).alias("ts"), "places")
    seen = let(F.col("ts"), lambda ts: F.transform("places", lambda p: F.struct(p["pos"].alias("pos"), p["h"].alias("h"), slots(ts, p["pos"] + 1, p["width"], p["second"]).alias("seen"))))
    filled = again.select("doc_id", "row", F.explode(seen).alias("p")).select("doc_id", "row", "p.pos", "p.h", "p.seen").distinct()
    pairs = filled.join(items, "h").where((F.col("literals") >= LITERALS) | (F.col("seen") == F.col("slots")))
    pairs = pairs.withColumn("fills", F.zip_with("slots", "seen", lambda a, b: F.struct(a["c"].alias("kind"), a["v"].alias("a"), b["v"].alias("b"))))
    # Edits move what follows them: alignments whose shifts lie in one band are read together, and bands overlap by half.
    reach = F.greatest(F.lit(NEAR), (F.col("windows") / 4).cast("int"))
    shift = F.col("pos") - F.col("at")
    bands = F.array_distinct(F.array(F.floor(shift / (2 * reach)) * 2, F.floor((shift + reach) / (2 * reach)) * 2 + 1))
    placed = pairs.withColumns({"shift": shift, "band": F.explode(bands)}).select("doc_id", "row", "item_id", "windows", "usable", "band", "shift", "at", "pos", "literals", "fills")
    placed = durable(placed.distinct(), "placed")
    place = ["doc_id", "row", "item_id", "windows", "usable", "band"]
    # A value of the item has one value of the document, that of most windows; a window with another one goes.
    votes = placed.select(*place, F.explode("fills").alias("f")).groupBy(*place, "f").agg(F.count("*").alias("n"))
    won = votes.groupBy(*place, "f.kind", "f.a").agg(F.max(F.struct("n", (F.col("f.a") == F.col("f.b")).alias("same"), "f.b"))["b"].alias("b"))
    won = won.groupBy(*place).agg(F.collect_set(F.struct("kind", "a", "b")).alias("won"))  # at most one per token of an item
    judged = placed.alias("x").join(won.alias("y"), F.expr(" AND ".join(f"x.{c} <=> y.{c}" for c in place)), "left").select("x.*", "won")
    agreed = judged.where(F.forall("fills", lambda f: F.array_contains("won", f)))
    runs = agreed.groupBy(*place, "shift").agg(F.collect_set("at").alias("ats"))  # at most the windows of one item
    longest = F.aggregate(F.array_sort("ats"), F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best")), step, lambda s: s["best"])
    run = runs.groupBy(*place).agg(F.max(longest).alias("run"))
    changed = F.exists("fills", lambda f: f["a"] != f["b"])
    able = F.when(F.col("literals") >= LITERALS, F.col("at"))
    summed = agreed.groupBy(*place).agg(F.count_distinct("at").alias("matched"), F.count_distinct(able).alias("able"), F.max(changed).alias("changed"))
    summed = summed.alias("x").join(run.alias("y"), F.expr(" AND ".join(f"x.{c} <=> y.{c}" for c in place))).select("x.*", "run")
    covered = (100 * F.col("matched") >= coverage * F.col("windows")) | (F.col("able") >= LEAST_USABLE) & (100 * F.col("able") >= coverage * F.col("usable"))
    enough = summed.where(covered | (F.col("run") >= RUN))
    return enough.groupBy("doc_id", "row", "item_id", "windows").agg(F.max("matched").alias("matched"), F.min("changed").alias("changed")).select("doc_id", "row", "item_id", F.col("matched").cast("long"), F.col("windows").cast("long"), "changed")


def step(s: Column, at: Column) -> Column:
    """The longest run of neighbouring windows, one window further."""
    return let(F.when(at == s["last"] + 1, s["n"] + 1).otherwise(1), lambda n: F.struct(at.alias("last"), n.alias("n"), F.greatest(s["best"], n).alias("best")))


def op6_templates(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every leak: doc_id, item_id, matched, windows, changed.

    Null and empty texts leak nothing.  Items without item_id or with fewer than five tokens are not looked for.  Rows
    that repeat a doc_id with another text are looked at each, and a repeated row gives its leaks once.
    """
    return leaks(documents, benchmark).groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("windows").alias("windows"), F.min("changed").alias("changed"))


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that leak no item; all columns stay."""
    d, r, t = (fresh(documents.columns, n) for n in ("_doc", "_row", "_text"))
    bad = leaks(documents.select("doc_id", "text"), benchmark).select(F.col("doc_id").alias(d), F.col("row").alias(r)).distinct()
    keyed = documents.withColumn(t, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return keyed.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.col(t) == F.col(r)), "left_anti").drop(t)
