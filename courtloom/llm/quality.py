"""Quality rules: a threshold table compiled into one projection.

`RULES` names a measure and the range it must lie in.  The measures are SQL expressions over two arrays, the words and
the lines of a text, bound once per row; the verdict is the conjunction of all ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom.functions.arrays import let
from courtloom.llm.common import BLANKS, words

WINDOW = 5
#: Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au aux avec dans de du en est et la le les par pas pour que qui sur un une "
    "como con del el las los no para por se su una y"
).split()
#: measure, least, most; None is no bound.
RULES = (
    ("n_words", 10, 100_000),
    ("mean_word_chars", 2, 12),
    ("symbol_ratio", None, 0.1),
    ("alpha_word_ratio", 0.7, None),
    ("stop_word_ratio", 0.05, None),
    ("dup_line_ratio", None, 0.3),
    ("repeat_word_ratio", None, 0.2),
)


def repeated_words(ws: Column, width: int = WINDOW) -> Column:
    """Number of words inside windows of `width` words that occur twice or more, the first time included."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (width - 1)), lambda i: F.xxhash64(F.slice(ws, i, width)))

    def covered(hs: Column) -> Column:
        indexed = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, i, by: F.coalesce(F.get(s, i)["h"] == F.get(s, i + by)["h"], F.lit(False))
        twice = let(indexed, lambda s: F.filter(s, lambda x, i: same(s, i, -1) | same(s, i, 1)))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        spans = let(at, lambda p: F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

    found = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)))
    return F.when(F.size(ws) <= width, F.lit(0).cast("long")).otherwise(found)


def duplicate_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{BLANKS}]"))
    return let(lines, lambda xs: (F.size(xs) - F.size(F.array_distinct(xs))).cast("long"))


def measures(df: DataFrame) -> DataFrame:
    """doc_id and the measures of its text; a null or blank text has no words and all ratios 0."""
    # A long fold per document is cheaper than moving its words, so all of it stays in the scan's stage.
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.regexp_replace(text, f"[{BLANKS}]+", "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    stop = "|".join(STOP_WORDS)
    edge = f"(?<![^{BLANKS}\\p{{Punct}}])(?i:{stop})(?![^{BLANKS}\\p{{Punct}}])"
    raw = df.select(
        "doc_id",
        count(f"[^{BLANKS}]+").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        let(words(text), lambda ws: repeated_words(ws)).alias("n_repeat_words"),
        count(f"(?<![^{BLANKS}])[^{BLANKS}]*?\\p{{L}}").alias("n_alpha_words"),
        count(edge).alias("n_stop_words"),
        count("\n").alias("n_line_ends"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    return raw.select(
        "*",
        (F.col("word_chars") / n).alias("mean_word_chars"),
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("n_alpha_words") / n).alias("alpha_word_ratio"),
        (F.col("n_stop_words") / n).alias("stop_word_ratio"),
        (F.col("n_dup_lines") / (F.col("n_line_ends") + 1)).alias("dup_line_ratio"),
        (F.col("n_repeat_words") / n).alias("repeat_word_ratio"),
    )


def verdict(rules=RULES) -> Column:
    """The threshold table as one boolean."""
    out = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            out = out & (F.col(name) >= F.lit(least))
        if most is not None:
            out = out & (F.col(name) <= F.lit(most))
    return out


def op2_threshold_table(documents: DataFrame, rules=RULES) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Every row gives a row, repeated ones and those without doc_id too; a null, empty or blank text fails the base.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures(documents).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
