"""Elements of a page to sections of label/value entries, as narrow array projections.

Stages, each a column expression over one page row:

    elements -> items      role, label, clean text and latest prompt of each element
             -> spans      statute codes, terms and event tables, which read ahead
             -> live       items left once overlapping spans are resolved, under their prompts
             -> blocks     values and spans cut at breaks
             -> sections   blocks under the header that names them
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtloom import vocab
from courtloom.functions.arrays import built_once, last_wins, let, map_runs, spread_first
from courtloom.functions.text import prompt_label
from courtloom.functions.values import term_text
from courtloom.sources.elements import BLOCK_PARTS, CASE_CLASSES, read_blocks

PAIR = "struct<label:string,value:string>"


def _has_class(e: Column, *names: str) -> Column:
    return e["flags"].bitwiseAND(F.lit(sum(1 << CASE_CLASSES.index(name) for name in names))) != 0


def items(elements: Column) -> Column:
    """Role and text of every element; nothing is dropped, so look-ahead offsets stay true.

    `since` is the place of the latest prompt. `sources.elements.html_items` gives the
    same items from the html; this is for elements that are there already.
    """

    def item(e: Column) -> Column:
        shown, prompt = ~_has_class(e, vocab.IGNORED_CLASS), _has_class(e, *vocab.PROMPT_CLASSES)
        value = _has_class(e, vocab.VALUE_CLASS)
        subheading = (
            (e["tag"] == "i")
            & e["parent"].eqNullSafe(F.lit("left"))
            & e["clean"].isin(*vocab.CHARGE_SUBHEADINGS)
        )
        breaks = e["tag"].isin(*vocab.BREAK_TAGS) & ~_has_class(e, vocab.STATEMENT_CLASS) & ~subheading
        return F.struct(
            e["pos"].alias("pos"),
            F.when(~shown, "ignored")
            .when(prompt, "prompt")
            .when(value, "value")
            .when(breaks, "break")
            .otherwise("other")
            .alias("role"),
            F.when(prompt & shown, prompt_label(e["text"], e["clean"])).alias("label"),
            e["clean"].alias("text"),
            (e["tag"] != "hr").alias("titled"),
            e["parent"].eqNullSafe(F.lit("th")).alias("in_th"),
            value.alias("holds_value"),
        )

    return spread_first(
        F.transform(elements, item),
        lambda x, i, xs: x["label"].isNotNull(),
        lambda x, head: x.withField("since", F.when(head["label"].isNotNull(), head["pos"])),
    )


def _text_at(xs: Column, at: Column) -> Column:
    return F.get(xs, at)["text"]


def _run_end(xs: Column, start: Column, goes_on) -> Column:
    """Index of the first item at or after `start` that does not satisfy `goes_on`."""
    tail = F.slice(xs, start + 1, F.size(xs))
    ends = F.filter(F.transform(tail, lambda x, i: F.when(~goes_on(x), start + i)), lambda i: i.isNotNull())
    return F.coalesce(F.get(ends, F.lit(0)), F.size(xs))


def _statute(xs: Column, i: Column) -> Column:
    parts = F.array(
        *[
            F.when(F.get(xs, i + n)["holds_value"], _text_at(xs, i + n)).otherwise("")
            for n in range(1, 10, 2)
        ]
    )
    code = F.array_join(F.filter(parts, lambda p: p != ""), ".")
    return F.when(i + 9 < F.size(xs), code)


def _term(xs: Column, i: Column) -> Column:
    term = term_text(*[F.nullif(_text_at(xs, i + n), F.lit("")) for n in (2, 4, 6, 8)])
    return F.when(i + 8 < F.size(xs), term)


def _event_rows(xs: Column, start: Column, body: Column, stop: Column) -> Column:
    def rows(names: Column, cells: Column) -> Column:
        width = F.size(names)
        per_row = F.when(F.size(cells) > 0, F.sequence(F.lit(0), F.ceil(F.size(cells) / width).cast("int") - 1))
        return F.transform(
            F.coalesce(per_row, F.array().cast("array<int>")),
            lambda r: last_wins(
                F.transform(
                    F.slice(cells, r * width + 1, width),
                    lambda cell, c: F.struct(F.get(names, c)["text"].alias("label"), cell["text"].alias("value")),
                )
            ),
        )

    return let(
        F.slice(xs, start + 1, body - start),
        lambda names: let(F.slice(xs, body + 1, stop - body), lambda cells: rows(names, cells)),
    )


def spans(page_items: Column, lossy_skips: bool = False) -> Column:
    """Look-ahead reads of a page, `array<struct<start,stop,kind,label,key,text,rows>>`.

    `[start, stop)` is what a span consumes.  `lossy_skips` also consumes the one
    element after a statute code or event table.
    """
    extra = 1 if lossy_skips else 0

    def span(kind, start, stop, label, key, text, rows=None):
        return F.struct(
            start.alias("start"),
            stop.alias("stop"),
            F.lit(kind).alias("kind"),
            label.alias("label"),
            key.alias("key"),
            text.alias("text"),
            (F.lit(None) if rows is None else rows).cast(f"array<array<{PAIR}>>").alias("rows"),
        )

    def found(xs: Column) -> Column:
        def at(x: Column) -> Column:
            i = x["pos"]
            event_table = let(
                _run_end(xs, i, lambda y: y["in_th"]),
                lambda body: let(
                    _run_end(xs, body, lambda y: y["holds_value"]),
                    lambda stop: span(
                        "event table",
                        i,
                        F.when(stop < F.size(xs), stop + extra).otherwise(stop),
                        x["label"],
                        F.lit(None).cast("string"),
                        F.lit(None).cast("string"),
                        _event_rows(xs, i, body, stop),
                    ),
                ),
            )
            return (
                F.when(
                    (x["label"] == "Article") & _text_at(xs, i + 2).eqNullSafe(F.lit("Sec:")),
                    span("statute", i, i + 10 + extra, x["label"], F.lit("Statute Code"), _statute(xs, i)),
                )
                .when(
                    x["label"].isin(*vocab.TERM_PROMPTS),
                    span("term", i, i + 9, x["label"], x["label"], _term(xs, i)),
                )
                .when((x["label"] == "Event Type") & x["in_th"], event_table)
            )

        anchors = F.filter(xs, lambda x: x["label"].isin("Article", *vocab.TERM_PROMPTS, "Event Type"))
        return F.filter(F.transform(anchors, at), lambda s: s.isNotNull())

    return let(page_items, found)


def keep_spans(all_spans: Column) -> Column:
    """Spans that fire: one that starts inside an earlier kept span does not."""

    def greedy(ss: Column) -> Column:
        empty = F.struct(F.lit(0).alias("free"), F.array().cast("array<int>").alias("starts"))
        kept = F.aggregate(
            ss,
            empty,
            lambda acc, s: F.when(
                s["start"] >= acc["free"],
                F.struct(s["stop"].alias("free"), F.array_append(acc["starts"], s["start"]).alias("starts")),
            ).otherwise(acc),
        )["starts"]
        return let(kept, lambda starts: F.filter(ss, lambda s: F.array_contains(starts, s["start"])))

    def resolve(ss: Column) -> Column:
        touching = F.exists(
            F.transform(ss, lambda s, i: F.get(ss, i + 1)["start"] < s["stop"]),
            lambda clash: F.coalesce(clash, F.lit(False)),
        )
        return F.when(touching, greedy(ss)).otherwise(ss)

    return let(all_spans, resolve)


def live_items(page_items: Column, kept_spans: Column) -> Column:
    """Items outside every kept span, with one item standing in for each span, under the latest prompt before them.

    Headers do not reset the prompt; prompts inside a span are gone with it, so
    the span's own holds until the next one behind the span.
    """

    def plain(x: Column, label: Column) -> Column:
        return F.struct(
            x["pos"].alias("pos"),
            x["role"].alias("role"),
            label.alias("label"),
            x["text"].alias("text"),
            x["titled"].alias("titled"),
            F.lit(None).cast("string").alias("key"),
            F.lit(None).cast(f"array<array<{PAIR}>>").alias("rows"),
        )

    def stand_in(s: Column) -> Column:
        return F.struct(
            s["start"].alias("pos"),
            F.lit("span").alias("role"),
            s["label"].alias("label"),
            s["text"].alias("text"),
            F.lit(False).alias("titled"),
            s["key"].alias("key"),
            s["rows"].alias("rows"),
        )

    def weave(xs: Column, ss: Column) -> Column:
        def after(first: Column, next_span: Column, label=None) -> Column:
            length = F.coalesce(F.get(ss, next_span)["start"], F.size(xs)) - first
            own = lambda x: F.get(xs, x["since"])["label"]
            under = own if label is None else lambda x: F.when(x["since"] >= first, own(x)).otherwise(label)
            return F.transform(F.slice(xs, first + 1, F.greatest(length, F.lit(0))), lambda x: plain(x, under(x)))

        first = after(F.lit(0), F.lit(0))
        others = F.transform(
            ss, lambda s, k: F.flatten(F.array(F.array(stand_in(s)), after(s["stop"], k + 1, s["label"])))
        )
        return F.when(F.size(ss) > 0, F.flatten(F.array(first, F.flatten(others)))).otherwise(first)

    return let(page_items, lambda xs: let(kept_spans, lambda ss: weave(xs, ss)))


def labelled(live: Column) -> Column:
    """Each break, value and span; other items have done their part, but for the page's first, which opens its first block."""
    return F.filter(live, lambda x: x["role"].isin("value", "break", "span") | (x["pos"] == 0))


def _pairs(block_items: Column) -> Column:
    """`array<struct<pos,label,value>>` in page order, span results included."""
    is_pair = lambda x: (
        (x["role"] == "value") & (x["label"] != "") & (x["text"] != vocab.NOISE_VALUE)
    ) | x["key"].isNotNull()
    return F.transform(
        F.filter(block_items, is_pair),
        lambda x: F.struct(
            x["pos"].alias("pos"), F.coalesce(x["key"], x["label"]).alias("label"), x["text"].alias("value")
        ),
    )


def blocks(live: Column) -> Column:
    """Blocks of a page's labelled items, `array<struct<title,pairs,entries>>`.

    `pairs` are all label/value reads of the block; `entries` are its records,
    event-table rows first, then the block's own pairs with repeats collapsed.
    """

    def block(run: Column) -> Column:
        head = F.get(run, F.lit(0))

        def records(pairs: Column) -> Column:
            rows = F.flatten(F.filter(F.transform(run, lambda x: x["rows"]), lambda r: r.isNotNull()))
            own = F.when(
                F.size(pairs) > 0,
                F.array(last_wins(F.transform(pairs, lambda p: F.struct(p["label"].alias("label"), p["value"].alias("value"))))),
            ).otherwise(F.array().cast(f"array<array<{PAIR}>>"))
            return F.flatten(F.array(rows, own))

        return let(
            _pairs(run),
            lambda pairs: F.struct(
                F.when((head["role"] == "break") & head["titled"], F.nullif(head["text"], F.lit(""))).alias("title"),
                pairs.alias("pairs"),
                records(pairs).alias("entries"),
            ),
        )

    return map_runs(live, lambda x, i, xs: x["role"] == "break", block)


def titled(untitled: Column) -> Column:
    """Each block under the latest header at or before it; the titles alone are carried, the blocks copied once."""

    def over(bs: Column) -> Column:
        titles = spread_first(
            F.transform(bs, lambda b: F.struct(b["title"].alias("title"))),
            lambda b, i, xs: b["title"].isNotNull(),
            lambda b, head: F.struct(F.coalesce(head["title"], F.lit(vocab.DEFAULT_TITLE)).alias("title")),
        )
        return let(titles, lambda ts: F.transform(bs, lambda b, i: b.withField("title", F.get(ts, i)["title"])))

    return let(untitled, over)


@built_once
def _stage(name: str, *flags) -> Column:
    """The expression of a stage over the columns the stages before it leave."""
    builders = {
        "items": lambda: items(F.col("elements")),
        "spans": lambda lossy_skips: spans(F.col("items"), lossy_skips),
        "kept": lambda: keep_spans(F.col("spans")),
    }
    return builders[name](*flags)


def _with_items(pages: DataFrame) -> DataFrame:
    return pages if "items" in pages.columns else pages.withColumn("items", _stage("items")).drop("elements")


def with_spans(pages: DataFrame, lossy_skips: bool = False) -> DataFrame:
    """Adds all `spans` and the `kept` ones to pages that have `items`, or `elements` in place of them."""
    return _with_items(pages).withColumn("spans", _stage("spans", lossy_skips)).withColumn("kept", _stage("kept"))


def with_blocks(
    pages: DataFrame, lossy_skips: bool = False, page_items: Column | None = None, parts=tuple(BLOCK_PARTS)
) -> DataFrame:
    """Replaces `items` (or `elements`) by titled `blocks`, which equal the column expressions of this module.

    With `page_items`, items as `html_items` makes them, pages need no such column and items stay in the worker.
    `parts` are the fields of a block that the caller reads.
    """
    if page_items is not None:
        return pages.withColumn("blocks", read_blocks(page_items, lossy_skips, parts))
    return _with_items(pages).withColumn("blocks", read_blocks(F.col("items"), lossy_skips, parts)).drop("items")
