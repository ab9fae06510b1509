"""Linear-time array idioms for page-local work.

A case page is one row.  Keeping its elements in an array column lets the whole
page be parsed by narrow projections, so no element is ever shuffled and a page
never meets another page that happens to carry the same id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the columns that `build` makes from plain arguments.

    A column is an unresolved expression that any plan may use; a large one costs
    seconds of calls into the JVM, which each stream batch would pay again.
    """

    @lru_cache(64)
    def kept(_gateway: int, *args) -> Column:
        return build(*args)

    return wraps(build)(lambda *args: kept(id(SparkContext._gateway), *args))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` to a name inside `body`, evaluated once per row.

    Referring to a derived array inside a lambda would otherwise re-evaluate it
    for every array item.  A fold over nothing starts and ends with the value, and
    unlike a one-item `transform` it does not copy it.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def map_runs(items: Column, opens: Callable[[Column, Column, Column], Column], body: Callable[[Column], Column]) -> Column:
    """Cut an array into runs and apply `body` to each.

    A run starts at 0 and wherever `opens(item, i, items)` holds.
    """

    def cut(xs: Column) -> Column:
        marks = F.filter(
            F.transform(xs, lambda x, i: F.when((i == 0) | opens(x, i, xs), i)),
            lambda i: i.isNotNull(),
        )
        return let(
            marks,
            lambda at: F.transform(
                at,
                lambda start, k: let(
                    F.slice(xs, start + 1, F.coalesce(F.get(at, k + 1), F.size(xs)) - start), body
                ),
            ),
        )

    return let(items, cut)


def spread_first(items: Column, opens, stamp, keep=None) -> Column:
    """Carry the item that opened a run over the run: `stamp(item, first_of_run)`.

    With `keep`, only the items that satisfy it are stamped and stay.
    """

    def stamped(run: Column) -> Column:
        kept = run if keep is None else F.filter(run, keep)
        return let(F.get(run, F.lit(0)), lambda head: F.transform(kept, lambda x: stamp(x, head)))

    return F.flatten(map_runs(items, opens, stamped))


def last_wins(pairs: Column) -> Column:
    """Collapse repeated labels of an `array<struct<label,value>>`.

    The last value of a label is kept, at the place of the label's first use.
    """

    def collapse(ps: Column) -> Column:
        indexed = F.array_sort(
            F.transform(
                ps,
                lambda p, i: F.struct(p["label"].alias("label"), i.alias("at"), p["value"].alias("value")),
            )
        )
        firsts = map_runs(
            indexed,
            lambda p, i, all_: ~p["label"].eqNullSafe(F.get(all_, i - 1)["label"]),
            lambda run: F.struct(
                F.get(run, F.lit(0))["at"].alias("at"),
                F.get(run, F.lit(0))["label"].alias("label"),
                F.element_at(run, -1)["value"].alias("value"),
            ),
        )
        return F.transform(
            F.array_sort(firsts),
            lambda p: F.struct(p["label"].alias("label"), p["value"].alias("value")),
        )

    def choose(ps: Column) -> Column:
        labels = F.transform(ps, lambda p: p["label"])
        return F.when(F.size(F.array_distinct(labels)) == F.size(ps), ps).otherwise(collapse(ps))

    return let(pairs, choose)
