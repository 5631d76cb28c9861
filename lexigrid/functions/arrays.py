"""Array helpers that work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once.

    A column that a lambda mentions is computed anew for every element when the
    optimizer merges the projections around it. A lambda variable never is.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_equal(items: Column) -> Column:
    """Distinct items of an array in order, each as (item, n).

    Sorts once and measures the runs of equal items, so the work does not grow
    with the number of distinct ones as a search per item would.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(ordered, lambda item, i: i),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

        def run(begins: Column) -> Column:
            def one(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(begins, k + 1), F.size(ordered))
                return F.struct(F.get(ordered, start).alias("item"), (end - start).cast("long").alias("n"))

            return F.transform(begins, one)

        return bind(starts, run)

    return bind(F.sort_array(items), runs)


def run_slices(ordered: Column, field: str) -> Column:
    """An array of structs, in order of a field, as one array for each value of it; one pass."""

    def key(i: Column) -> Column:
        return F.get(ordered, i)[field]

    starts = F.filter(F.transform(ordered, lambda x, i: i), lambda i: (i == 0) | (key(i) != key(i - 1)))

    def sliced(begins: Column) -> Column:
        return F.transform(
            begins, lambda start, k: F.slice(ordered, start + 1, F.coalesce(F.get(begins, k + 1), F.size(ordered)) - start)
        )

    return bind(starts, sliced)
