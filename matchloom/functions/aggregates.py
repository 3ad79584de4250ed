"""Aggregates with a condition, and their null rules. An empty set is null, not an empty array or text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_when(p: Column) -> Column:
    return F.count(F.when(p, 1))


def distinct_when(p: Column, x: Column) -> Column:
    """Distinct values under a condition. Any number of these share one pass: sets are built, rows aren't multiplied. For values of a bounded number per group."""
    return F.size(F.collect_set(F.when(p, x))).cast("long")


def pairs(*columns: Column) -> Column:
    """Distinct tuples, those with nulls counted too."""
    return F.count_distinct(F.struct(*columns))


def array_when(p: Column, x: Column) -> Column:
    """Sorted distinct values; null if there are none."""
    out = F.array_sort(F.collect_set(F.when(p, x)))
    return F.when(F.size(out) > 0, out)


def text_when(p: Column, x: Column, sep: str = ", ") -> Column:
    """Sorted distinct values as one text; null if there are none."""
    return F.array_join(array_when(p, x), sep)


def single(x: Column) -> Column:
    """The value, if all rows have the same one; null otherwise."""
    return F.when(F.min(x) == F.max(x), F.min(x))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Null if the whole is 0."""
    return F.round(part.cast("decimal(20,4)") * 100 / F.nullif(whole.cast("decimal(20,4)"), F.lit(0).cast("decimal(20,4)")), digits).cast("double")


def ordered_array(x: Column, *order: Column) -> Column:
    """All values of a group as an array by the order, nulls kept; null order keys come last. For groups of a bounded size."""
    keys = [k for i, c in enumerate(order) for k in (c.isNull().alias(f"n{i}"), c.alias(f"k{i}"))]
    return F.transform(F.array_sort(F.collect_list(F.struct(*keys, x.alias("x")))), lambda s: s.x)
