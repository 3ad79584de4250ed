"""Stock comparison: change buckets and the latest snapshot over a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.text import number

from .relational import top_rows


def stock_bucket(current: Column, proposed: Column, units: int = 20, share: float = 0.5) -> Column:
    """Texts as they were typed; blank counts as 0. A fall is large from `units` on, or from `share` of the current stock on where that is above 0; only a
    stock above 0 can be zeroed out."""
    a, b = number(current), number(proposed)
    fall = a - b
    return (
        F.when(a.isNull() | b.isNull(), "RECHECK_REQUIRED")
        .when(fall == 0, "NO_CHANGE")
        .when((b == 0) & (a > 0), "ZERO_OUT")
        .when(fall < 0, "INCREASE")
        .when((fall >= units) | ((a > 0) & (fall >= a * share)), "LARGE_DECREASE")
        .otherwise("SMALL_DECREASE")
    )


def changed(current: Column, proposed: Column) -> Column:
    """Compared as numbers if both are, as texts otherwise."""
    a, b = number(current), number(proposed)
    return F.when(a.isNotNull() & b.isNotNull(), a != b).otherwise(~F.trim(current).eqNullSafe(F.trim(proposed)))


def latest_overlay(rows: DataFrame, snapshot: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """Adds stock (the first value that isn't null) and duplicates of the snapshot's last row for each key; earlier rows count as duplicates."""
    counts = snapshot.groupBy(key).agg((F.count("*") - 1).alias("duplicates"))
    last = top_rows(snapshot, [key], [F.col(order).desc_nulls_last(), *(F.col(v).desc_nulls_last() for v in values)]).select(key, F.coalesce(*values).alias("stock"))
    return rows.join(last.join(counts, key), key, "left")
