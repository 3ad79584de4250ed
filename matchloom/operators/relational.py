"""Relational shapes that plain DataFrame methods lack: keyed top rows, metric tables, dimension counts, parity and conflicts."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each key. Spark drops the rest before the shuffle, so a hot key costs n rows per task."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def metric_rows(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, value): any number of aggregates of one relation in one pass."""
    one = df.agg(*(c.cast("long").alias(k) for k, c in metrics.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in metrics))).alias("m")).select("m.*")


def dimension_counts(df: DataFrame, dimensions: list[str], blank: str = "(blank)") -> DataFrame:
    """(dimension, value, row_count) for the total and each dimension, as grouping sets in one pass; nulls are shown as blank."""
    shown = df.select(*(F.coalesce(F.col(d).cast("string"), F.lit(blank)).alias(d) for d in dimensions))
    sets = shown.groupingSets([[], *([F.col(d)] for d in dimensions)], *(F.col(d) for d in dimensions)).agg(F.count("*").alias("row_count"), *(F.grouping(d).alias(f"_off_{i}") for i, d in enumerate(dimensions)))
    name, value = F.lit("total"), F.lit("all")
    for i, d in enumerate(dimensions):
        on = F.col(f"_off_{i}") == 0
        name, value = F.when(on, d).otherwise(name), F.when(on, F.col(d)).otherwise(value)
    return sets.select(name.alias("dimension"), value.alias("value"), "row_count")


def parity(left: DataFrame, right: DataFrame, by: list[str], value: str) -> DataFrame:
    """Full outer comparison with null-safe keys: by, left_value, right_value, state (same, differs, left_only, right_only)."""
    a = left.select(*(F.col(k).alias(f"l_{k}") for k in by), F.col(value).alias("left_value"), F.lit(True).alias("in_left"))
    b = right.select(*(F.col(k).alias(f"r_{k}") for k in by), F.col(value).alias("right_value"), F.lit(True).alias("in_right"))
    on = None
    for k in by:
        same = F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}"))
        on = same if on is None else on & same
    state = F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only").when(F.col("left_value").eqNullSafe(F.col("right_value")), "same").otherwise("differs")
    return a.join(b, on, "full").select(*(F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in by), "left_value", "right_value", state.alias("state"))


def source_conflicts(df: DataFrame, item: str, code: str, source: str) -> DataFrame:
    """Rows whose item has another code from another source, or whose code has another item from another source.

    No row meets another: of a key's n pairs of partner and source, those that differ in both are n - (same partner) - (same source) + 1."""
    rows = df.select(item, code, source).distinct()

    def others(by: str, other: str, name: str) -> DataFrame:
        n = rows.groupBy(by).agg(F.count("*").alias("n"))
        same, own = rows.groupBy(by, other).agg(F.count("*").alias("same")), rows.groupBy(by, source).agg(F.count("*").alias("own"))
        return rows.join(n, by).join(same, [by, other]).join(own, [by, source]).select(item, code, source, (F.col("n") - F.col("same") - F.col("own") + 1 > 0).alias(name))

    out = others(item, code, "code_conflict").join(others(code, item, "item_conflict"), [item, code, source])
    return out.where("code_conflict or item_conflict").select(item, code, source, "code_conflict", "item_conflict")


def forward_fill(df: DataFrame, by: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Blank cells take the last value above them, within the key (a file, a sheet)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.nullif(F.trim(c), F.lit("")), ignorenulls=True).over(w) for c in columns})


def page(df: DataFrame, order: list[Column], limit: int | None = None, offset: int | None = None, most: int = 200, default: int = 50) -> DataFrame:
    """A page: the limit is clamped to 1..most, the offset to 0 or more."""
    n = min(max(int(limit), 1), most) if limit is not None else default
    return df.orderBy(*order).offset(max(int(offset or 0), 0)).limit(n)


def search(df: DataFrame, text: str | None, columns: list[str], filters: dict[str, object] | None = None) -> DataFrame:
    """All filters that are given, and the text in any of the columns (case ignored; % and _ in it are wildcards)."""
    for c, v in (filters or {}).items():
        if v is not None:
            df = df.where(F.col(c) == F.lit(v))
    if text:
        hit = F.lit(False)
        for c in columns:
            hit = hit | F.coalesce(F.col(c).cast("string"), F.lit("")).ilike(f"%{text}%")
        df = df.where(hit)
    return df


def stratified_sample(df: DataFrame, buckets: dict[str, Column], id_col: str, code: str, n: int = 20, random: str = "random", wide: int = 32) -> DataFrame:
    """(bucket, bucket_size, sample_rank, row): up to n rows of each of several overlapping buckets.

    The random bucket goes by md5 of id and bucket, the others by the code, filled up with zeros on the left to `wide` characters, and then the id, as texts."""
    hits = F.filter(F.array(*(F.when(p, F.lit(k)) for k, p in buckets.items())), lambda x: x.isNotNull())
    rows = df.withColumn("bucket", F.explode(hits))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("bucket_size"))
    key = F.col(id_col).cast("string")
    order = F.when(F.col("bucket") == random, F.md5(F.concat(key, F.col("bucket")))).otherwise(F.concat(F.lpad(F.coalesce(F.col(code).cast("string"), F.lit("")), wide, "0"), key))
    return top_rows(rows, ["bucket"], [order, F.col(id_col)], n, "sample_rank").join(F.broadcast(sizes), "bucket")


def related_rows(df: DataFrame, row: str, keys: list[str], most: int | None = 80) -> DataFrame:
    """(row, other): other rows that share any of the keys with a row, each once, the first `most` by id; None gives all. Blank and null keys relate nothing.

    One equi-join for each key. The cut is the feature: for each row a list of a readable length. It is filled from the first most + 1 ids of its keys, which are one sorted list for each
    key's value; a row's lists are merged before they become rows, so that pairs are neither shuffled nor sorted. Without a cut all pairs are made."""
    found = None
    for k in keys:
        value = F.nullif(F.trim(F.col(k).cast("string")), F.lit(""))
        own = df.select(F.col(row).alias("row"), value.alias("_k")).where("_k is not null and row is not null")
        if most is None:
            each = own.join(own.withColumnRenamed("row", "other"), "_k").where("row != other").select("row", "other")
        else:
            place = F.dense_rank().over(Window.partitionBy("_k").orderBy("row"))
            firsts = own.withColumn("_n", place).where(F.col("_n") <= most + 1).groupBy("_k").agg(F.sort_array(F.collect_set("row")).alias("_others"))
            each = own.join(firsts, "_k").select("row", "_others")
        found = each if found is None else found.union(each)
    if most is None:
        return found.distinct()
    lists = found.groupBy("row").agg(F.flatten(F.collect_list("_others")).alias("_others"))
    merged = F.array_sort(F.array_remove(F.array_distinct("_others"), F.col("row")))
    return lists.select("row", F.explode(F.slice(merged, 1, most)).alias("other"))


def ranked_matches(rows: DataFrame, row: str, others: DataFrame, keys: dict[str, int | None], order: list[Column], values: list[str]) -> DataFrame:
    """For each row the best other row that shares any key: keys with a rank come first, lower ones before, keys without one count alike; then the order.

    The others are first cut to the best one for each value of a key, and for each set of values of several keys with a rank, as matching all of them goes before matching
    some. A row then meets one of them for each such set by an equi-join, so no work grows with the number of others that share a key. With r such keys these are
    2 ** r - 1 joins, and one for each other key. Rows without a match have nulls; null keys match nothing."""
    ranked = [k for k, _ in sorted(((k, r) for k, r in keys.items() if r is not None), key=lambda x: x[1])]
    sets = [list(s) for n in range(len(ranked), 0, -1) for s in combinations(ranked, n)] + [[k] for k, rank in keys.items() if rank is None]
    found = None
    for s in sets:
        known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in s))
        a = rows.where(known).select(F.col(row), *(F.col(k).alias(f"_r_{k}") for k in s))
        b = top_rows(others.where(known), s, order).select(*(c for c in others.columns if c not in keys), *(F.col(k).alias(f"_o_{k}") for k in s))
        on = reduce(lambda x, y: x & y, (F.col(f"_r_{k}") == F.col(f"_o_{k}") for k in s))
        each = a.join(b, on).drop(*(f"_{side}_{k}" for side in "ro" for k in s)).select("*", *(F.lit(int(k in s)).alias(f"_hit_{k}") for k in ranked))
        found = each if found is None else found.unionByName(each)
    best = top_rows(found, [row], [*(F.col(f"_hit_{k}").desc() for k in ranked), *order]).select(row, *values)
    return rows.select(row).join(best, row, "left")


def most_common(df: DataFrame, value: str, n: int = 20) -> DataFrame:
    """(value, row_count, place): the n most frequent values; of equal counts the lesser value first. Nulls are a value."""
    counts = df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("row_count")).orderBy(F.col("row_count").desc(), F.col("value").asc_nulls_first()).limit(n)
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("row_count").desc(), F.col("value").asc_nulls_first())).cast("long"))


def merged_lists(lists: list[str], key) -> Column:
    """One list of several columns of structs, in their order, of equal keys the first. key: struct column -> text; null lists and null elements are left out."""
    return distinct_by(F.array_compact(F.concat(*(F.coalesce(F.col(c), F.array().cast("array<void>")) for c in lists))), key)


def distinct_by(whole: Column, key) -> Column:
    """The list without nulls and without elements whose key stands before them. Sorted by key and place, so a long list costs no more than a sort."""
    sorted_ = F.array_sort(F.transform(F.array_compact(whole), lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda r, j: (j == 0) | ~r.k.eqNullSafe(F.get(s, (j - 1).cast("int")).k))

    # bound as the one element of an array, so that it is sorted once
    kept = F.get(F.transform(F.array(sorted_), firsts), F.lit(0))
    return F.transform(F.array_sort(F.transform(kept, lambda r: F.struct(r.i.alias("i"), r.x.alias("x")))), lambda r: r.x)
