"""Weak candidates (one best item with a low score): the tests that make one strong, and how consistent its product's rows are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.aggregates import count_when

from .options import joined_reasons

# Words of names that say nothing about the item.
STOPWORDS = "925 14k silver 실버 써지컬 써지컬스틸 피어싱 귀걸이 목걸이 팔찌 반지 모음 종 무배 무료배송 기본".split()


def plain_text(c: Column) -> Column:
    """Lower case, bracketed parts dropped, everything but digits, Latin letters and Hangul as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\[[^\]]*\]", " "), "[^0-9a-z가-힣]+", " "))


def name_words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(plain_text(c), " "), lambda w: (F.length(w) >= 2) & ~w.isin(*STOPWORDS)))


def option_numbers(aliases: Column) -> Column:
    """The numbers after the last hyphen of each code of a list (separated by | , ; / or white space), without leading zeros."""
    found = F.transform(F.split(F.coalesce(aliases, F.lit("")), r"[|,;/\s]+"), lambda a: F.regexp_extract(a, "-0*([0-9]+)$", 1))
    return F.filter(found, lambda n: n != "")


def _int(c: Column, default: int) -> Column:
    return F.coalesce(F.when(F.trim(c).rlike(r"^[+-]?[0-9]+$"), F.trim(c).try_cast("int")), F.lit(default))


def weak_candidates(rows: DataFrame, least_score: int = 70, most_candidates: int = 3) -> DataFrame:
    """Adds primary_no, overlap (words both names have), failed (tests that don't hold, comma-joined), strong (none failed), n_group, group_ratio and
    group_consistent (two rows or more, 80 % with the option's number) of the product. The group is reported and decides nothing.

    rows: product, code, item, option_id, aliases, option, item_option, name, item_name, score, n_candidates, all texts; what is no whole number counts as
    a score of 0 and as too many candidates. A code must be there and stand once. Null products form a group of their own."""
    numbers = option_numbers(F.col("aliases"))
    own = F.when(F.coalesce("option_id", F.lit("")) != "", _int(F.col("option_id"), -1).cast("string"))
    a, b = (F.replace(plain_text(F.col(c)), F.lit(" "), F.lit("")) for c in ("option", "item_option"))
    out = rows.withColumns({"primary_no": F.get(numbers, F.lit(0)), "overlap": F.size(F.array_intersect(name_words(F.col("name")), name_words(F.col("item_name")))).cast("long"), "_a": a, "_b": b})
    out = out.withColumn("_same_no", F.coalesce(F.col("primary_no") == own, F.lit(False)))
    out = out.join(rows.groupBy("code").agg(F.count("*").alias("_n_code")), "code", "left")
    groups = out.groupBy(F.col("product").alias("_product")).agg(F.count("*").alias("n_group"), count_when(F.col("_same_no")).alias("_n_same"))
    out = out.join(groups, F.col("product").eqNullSafe(F.col("_product")), "left")
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    failed = {
        "score": _int(F.col("score"), 0) < least_score, "candidates": _int(F.col("n_candidates"), 999999) > most_candidates, "option_no": ~F.col("_same_no"),
        "option_text": (F.col("_a") == "") | (F.col("_b") == "") | ~(F.contains("_a", "_b") | F.contains("_b", "_a")), "code_blank": blank(F.col("code")), "item_blank": blank(F.col("item")), "code_not_single": blank(F.col("code")) | (F.col("_n_code") != 1),
    }
    ratio = F.round(F.col("_n_same") / F.col("n_group"), 4)
    out = out.withColumns({"failed": joined_reasons(failed), "group_ratio": ratio, "group_consistent": (F.col("n_group") >= 2) & (F.col("_n_same") >= 0.8 * F.col("n_group"))})
    return out.withColumn("strong", F.col("failed") == "").select(*rows.columns, "primary_no", "overlap", "failed", "strong", "n_group", "group_ratio", "group_consistent")


def weak_groups(rated: DataFrame) -> DataFrame:
    """Per product of weak_candidates' rows: n_group, n_strong, group_ratio, group_consistent, least and greatest option_id, and the first five names in order."""
    number = F.when(F.coalesce("option_id", F.lit("")) != "", _int(F.col("option_id"), 0))
    names = F.array_join(F.slice(F.array_sort(F.collect_set(F.nullif("name", F.lit("")))), 1, 5), " | ")
    return rated.groupBy("product").agg(F.max("n_group").alias("n_group"), count_when(F.col("strong")).alias("n_strong"), F.max("group_ratio").alias("group_ratio"), F.bool_or("group_consistent").alias("group_consistent"), F.min(number).cast("long").alias("least_option"), F.max(number).cast("long").alias("greatest_option"), names.alias("names"))
