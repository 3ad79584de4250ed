"""Finding items: by a code of their own or of their product, and by a text in several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import top_rows


def code_lookup(items: DataFrame, alias: DataFrame, images: DataFrame, system: str, value: str) -> DataFrame:
    """(item, product, own_code, url, found_by): items that have the code themselves, and all items of a product that has it, each once.

    items: item, product. alias: kind (ITEM or PRODUCT), target, system, value, is_primary. images: item, url, is_primary, sort_order. An item found
    both ways is found by its own code. own_code is its alias in the system: the one asked for, else a primary one, else the least; url its best image.
    Only the aliases of the code meet the items, so both joins are small."""
    hits = alias.where((F.col("system") == system) & (F.col("value") == value))
    own = hits.where("kind = 'ITEM'").select(F.col("target").alias("item"), F.lit("item").alias("found_by"))
    products = hits.where("kind = 'PRODUCT'").select(F.col("target").alias("product")).distinct()
    shared = items.join(products, "product", "left_semi").select("item", F.lit("product").alias("found_by"))
    found = own.union(shared).groupBy("item").agg(F.min("found_by").alias("found_by"))
    codes = alias.where((F.col("kind") == "ITEM") & (F.col("system") == system)).select(F.col("target").alias("item"), "value", "is_primary").join(found, "item", "left_semi")
    best = top_rows(codes, ["item"], [(F.col("value") == value).desc(), F.col("is_primary").desc_nulls_last(), F.col("value")]).select("item", F.col("value").alias("own_code"))
    picture = top_rows(images.join(found, "item", "left_semi"), ["item"], [F.col("is_primary").desc_nulls_last(), F.col("sort_order").asc_nulls_last(), F.col("url")]).select("item", "url")
    return items.join(found, "item").join(best, "item", "left").join(picture, "item", "left").select("item", "product", "own_code", "url", "found_by")


def text_search(text: str, sources: list[tuple[str, DataFrame, str, list[str]]], kinds: set[str] | None = None) -> DataFrame:
    """(kind, id, matched): rows of each source with the text in any of its columns (case ignored, % and _ are wildcards), each once.

    sources: (kind, rows, id column, columns). matched is the first column that has the text. kinds leaves sources out before they are read."""
    out = None
    for kind, rows, key, columns in sources:
        if kinds is not None and kind not in kinds:
            continue
        hit = F.coalesce(*(F.when(F.col(c).cast("string").ilike(f"%{text}%"), F.col(c).cast("string")) for c in columns))
        found = rows.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), hit.alias("matched")).where("matched is not null").distinct()
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no source is left to search")
    return out
