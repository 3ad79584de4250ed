"""The review queue: items by channels, and what keeps each of them from being settled there."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import top_rows

CODES = ("product_code", "option_code", "product_candidate", "option_candidate")


@dataclass(frozen=True)
class QueuePolicy:
    """A channel's rules. needed: codes that must all be there; unsettled: codes that keep a row in the queue while they are there.

    missing: the row is called missing if all (or any) of these codes are absent. fallback: what a queued row that lacks nothing is called."""

    needed: tuple[str, ...] = ("product_code", "option_code")
    unsettled: tuple[str, ...] = ()
    missing: tuple[str, ...] = ("product_code", "option_code")
    missing_if: str = "any"
    fallback: str = "review_required"


def _all(tests: list[Column], whole: bool) -> Column:
    out = F.lit(whole)
    for p in tests:
        out = out & p if whole else out | p
    return out


def review_queue(items: DataFrame, mapping: DataFrame, policies: dict[str, QueuePolicy]) -> DataFrame:
    """(channel, item, reason, own_code and the codes, image_missing, own_code_missing): rows that a person must see.

    items: item (unique), own_code, n_images. mapping: channel, item, is_primary, own_code and CODES; a channel's primary row for an item wins, then the
    least codes. A null or empty own code is missing, a mapping's comes before the item's. Reasons in order: image, own code, channel codes, the
    policy's fallback. The channels are exploded from a literal, so each item is copied once for each channel and nothing is cross-joined."""
    order = [F.col("is_primary").desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in (*CODES, "own_code"))]
    held = top_rows(mapping.where(F.col("channel").isin(*policies)), ["channel", "item"], order).select("channel", "item", F.col("own_code").alias("_own"), *CODES)
    each = items.select("item", "own_code", "n_images", F.explode(F.array(*(F.lit(c) for c in policies))).alias("channel")).join(held, ["channel", "item"], "left")
    own = F.coalesce("_own", "own_code")
    each = each.withColumns({"own_code": own, "image_missing": F.coalesce("n_images", F.lit(0)) == 0, "own_code_missing": F.coalesce(own, F.lit("")) == ""})
    queued, reason = F.lit(False), F.when(F.col("image_missing"), "image_missing").when(F.col("own_code_missing"), "own_code_missing")
    for name, p in policies.items():
        here = F.col("channel") == name
        queued = queued | (here & (_all([F.col(c).isNull() for c in p.needed], False) | _all([F.col(c).isNotNull() for c in p.unsettled], False)))
        reason = reason.when(here & _all([F.col(c).isNull() for c in p.missing], p.missing_if == "all"), "channel_code_missing").when(here, p.fallback)
    return each.where(queued | F.col("image_missing") | F.col("own_code_missing")).select("channel", "item", reason.alias("reason"), "own_code", *CODES, "image_missing", "own_code_missing")
