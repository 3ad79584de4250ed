"""Export checks: named rules with grades, and the state that they give a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The codes of export checks. Those that only warn are listed apart; every other one blocks.
# One more blocking code, that of an item without a code in the main catalog, is named after a vendor; the caller names it, see export_check.
BLOCKERS = """MISSING_INTERNAL_SKU MISSING_OWN_SKU_CODE MISSING_CHANNEL_PRODUCT_CODE MISSING_CHANNEL_OPTION_CODE CANDIDATE_CODE_NOT_ALLOWED
AUTO_INFERRED_CODE_NOT_ALLOWED AMBIGUOUS_MAPPING MISSING_REQUIRED_PRICE INVALID_PRICE MISSING_STOCK INVALID_STOCK OPTION_COUNT_MISMATCH OPTION_PARSE_FAILED
PRODUCT_OPTION_ROW_MISMATCH MISSING_REQUIRED_IMAGE INVALID_IMAGE_REFERENCE MISSING_DELIVERY_POLICY MISSING_COURIER_CODE MISSING_RETURN_SHIPPING_FEE
MISSING_REMOTE_AREA_FEE INVALID_SOLDOUT_STATUS INVALID_DISPLAY_STATUS UNSUPPORTED_TEMPLATE_VERSION TEMPLATE_HEADER_MISMATCH SUB_CHANNEL_POLICY_MISSING""".split()
WARNINGS = "PRICE_PRIORITY_UNCONFIRMED STOCK_POLICY_UNCONFIRMED TEMPLATE_GUIDE_ROW_POLICY_UNCONFIRMED".split()


def bad_number(text: Column, least: float, most: float, above: bool = False) -> Column:
    """True for a text that is no number of the range; null and blank are not judged here, they are missing."""
    n = F.trim(text).try_cast("double")
    low = n <= least if above else n < least
    return F.coalesce((F.trim(text) != "") & (n.isNull() | low | (n > most) | F.isnan(n)), F.lit(False))


def bad_reference(text: Column) -> Column:
    """True for a text that is neither a web address nor a picture's file name; null and blank are missing, not bad."""
    good = text.rlike(r"^https?://[^\s/]+(/\S*)?$") | text.rlike(r"(?i)^[^\s/\\]+\.(jpe?g|png|gif|webp)$")
    return F.coalesce((F.trim(text) != "") & ~good, F.lit(False))


def export_check(rows: DataFrame, rules: dict[str, Column], main_code: str | None = None) -> DataFrame:
    """Adds blockers and warnings (codes whose rule holds, comma-joined in the order of the rules) and state: blocked, warning or ready. Null rules don't hold.

    main_code: the caller's name of the code for an item that the main catalog lacks; it blocks. A code outside the lists raises ValueError."""
    blockers = [*BLOCKERS, main_code] if main_code else BLOCKERS
    if unknown := [k for k in rules if k not in blockers and k not in WARNINGS]:
        raise ValueError(f"unknown codes: {unknown}")

    def codes(names: list[str]) -> Column:
        hits = [F.when(p, F.lit(k)) for k, p in rules.items() if k in names]
        return F.concat_ws(",", *hits) if hits else F.lit("")

    out = rows.withColumns({"blockers": codes(blockers), "warnings": codes(WARNINGS)})
    return out.withColumn("state", F.when(F.col("blockers") != "", "blocked").when(F.col("warnings") != "", "warning").otherwise("ready"))
