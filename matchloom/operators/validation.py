"""Evidence rows against the catalog: option texts brought to one form, flags that block a row, a confidence tier; the effect of an option dictionary."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.text import blank_to_null, compact, nonblank

from .codes import resolve_alias
from .options import dictionary_term, joined_reasons

# How option texts write the same thing, applied in this order to lower-case text. Brackets go, what stands in them stays.
OPTION_STEPS = [
    (r"rose\s*gold|핑크골드|로즈골드|핑골|(^|[^\p{L}\p{N}])rg([^\p{L}\p{N}]|$)", "rosegold"),
    (r"yellow\s*gold|옐로우골드|골드|(^|[^\p{L}\p{N}])yg([^\p{L}\p{N}]|$)", "yellowgold"),
    (r"원타입|단일옵션|one\s*type", "onetype"),
    (r"([0-9]+)mm바", "$1mm"),
    (r"주문제작", ""),
    (r"[^\p{L}\p{N}]+", ""),
    (r"14k|써지컬|925실버|실버925", ""),
]
# Texts that say that a difference is one of wording, by the side that is looked at.
ABSORBED = {
    "rose_gold": (r"핑골|핑크골드|로즈골드|rose gold|(^|[^\p{L}\p{N}])rg([^\p{L}\p{N}]|$)", "row"),
    "yellow_gold": (r"골드|yellow gold|(^|[^\p{L}\p{N}])yg([^\p{L}\p{N}]|$)", "row"),
    "made_to_order": (r"주문제작", "both"),
    "one_type": (r"원타입|단일옵션|one type", "both"),
    "mm_bar": (r"[0-9]+mm바", "both"),
}
# Two words that must not meet in a row's texts, words for several pieces, signs of a bad parse.
CRYSTAL, WHITE_GOLD = ("크리스탈AB", "크리스탈"), ("화이트골드", "실버")
PIECES, PIECES_PATTERN = ("세트", "한쌍", "낱개"), r"[0-9]+\s*(개|pcs|ea|set)"
BRACKET_SIGNS, LINE_SIGNS = ("bracket", "대괄호"), ("multiline", "줄 수", "alignment")
PARSED = ("", "parsed", "ok", "clean")
# The narrow risks of a text, and colour words that are reported but bar nothing.
NARROW = {"crystal_ab": "크리스탈AB|크리AB", "standalone_ab": "(^|[^A-Za-z0-9가-힣])AB([^A-Za-z0-9가-힣]|$)", "set_or_quantity": "세트|SET|set|Set|수량", "one_plus_one": r"1\+1"}
BROAD_COLOUR = "실버|골드|핑크골드|로즈골드|옐로우골드|크리스탈"


def option_key(text: Column, steps: list[tuple[str, str]] = OPTION_STEPS) -> Column:
    """The text in one form; '' for null and for texts of which nothing is left."""
    return reduce(lambda c, step: F.regexp_replace(c, *step), steps, F.lower(F.coalesce(text, F.lit(""))))


def _sure(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def _any(texts: list[Column], test: Callable[[Column], Column]) -> Column:
    return reduce(lambda a, b: a | b, (_sure(test(c)) for c in texts))


def _has(*words: str) -> Callable[[Column], Column]:
    return lambda c: _any([c], lambda x: reduce(lambda a, b: a | b, (F.contains(x, F.lit(w)) for w in words)))


def _like(*words: str) -> Callable[[Column], Column]:
    return lambda c: _any([c], lambda x: reduce(lambda a, b: a | b, (x.ilike(f"%{w}%") for w in words)))


def evidence_validation(rows: DataFrame, alias: DataFrame, own_alias: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per evidence row: row, item, blocked, name_support, option_match, absorbed, parser_warning, tier.

    rows: row, item_code, own_code, product_no, raw_option, plain_option, name, warning, status (texts). alias and own_alias: value, target.
    catalog: target (unique), item_name, item_option, product_nos (array of text; what channels have on record for the item).
    blocked lists the flags that hold: any of them makes the tier blocked_risk; then parse_warning, high, medium, parse_good, manual in this order.
    A code with several targets resolves to none and blocks. Nulls and blanks are absent values and never block by themselves.
    Both fan-outs are counted on the rows alone and joined back by key, so a row meets no other row."""
    rows = rows.select("row", "item_code", "own_code", "product_no", "raw_option", "plain_option", "name", "warning", "status")
    catalog = catalog.select(F.col("target").alias("item"), "item_name", "item_option", "product_nos")
    code, number = blank_to_null(F.col("item_code")), blank_to_null(F.col("product_no"))
    rows = rows.withColumns({"_code": code, "_number": number, "row_key": option_key(F.coalesce("plain_option", "raw_option"))}).withColumn("_key", F.nullif("row_key", F.lit("")))
    by_code = rows.where("_code is not null").groupBy("_code").agg(F.count_distinct("_number").alias("n_numbers"))
    by_option = rows.where("_number is not null and _key is not null").groupBy("_number", "_key").agg(F.count_distinct("_code").alias("n_codes"))
    held = resolve_alias(rows, alias, "item_code").withColumnsRenamed({"match_count": "n_items", "resolved": "item"}).drop("candidates")
    held = resolve_alias(held, own_alias, "own_code").withColumnsRenamed({"match_count": "n_own", "resolved": "own_item"}).drop("candidates")
    held = held.join(catalog.withColumn("item_key", option_key(F.col("item_option"))), "item", "left")
    held = held.join(by_code, "_code", "left").join(by_option, ["_number", "_key"], "left").fillna(0, ["n_numbers", "n_codes"])

    raw, plain, db = (F.col(c) for c in ("raw_option", "plain_option", "item_option"))
    texts, warning = [raw, plain, db], F.coalesce("warning", F.lit(""))
    both = lambda pair: _any(texts, _has(pair[0])) & _any(texts, _has(pair[1]))
    apart = r"(?i)(^|[^\p{L}\p{N}])AB([^\p{L}\p{N}]|$)"
    name, item_name = (F.coalesce(compact(F.col(c)), F.lit("")) for c in ("name", "item_name"))
    flags = {
        "crystal": both(CRYSTAL),
        "ab_token": _like("ab")(warning) | _any([raw, plain], lambda c: c.rlike(apart)) | _any([raw], lambda c: c.rlike(r"(?i)[\p{L}\p{N}]AB[\p{L}\p{N}]")),
        "white_gold": both(WHITE_GOLD),
        "quantity": _any([raw, plain], _has(*PIECES)) | _any([raw], lambda c: c.rlike(PIECES_PATTERN)),
        "bracket": _like(*BRACKET_SIGNS)(warning) | (_has("[")(raw) & ~_has("]")(raw)),
        "line_alignment": _like(*LINE_SIGNS)(warning),
        "duplicate_item": (F.col("n_items") > 1) | (F.col("n_numbers") > 1),
        "duplicate_option": F.col("n_codes") > 1,
        "own_code": (F.col("n_own") > 1) | _sure(F.col("own_item") != F.col("item")),
        "product_no": _sure(F.exists("product_nos", lambda x: x != F.col("_number"))),
        "name": (name != "") & (item_name != "") & (name != item_name),
    }
    row_text, item_text = F.lower(F.coalesce("plain_option", "raw_option", F.lit(""))), F.lower(F.coalesce("item_option", F.lit("")))
    pattern = lambda sides: "|".join(p for p, side in ABSORBED.values() if side in sides)
    worded = row_text.rlike(pattern(("row", "both"))) | item_text.rlike(pattern(("both",)))
    held = held.withColumns({
        "blocked": joined_reasons(flags), "name_support": (name != "") & (name == item_name), "option_match": (F.col("row_key") != "") & _sure(F.col("row_key") == F.col("item_key")),
        "absorbed": _sure(F.col("row_key") == F.col("item_key")) & (row_text != item_text), "parser_warning": (warning != "") | ~F.lower(F.coalesce("status", F.lit(""))).isin(*PARSED),
        "_told": F.col("_number").isNotNull() & nonblank(F.coalesce("raw_option", "plain_option")), "_worded": worded,
    })
    known, one = F.col("_told") & F.col("item").isNotNull(), (F.col("n_items") == 1) & (F.col("n_own") <= 1) & (F.col("n_numbers") == 1) & (F.col("n_codes") == 1)
    tier = (
        F.when(F.col("blocked") != "", "blocked_risk")
        .when(F.col("parser_warning"), "parse_warning")
        .when(known & F.col("option_match") & one, "high")
        .when(known & (F.col("option_match") | F.col("absorbed") | F.col("_worded")), "medium")
        .when(F.col("_told") & F.col("_code").isNotNull(), "parse_good")
        .otherwise("manual")
    )
    return held.select("row", "item", "blocked", "name_support", "option_match", "absorbed", "parser_warning", tier.alias("tier"))


def narrow_risk(rows: DataFrame, product: str, text: str) -> DataFrame:
    """Adds narrow (flags that hold, comma-joined), broad_colour and clean (no narrow flag).

    variant_conflict: the product has rows with the ab variant and rows with the plain word alone. A row without product has no such conflict; a
    null text has no flags."""
    ab, word = F.col(text).rlike(NARROW["crystal_ab"]), F.contains(F.col(text), F.lit(CRYSTAL[1]))
    mixed = rows.where(F.col(product).isNotNull()).groupBy(product).agg((F.bool_or(_sure(ab)) & F.bool_or(_sure(word & ~ab))).alias("_mixed"))
    out = rows.join(mixed, product, "left")
    flags = {k: _sure(F.col(text).rlike(p)) for k, p in NARROW.items()} | {"variant_conflict": _sure(F.col("_mixed"))}
    out = out.withColumn("narrow", joined_reasons(flags)).withColumn("broad_colour", _sure(F.col(text).rlike(BROAD_COLOUR)))
    return out.withColumn("clean", F.col("narrow") == "").drop("_mixed")


def option_impact(rows: DataFrame, terms: list[tuple[str, str, str]], pinned: str | None = None, mixed: tuple[str, str, str] | None = None) -> DataFrame:
    """What a dictionary of option terms changes: rule, before, after, candidate, ambiguous, manual beside the columns of rows.

    rows: channel, item, product_code, option_code, own_code, option, channel_option. Texts without a term stand for themselves.
    before: equal as letters and digits; after: the same term, or equal without one. candidate: matches only now, by a rule. ambiguous: matches,
    but its term leads to several items or option codes of the product, or the texts mix a variant with its plain term.
    mixed: (pattern of the variant, term of the plain word, token that alone says too little). manual: no match, or a code is missing."""
    sides = {"a": F.coalesce("option", F.lit("")), "b": F.coalesce("channel_option", F.lit(""))}
    out = rows
    for k, c in sides.items():
        hit = dictionary_term(c, terms, pinned).getField("term")
        out = out.withColumns({f"_flat_{k}": compact(c), f"_term_{k}": hit, f"_norm_{k}": F.coalesce(hit, F.nullif(compact(c), F.lit("")))})
    out = out.withColumns({"rule": F.coalesce("_term_a", "_term_b", F.lit("raw_text")), "before": (F.col("_flat_a") != "") & (F.col("_flat_a") == F.col("_flat_b")), "after": _sure(F.col("_norm_a") == F.col("_norm_b"))})
    unsafe = F.lit(False)
    if mixed:
        pattern, plain, token = mixed
        variant = {k: F.col(f"_flat_{k}").rlike(pattern) for k in sides}
        alone = _any(list(sides.values()), lambda c: F.array_contains(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " "), token))
        unsafe = (variant["a"] & _sure(F.col("_term_b") == plain)) | (variant["b"] & _sure(F.col("_term_a") == plain)) | (alone & ~variant["a"] & ~variant["b"])
    key = ["channel", "product_code", "_norm_b"]
    fans = out.where(F.col("after") & F.col("product_code").isNotNull()).groupBy(*key).agg(F.count_distinct("item").alias("_items"), F.count_distinct("option_code").alias("_options"))
    out = out.join(fans, key, "left")
    many = _sure(F.col("_items") > 1) | _sure(F.col("_options") > 1)
    missing = F.col("product_code").isNull() | F.col("option_code").isNull() | F.col("own_code").isNull()
    out = out.withColumns({"candidate": ~F.col("before") & F.col("after") & (F.col("rule") != "raw_text"), "ambiguous": F.col("after") & (many | unsafe), "manual": ~F.col("after") | missing})
    return out.select(*rows.columns, "rule", "before", "after", "candidate", "ambiguous", "manual")
