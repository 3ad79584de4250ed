"""Evidence on items in channels: profiles, fan-out of shared codes, presence, promotion, unique evidence, aligned lines, support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.aggregates import count_when, percent
from matchloom.functions.text import nonblank

#: Orders of the presence rules, by name. The first that holds wins; rows where none does get the last word.
PRESENCE = {
    "candidate": (["confirmed", "blocked", "high", "medium", "absent", "unknown"], "manual"),
    "rate": (["confirmed", "blocked", "high", "absent", "medium", "unknown", "parse_warning"], "manual"),
    "without_manual": (["confirmed", "blocked", "high", "medium", "absent"], "unknown"),
}

# The statuses of a presence report; the first three count as matched, the last two as left to people.
MATCHED, OTHER, LEFT = ("confirmed", "high", "medium"), ("blocked", "absent"), ("manual", "unknown")


def _filled(c: str) -> Column:
    return F.when(nonblank(F.col(c).cast("string")), F.col(c))


def mapping_profile(rows: DataFrame, item: str, product: str, option: str, confirmed: Column) -> DataFrame:
    """Per item: rows, confirmed and candidate rows, distinct products and options, and the least of each as representatives, of confirmed and candidate rows alike. Blanks are none."""
    return rows.groupBy(item).agg(
        F.count("*").alias("n_rows"), count_when(confirmed).alias("n_confirmed"), count_when(~confirmed).alias("n_candidate"),
        F.count_distinct(_filled(product)).alias("n_products"), F.count_distinct(_filled(option)).alias("n_options"),
        F.min(_filled(product)).alias("product"), F.min(_filled(option)).alias("option"),
    )


def code_scope(items: DataFrame, code: str, item: str, product: str, family: str, channel_code: str) -> DataFrame:
    """How far each shared code fans out over items, products, families and the channel's codes, and for every item its codes and the widest of each. Blank codes and families are none."""
    each = items.where(nonblank(F.col(code).cast("string")))
    scope = each.groupBy(code).agg(F.count_distinct(item).alias("n_items"), F.count_distinct(product).alias("n_products"), F.count_distinct(_filled(family)).alias("n_families"), F.count_distinct(_filled(channel_code)).alias("n_channel_codes"))
    widest = (F.max(f"n_{k}").alias(f"max_{k}") for k in ("items", "products", "families", "channel_codes"))
    return each.select(item, code).distinct().join(scope, code).groupBy(item).agg(F.count("*").alias("n_codes"), *widest)


def presence_status(flags: dict[str, Column], rules: str = "candidate") -> Column:
    """The first flag that holds in the order of the rules; null flags don't hold."""
    order, last = PRESENCE[rules]
    out = None
    for k in order:
        if k in flags:
            p = F.coalesce(flags[k], F.lit(False))
            out = F.when(p, k) if out is None else out.when(p, k)
    return out.otherwise(last) if out is not None else F.lit(last)


PROMOTION_FLAGS = ("blocked", "duplicate", "one_target", "pair", "one_item", "split", "semantic", "quantity", "same_family", "same_product", "cross_product", "unique_code", "absorbable", "single_risk", "code", "absent")


def promotion(flags: dict[str, Column]) -> dict[str, Column]:
    """Columns tier (high, medium or not_candidate) and conflict of blocked rows whose own code repeats. flags: PROMOTION_FLAGS, null ones don't hold.

    high: the shared code has one target, a channel code and option are on record and lead to one item, the code isn't split over channel codes, no semantic
    or quantity risk, and the repeats stay within a product or family. medium: not high, not split, no semantic risk, not absent, and any of: a channel code
    of its own, a difference that wording absorbs, a quantity or single-piece risk, a channel code within the family. conflict: split, a code and
    option of several items, a semantic risk, repeats over products without a channel code of their own, or no channel code though not absent."""
    f = {k: F.coalesce(flags[k], F.lit(False)) for k in PROMOTION_FLAGS}
    scope = f["blocked"] & f["duplicate"]
    strong = f["one_target"] & f["pair"] & f["one_item"] & ~f["split"] & ~f["semantic"] & ~f["quantity"] & (f["same_family"] | f["same_product"])
    weak = f["unique_code"] | f["absorbable"] | f["quantity"] | f["single_risk"] | (f["code"] & f["same_family"])
    medium = scope & ~strong & ~f["split"] & ~f["semantic"] & ~f["absent"] & weak
    conflict = f["split"] | (f["pair"] & ~f["one_item"]) | f["semantic"] | (f["cross_product"] & ~f["unique_code"]) | (~f["code"] & ~f["absent"])
    return {"tier": F.when(scope & strong, "high").when(medium, "medium").otherwise("not_candidate"), "conflict": scope & conflict}


STRICT_FLAGS = ("blocked", "confirmed", "true_risk", "pair", "one_item", "one_own", "option_only", "product_only", "absorbable")


def strict_promotion(flags: dict[str, Column]) -> Column:
    """The strict split's tier: high, medium or residual for blocked, unconfirmed rows, null for the others. flags: STRICT_FLAGS.

    Any true risk (semantic, quantity or a duplicate of any kind) bars both. high: product and option on record, leading to one item, and own codes of one
    target each; medium: half of the pair on record, or a difference that wording absorbs."""
    f = {k: F.coalesce(flags[k], F.lit(False)) for k in STRICT_FLAGS}
    scope = f["blocked"] & ~f["confirmed"]
    strong = f["pair"] & f["one_item"] & f["one_own"]
    return F.when(~scope, None).when(f["true_risk"], "residual").when(strong, "high").when(f["option_only"] | f["product_only"] | f["absorbable"], "medium").otherwise("residual")


def unique_evidence(items: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per item: item, n_pairs, product, option, n_items, n_products, risk, verdict.

    items: item, shared (the code that stands for the item), code (an own code; several rows give several), risk (any true one counts). mapping: code, product, option.
    n_pairs counts the distinct (product, option) of all the item's codes, those with neither left out; only items with exactly one are candidates. On all candidates,
    risky ones too, n_items counts the items of the pair and n_products the products of the shared code; half a pair, without product or without option, is no address
    and counts 0, as does an item without a shared code or without a product. verdict, the first that holds: evidence_missing, duplicate_evidence, duplicate_pair,
    duplicate_product, half_pair (either count is 0), risk, clean (both are 1). Blank codes are none; nulls and repeated rows do nothing."""
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    each = items.groupBy("item").agg(F.min("shared").alias("shared"), F.coalesce(F.bool_or("risk"), F.lit(False)).alias("risk"))
    codes = items.select("item", blank("code").alias("code")).where("code is not null").distinct()
    held = mapping.select(blank("code").alias("code"), blank("product").alias("product"), blank("option").alias("option")).where("code is not null and (product is not null or option is not null)").distinct()
    pair = F.concat_ws("|", "product", "option")
    found = codes.join(held, "code").groupBy("item").agg(F.count_distinct(pair).alias("n_pairs"), F.min("product").alias("product"), F.min("option").alias("option"))
    rows = each.join(found, "item", "left").fillna(0, ["n_pairs"])
    sure = rows.where("n_pairs = 1")
    by_pair = sure.where("product is not null and option is not null").groupBy(F.col("product").alias("_p"), F.col("option").alias("_o")).agg(F.count_distinct("item").alias("_items"))
    by_code = sure.where("shared is not null").groupBy(F.col("shared").alias("_s")).agg(F.count_distinct("product").alias("_products"))
    one = F.col("n_pairs") == 1
    rows = rows.join(by_pair, one & (F.col("product") == F.col("_p")) & (F.col("option") == F.col("_o")), "left").join(by_code, one & (F.col("shared") == F.col("_s")), "left")
    rows = rows.withColumns({"n_items": F.when(one, F.coalesce("_items", F.lit(0))), "n_products": F.when(one, F.coalesce("_products", F.lit(0)))})
    verdict = F.when(F.col("n_pairs") == 0, "evidence_missing").when(F.col("n_pairs") > 1, "duplicate_evidence").when(F.col("n_items") > 1, "duplicate_pair").when(F.col("n_products") > 1, "duplicate_product").when((F.col("n_items") == 0) | (F.col("n_products") == 0), "half_pair").when(F.col("risk"), "risk").otherwise("clean")
    return rows.select("item", "n_pairs", *(F.when(one, F.col(c)).alias(c) for c in ("product", "option")), "n_items", "n_products", "risk", verdict.alias("verdict"))


def _lines(c: str) -> Column:
    """A cell's lines, one at least; any kind of line break separates, those at the end make no line.

    As no cell is without lines, they are exploded as outer: else Spark infers a filter on their number and works the arrays out again for it."""
    return F.split(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"(\r\n|\r|\n)+$", ""), r"\r\n|\r|\n", -1)


def _zipped(codes: str, options: str, statuses: str, shift: Column, fits: Column, known: Column) -> Column:
    """(code, option, status) of each code line, zipped before anything is exploded, so that no line carries its cell's other lines."""
    n = F.size(codes)
    moved = F.when(known, F.when(shift == 1, F.slice(options, 2, n)).otherwise(F.slice(options, 1, n)))
    empty = F.array().cast("array<string>")
    return F.arrays_zip(F.col(codes).alias("code"), F.coalesce(moved, empty).alias("option"), F.when(fits, F.col(statuses)).otherwise(empty).alias("status"))


def aligned_lines(rows: DataFrame, row: str, codes: str, options: str, statuses: str) -> DataFrame:
    """One row per code line: (row, line_no, code, option, status, alignment).

    n codes with n options are direct; with n + 1 options the first is a header and options shift by one; anything else needs review and has no
    option. Status lines count only if there are n. Any kind of line break separates; one at the end makes no line."""
    held = rows.select(row, _lines(codes).alias("c"), _lines(options).alias("o"), _lines(statuses).alias("s"))
    held = held.withColumn("alignment", F.when(F.size("o") == F.size("c"), "direct").when(F.size("o") == F.size("c") + 1, "header").otherwise("needs_review"))
    zipped = _zipped("c", "o", "s", F.when(F.col("alignment") == "header", 1).otherwise(0), F.size("s") == F.size("c"), F.col("alignment") != "needs_review")
    each = held.select(row, "alignment", zipped.alias("z")).select(row, "alignment", F.posexplode_outer("z").alias("pos", "x"))
    return each.select(row, (F.col("pos") + 1).cast("long").alias("line_no"), F.trim("x.code").alias("code"), F.trim("x.option").alias("option"), F.trim("x.status").alias("status"), "alignment")


def evidence_support(rows: DataFrame, second: DataFrame) -> DataFrame:
    """Adds support: a second source's product and option, by item, else by own code, against the row's own.

    rows: item, own, product, option, compares (whether the row's channel is the one whose codes the source speaks of). second: item, own, product,
    option. none: the source has nothing; incomplete: it has no product or no option, or several for the key; supported: both are the row's; conflict: one
    that the row has is another; relaxed: the rest, such as rows without codes of their own and channels that don't compare."""
    second = second.select("item", "own", F.nullif(F.trim("product"), F.lit("")).alias("product"), F.nullif(F.trim("option"), F.lit("")).alias("option"))

    def by(key: str) -> DataFrame:
        one = lambda c: F.when(F.count_distinct(c) == 1, F.min(c))
        return second.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k_{key}")).agg(F.struct(one("product").alias("p"), one("option").alias("o")).alias(f"_{key}"))

    out = rows.join(by("item"), F.col("item") == F.col("_k_item"), "left").join(by("own"), F.col("own") == F.col("_k_own"), "left")
    found = F.coalesce("_item", "_own")
    p, o, mine, choice = found.p, found.o, F.col("product"), F.col("option")
    compares = F.coalesce(F.col("compares"), F.lit(False))
    support = (
        F.when(found.isNull(), "none").when(p.isNull() | o.isNull(), "incomplete").when(compares & (mine == p) & (choice == o), "supported")
        .when(compares & (F.coalesce(mine != p, F.lit(False)) | F.coalesce(choice != o, F.lit(False))), "conflict").otherwise("relaxed")
    )
    return out.withColumn("support", support).select(*rows.columns, "support")


def cross_source_matches(rows: DataFrame, row: str, columns: list[str], alias: DataFrame, value: str = "value", target: str = "target") -> DataFrame:
    """Several candidate columns as (type, value) rows, matched to the alias table: per row the distinct targets and whether the first column matched."""
    cells = F.array(*(F.struct(F.lit(c).alias("type"), F.upper(F.trim(F.col(c).cast("string"))).alias("v")) for c in columns))
    each = rows.select(row, F.explode(cells).alias("x")).select(row, "x.type", "x.v").where("v != ''")
    held = alias.select(F.upper(F.trim(F.col(value).cast("string"))).alias("v"), F.col(target)).distinct()
    found = each.join(held, "v").groupBy(row).agg(F.count_distinct(target).alias("n_targets"), F.bool_or(F.col("type") == columns[0]).alias("direct"))
    return rows.select(row).join(found, row, "left").select(row, F.coalesce("n_targets", F.lit(0)).alias("n_targets"), F.coalesce("direct", F.lit(False)).alias("direct"))


def strict_evidence(tests: dict[str, Column]) -> dict[str, Column]:
    """Columns verdict and failed: every test must hold for auto_confirm_ready, else manual with the names of the tests that fail. A null test fails."""
    failed = F.array_join(F.filter(F.array(*(F.when(~F.coalesce(p, F.lit(False)), F.lit(k)) for k, p in tests.items())), lambda x: x.isNotNull()), ",")
    return {"verdict": F.when(failed == "", "auto_confirm_ready").otherwise("manual"), "failed": failed}


def image_coverage(items: DataFrame, images: DataFrame, key: str) -> DataFrame:
    """Per item: n_images, n_primary and a state: none, no_primary, duplicate_primary, shared (one of its addresses serves other items too) or ok.

    images: key, url, is_primary. Addresses are counted before the join, so a widely used one costs one row per item."""
    users = images.select(key, "url").distinct().groupBy("url").agg(F.count("*").alias("n_items"))
    held = images.join(users, "url").groupBy(key).agg(F.count("*").alias("n_images"), count_when(F.col("is_primary")).alias("n_primary"), F.max("n_items").alias("most"))
    out = items.select(key).join(held, key, "left").fillna(0, ["n_images", "n_primary", "most"])
    state = F.when(F.col("n_images") == 0, "none").when(F.col("n_primary") == 0, "no_primary").when(F.col("n_primary") > 1, "duplicate_primary").when(F.col("most") > 1, "shared").otherwise("ok")
    return out.select(key, "n_images", "n_primary", state.alias("state"))


def presence_from_counts(counts: DataFrame) -> Column:
    """The status of an item in a channel by what is on record there alone; a null count is 0.

    counts: n_alias, n_confirmed, n_candidate, alias_products, alias_options, n_mapping, n_identity, mapping_products, mapping_options, mapping_owns,
    fan_out (items of its widest own code), n_images. absent asks for no image; with one the status is unknown."""
    c = {k: F.coalesce(F.col(k), F.lit(0)) for k in counts.columns if k.startswith(("n_", "alias_", "mapping_", "fan_"))}
    nothing = (c["n_alias"] == 0) & (c["n_mapping"] == 0)
    sure = (c["n_confirmed"] > 0) | (c["n_identity"] > 0)
    many = F.greatest(c["alias_products"], c["alias_options"], c["mapping_products"], c["mapping_options"], c["mapping_owns"], c["fan_out"]) > 1
    flags = {
        "confirmed": sure, "blocked": many, "high": c["n_candidate"] > 0, "medium": ~nothing & ~sure & ((c["alias_products"] > 0) | (c["mapping_products"] > 0)),
        "absent": nothing & (c["n_images"] == 0), "unknown": nothing & (c["n_images"] > 0),
    }
    return presence_status(flags)


def presence_rates(rows: DataFrame, channel: str, status: str) -> DataFrame:
    """(type, channel, row_count, rate, denominator): a channel's counts of each status and its rates, of all rows and of the present ones.

    Rates have no count and counts no rate; a rate of nothing is null. Channels are few, so this is a small aggregate."""
    n = lambda *names: count_when(F.col(status).isin(*names))
    total, present = F.count("*"), count_when(F.col(status) != "absent")
    lines = [("total_rows", total, None, "total"), ("present_rows", present, None, "present")]
    lines += [(f"{k}_rows", n(k), None, "total" if k == "absent" else "present") for k in (*MATCHED, *OTHER, *LEFT)]
    lines += [("match_rate_of_total", None, percent(n(*MATCHED), total), "total"), ("match_rate_of_present", None, percent(n(*MATCHED), present), "present")]
    lines += [("manual_rate_of_present", None, percent(n(*LEFT), present), "present"), ("absent_rate_of_total", None, percent(n("absent"), total), "total")]
    cells = [F.struct(F.lit(k).alias("type"), (F.lit(None) if c is None else c).cast("long").alias("row_count"), (F.lit(None) if r is None else r).cast("double").alias("rate"), F.lit(d).alias("denominator")) for k, c, r, d in lines]
    return rows.groupBy(channel).agg(F.array(*cells).alias("_l")).select(channel, F.explode("_l").alias("_l")).select("_l.type", channel, "_l.row_count", "_l.rate", "_l.denominator")


# How sale states are written.
SALE_STATES = {"active": ("판매중",), "inactive": ("판매대기", "수정대기", "승인대기", "일시품절", "판매중지")}


def line_evidence(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per code line of multi-line cells: row, line_no, code, option, status, alignment, sale_state, option_state, active, warning.

    rows: row, channel, product_code, codes, options, statuses, sale_status. dictionary: code. header: one option line more than codes, so that options
    shift by one; direct: as many; both ask for as many status lines, else the count needs review. Options are read by place even then; statuses
    only if their count fits. warning names what is wrong, '; '-joined, '' if nothing is; a null channel counts as unknown. active: sold, status Y, nothing
    wrong with channel, dictionary or alignment. The dictionary is reduced to a row per code; lines never multiply."""
    held = rows.select("row", "channel", "product_code", "sale_status", _lines("codes").alias("c"), _lines("options").alias("o"), _lines("statuses").alias("s"))
    n, o, s = F.size("c"), F.size("o"), F.size("s")
    alignment = F.when((o == n + 1) & (s == n), "header").when((o == n) & (s == n), "direct").otherwise("needs_review")
    zipped = _zipped("c", "o", "s", F.when(o == n + 1, 1).otherwise(0), s == n, F.lit(True))
    # a cell may have more option lines than code lines; those stand for no code
    facts = ["row", "channel", "product_code", "sale_status", "alignment"]
    each = held.withColumns({"alignment": alignment, "z": zipped}).select(*facts, F.posexplode_outer("z").alias("_pos", "x"))
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    each = each.select(*facts, (F.col("_pos") + 1).cast("long").alias("line_no"), *(text(F.col(f"x.{k}")).alias(k) for k in ("code", "option", "status")))
    out = each.join(dictionary.select("code").distinct().withColumn("_known", F.lit(True)), "code", "left")
    known, channel = F.coalesce("_known", F.lit(False)), F.coalesce("channel", F.lit("unknown"))
    wrong = {
        "unknown_channel": channel == "unknown", "no_product_code": ~nonblank(F.col("product_code")), "no_code": F.col("code").isNull(), "no_option": F.col("option").isNull(), "line_count": F.col("alignment") == "needs_review",
        "not_in_dictionary": ~known,
    }
    sale, option = F.lit("needs_review"), F.when(F.col("status") == "Y", "active").when(F.col("status") == "N", "inactive").otherwise("needs_review")
    for state, names in SALE_STATES.items():
        sale = F.when(F.col("sale_status").isin(*names), state).otherwise(sale)
    active = (sale == "active") & (option == "active") & (channel != "unknown") & known & (F.col("alignment") != "needs_review")
    warning = F.concat_ws("; ", *(F.when(p, F.lit(k)) for k, p in wrong.items()))
    return out.select("row", "line_no", "code", "option", "status", "alignment", sale.alias("sale_state"), option.alias("option_state"), active.alias("active"), warning.alias("warning"))
