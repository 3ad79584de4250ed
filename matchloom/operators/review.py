"""Review: buckets and tiers by ordered rules, the group matrix, exclusions, tags, the workbench and its templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.text import stable_id

from .options import joined_reasons
from .relational import distinct_by, top_rows

# Words that put a row in a bucket, and the two versions of the rules that disagree on the word "set", on what says that a code is blank, and on which
# tiers are candidates.
EXCLUDED_WORDS, SUBOPTION_WORDS = "단종|삭제|제외|excluded|discontinued|hidden", "보조옵션|보조 옵션|하위옵션|suboption|추가상품"
BROWSER_RULES = ("세트|조합|bundle|set(?![a-z0-9_])", "코드 근거|코드공란|코드 공란|자사코드 공란|code blank|blank code", ("AUTO_APPROVE_CANDIDATE", "FAST_REVIEW", "MANUAL_LINKED"))
SUMMARY_RULES = ("세트|조합|bundle|(^|[^a-z0-9])set([^a-z0-9]|$)", "코드 근거|코드공백|코드 공백|자사코드 공백|code blank|blank code", ("AUTO_APPROVE_CANDIDATE", "MANUAL_LINKED"))
WORKFLOW = {"browser": BROWSER_RULES, "summary": SUMMARY_RULES}
# Stock states and their buckets; the order in which a group takes the bucket of one of its rows.
STOCK_BUCKETS = {"STOCK_MATCH": "stock_match", "STOCK_DIFF": "stock_diff", "STOCK_SMARTSTORE_NOT_FOUND": "stock_missing"}
BUCKET_PRIORITY = ("excluded", "no_match", "bundle", "suboption", "code_blank", "stock_diff", "stock_missing", "hold", "candidate", "stock_match")


def workflow_bucket(tier: Column, texts: list[Column], stock: Column, rules: str = "browser") -> Column:
    """The first rule that holds: no match, excluded, bundle, suboption, blank code (words in the texts, case ignored), candidate tiers, stock states; else hold.
    The browser's rules ignore the case of the tier, too, when they look for no match.

    texts: tier, action, reason, duplicate risk and the channel's names, as texts; nulls are empty."""
    bundle, blank, candidates = WORKFLOW[rules]
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c.cast("string"), F.lit("")) for c in texts)))
    out = F.when((F.upper(tier) if rules == "browser" else tier) == "NO_MATCH", "no_match").when(text.rlike(EXCLUDED_WORDS), "excluded").when(text.rlike(bundle), "bundle").when(text.rlike(SUBOPTION_WORDS), "suboption").when(text.rlike(blank), "code_blank")
    out = out.when(tier.isin(*candidates), "candidate")
    for state, bucket in STOCK_BUCKETS.items():
        out = out.when(stock == state, bucket)
    return out.otherwise("hold")


def group_bucket(buckets: Column) -> Column:
    """The bucket of a group, from an array of its rows' buckets: the first of the priority list that is there, else hold."""
    out = None
    for k in BUCKET_PRIORITY:
        out = F.when(F.array_contains(buckets, k), k) if out is None else out.when(F.array_contains(buckets, k), k)
    return out.otherwise("hold")


def policy_tier(tier: Column, duplicates: Column, reason: Column, needed: str, either: tuple[str, ...]) -> Column:
    """FAST_REVIEW rows with at most three duplicates whose reason has one token and any of some others are candidates with weak evidence; other tiers stay, null is empty."""
    has = lambda x: F.contains(F.coalesce(reason, F.lit("")), F.lit(x))
    any_of = F.lit(False)
    for x in either:
        any_of = any_of | has(x)
    weak = (F.coalesce(duplicates, F.lit(0)) <= 3) & has(needed) & any_of
    return F.when(tier == "AUTO_APPROVE_CANDIDATE", tier).when((tier == "FAST_REVIEW") & weak, "APPROVAL_CANDIDATE_CODE_EVIDENCE_WEAK").when(tier == "FAST_REVIEW", "FAST_REVIEW_REQUIRED").otherwise(F.coalesce(tier, F.lit("")))


def group_matrix(rows: DataFrame, group: list[str], channel: str, order: str, image: Column, duplicates: str, channels: list[str], tags: str | None = None, bucket: str | None = None, shared_tags: str | None = None) -> DataFrame:
    """Per group the last row's order value of each channel, the primary row (last with image, else last) and the duplicates' sum; with tags (an array column) the
    longest list, of equally long ones the earliest; with bucket the group's bucket by BUCKET_PRIORITY; with shared_tags (an array
    of structs tag_id, tag_name, tag_scope, assignment_id) the tags of all its rows in their order, each once. A group is one item's rows, a few for each channel."""
    key = F.col(order)
    cells = [F.max(F.when(F.col(channel) == c, key)).alias(f"at_{c}") for c in channels]
    more = []
    if tags:
        more.append(F.max(F.struct(F.size(F.coalesce(F.col(tags), F.array().cast("array<string>"))).alias("n"), (-key).alias("o"), F.col(tags).alias("t"))).getField("t").alias("tags"))
    if bucket:
        more.append(group_bucket(F.collect_set(bucket)).alias("bucket"))
    if shared_tags:
        none = F.array().cast(rows.schema[shared_tags].dataType)
        listed = F.array_sort(F.collect_list(F.struct(key.alias("o"), F.coalesce(F.col(shared_tags), none).alias("t"))))
        more.append(distinct_by(F.flatten(F.transform(listed, lambda x: x.t)), tag_key).alias("shared_tags"))
    return rows.groupBy(*group).agg(*cells, F.coalesce(F.max(F.when(image, key)), F.max(key)).alias("primary_row"), F.sum(duplicates).cast("long").alias("duplicates"), F.count("*").alias("n_rows"), *more)


def tag_key(tag: Column) -> Column:
    """What makes two tags one: id (else name), scope and assignment."""
    name = F.coalesce(F.nullif(tag.tag_id.cast("string"), F.lit("")), tag.tag_name, F.lit(""))
    return F.concat_ws("|", name, F.coalesce(tag.tag_scope, F.lit("")), F.coalesce(tag.assignment_id.cast("string"), F.lit("")))


def queue_filter(rows: DataFrame, channels: list[str], tier: str | None = None, stock: str | None = None, bucket: str | None = None, mode: str | None = None, tags: tuple[str, ...] = (), image_only: bool = False, text: str = "", columns: tuple[str, ...] = (), hide_excluded: bool = False, exclusions: str | None = None) -> DataFrame:
    """Rows of the shown channels that pass every filter given. rows: channel, tier, stock, bucket, tag_names (array), has_image, the text columns, and left_out for exclusions.

    hide_excluded leaves out the bucket of excluded rows; exclusions: hide leaves out rows that a list leaves out (see exclusion), only leaves those.

    All of the tags must be there. mode: problem leaves out candidates and matching stock, candidate leaves only those. bucket: a stock bucket asks for the
    stock state, others for the workflow bucket. text: contained in the columns, joined by spaces, case ignored."""
    df = rows.where(F.col("channel").isin(*channels)) if channels else rows.where("false")
    done = F.coalesce(F.col("bucket").isin("candidate", "stock_match"), F.lit(False))
    states = {v: k for k, v in STOCK_BUCKETS.items()}
    if tier:
        df = df.where(F.col("tier") == tier)
    if stock:
        df = df.where(F.col("stock") == stock)
    if bucket:
        df = df.where(F.col("stock") == states[bucket] if bucket in states else F.col("bucket") == bucket)
    if hide_excluded:
        df = df.where(~F.coalesce(F.col("bucket") == "excluded", F.lit(False)))
    if exclusions:
        out = F.coalesce("left_out", F.lit(False))
        df = df.where(out if exclusions == "only" else ~out)
    if mode:
        df = df.where(done if mode == "candidate" else ~done)
    if tags:
        df = df.where(F.size(F.array_except(F.array(*(F.lit(x) for x in tags)), F.coalesce("tag_names", F.array().cast("array<string>")))) == 0)
    if image_only:
        df = df.where("has_image")
    if text.strip():
        df = df.where(F.contains(F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))), F.lit(text.strip().lower())))
    return df


# What marks a row as left out, in its code and name, its colour hints and its explicit marks.
XX_CODE, XX_NAME = r"(?i)(^|[^a-z0-9])xx([^a-z0-9]|$)", r"(?i)^\s*\[?xx\]?"
COLOUR_HINTS = {"orange": "orange|주황|ffc000|ff9900|ff7a00", "yellow": "yellow|노랑|노란|ffff00|ffe65a"}
EXPLICIT_MARK = r"(^|\s)(true|1|yes|y|exclude|excluded|md_excluded|{channel}_excluded)(\s|$)"


def exclusion(known: Column, listed: Column, code: Column, name: Column, hints: Column, marks: Column, channel: str) -> Column:
    """Why a row is left out, comma-joined, '' if it isn't. known: the final list has the row; listed: that list's reasons (an array), which alone count then.

    Else: a bounded xx in the code or one at the name's start, colours in the hints (both may hold), and an explicit mark where nothing else holds. hints and marks
    are lower-case texts; nulls are empty."""
    text = lambda c: F.coalesce(c, F.lit(""))
    reasons = [F.when(text(code).rlike(XX_CODE) | text(name).rlike(XX_NAME), "xx"), *(F.when(text(hints).rlike(p), k) for k, p in COLOUR_HINTS.items())]
    found = F.array_compact(F.array(*reasons))
    explicit = text(marks).rlike(EXPLICIT_MARK.format(channel=channel))
    found = F.when((F.size(found) == 0) & explicit, F.array(F.lit("explicit"))).otherwise(found)
    own = F.array_distinct(F.array_compact(F.coalesce(listed, F.array().cast("array<string>"))))
    return F.array_join(F.when(F.coalesce(known, F.lit(False)), own).otherwise(F.array_distinct(F.concat(own, found))), ",")


# Signs that names and options are compared without, what ends an option, words that mark a risk, the action that holds a row back.
NAME_SIGNS, OPTION_SIGNS, OPTION_END, WORN = r"[\s\[\](){}<>_\-./|]+", r"[\s\[\](){}<>_\-./|,*]+", r"(?s)(=|\r|\n).*$", "-?모델착용"
RISK_WORDS = "세트 묶음 1+1 랜덤 혼합 대체 교환 단종 삭제 품절 크리스탈ab [xxx]".split() + ["sold out", "crystal ab"]
RISK_PATTERN = "(^|[^a-z0-9가-힣])(ab|set)([^a-z0-9가-힣]|$)"
HOLD_ACTION = "자동 승인하지 않음"


def plain_name(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), NAME_SIGNS, ""))


def plain_option(c: Column) -> Column:
    """Without bracketed parts, what follows a sign of equality or a line break, and the note that a model wears it."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), r"\[[^\]]*\]", "")
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(out, OPTION_END, ""), WORN, ""), OPTION_SIGNS, ""))


def auto_approval(rows: DataFrame, promoted_channel: str, tiers: tuple[str, ...] = ("REVIEW", "NO_MATCH")) -> DataFrame:
    """Adds approval: P1A (names equal) or P1B (one contains the other) for strict rows that aren't held; P2 for held ones; null otherwise.

    rows: channel, tier, product_code, option_code (the channel's), item_product, item (what it would be linked to), name, item_name, option, item_option, reason,
    action, duplicates, duplicate_risk, stock, tagged. Strict: a tier of the scope, both item codes, at most one candidate and no duplicate risk, matching stock
    (null counts as such), no risk word in any text, names equal or contained, options equal as plain_option has them. A row that a person has tagged is never approved. P2
    asks for equal names, the one channel whose held rows may be promoted, and a (channel, product, option) key whose held rows with equal names lead to one item."""
    text = F.lower(F.concat_ws(" ", "name", "option", "item_name", "item_option", "reason", "action"))
    risk = text.rlike(RISK_PATTERN)
    for w in RISK_WORDS:
        risk = risk | F.contains(text, F.lit(w))
    a, b, o, p = plain_name(F.col("name")), plain_name(F.col("item_name")), plain_option(F.col("option")), plain_option(F.col("item_option"))
    named = (a != "") & (b != "")
    exact = named & (a == b)
    match = named & (F.contains(a, b) | F.contains(b, a))
    single = (F.coalesce(F.col("duplicates"), F.lit(0)) <= 1) & ~F.coalesce(F.col("duplicate_risk").cast("string"), F.lit("")).isin("true", "t", "1", "yes", "Y")
    strict = F.col("tier").isin(*tiers) & F.col("item_product").isNotNull() & F.col("item").isNotNull() & single & (F.coalesce("stock", F.lit("STOCK_MATCH")) == "STOCK_MATCH") & ~risk & match & (o != "") & (o == p)
    free = ~F.coalesce(F.col("tagged"), F.lit(False))
    held = rows.withColumns({"_exact": exact, "_strict": F.coalesce(strict, F.lit(False)) & free, "_held": F.col("action") == HOLD_ACTION, "_key": F.concat_ws("|", "channel", "product_code", "option_code"), "_target": F.concat_ws("|", "item_product", "item")})
    sure = F.col("_strict") & F.col("_held") & F.col("_exact") & (F.col("channel") == promoted_channel)
    alone = held.where(sure).groupBy(F.col("_key").alias("_k")).agg(F.count_distinct("_target").alias("_n")).where("_n = 1").select("_k", F.lit(True).alias("_alone"))
    out = held.join(alone, F.col("_key") == F.col("_k"), "left")
    first = F.col("_strict") & ~F.col("_held")  # a row without action is neither held nor free to go
    return out.withColumn("approval", F.when(first & F.col("_exact"), "P1A").when(first, "P1B").when(sure & F.col("_alone"), "P2")).select(*rows.columns, "approval")


# The workbench's flags, in the order of their reasons; its types and actions, each the first that holds.
WORKBENCH_FLAGS = ("source_conflict", "warning", "duplicate_sku", "narrow_risk", "evidence_missing", "absent_possible", "alias_conflict", "mapping_conflict")
WORKBENCH_TYPES = [("source_conflict", ("source_conflict",)), ("warning_bucket", ("warning",)), ("duplicate_sku", ("duplicate_sku",)), ("narrow_risk", ("narrow_risk",)), ("evidence_missing", ("evidence_missing",)), ("channel_absent_or_inactive_possible", ("absent_possible",)), ("existing_conflict", ("alias_conflict", "mapping_conflict"))]
WORKBENCH_ACTIONS = [("classify_channel_absent_or_inactive", ("absent_possible",)), ("compare_conflicting_candidates", ("source_conflict",)), ("inspect_source_warning", ("warning",)), ("compare_duplicate_candidates", ("duplicate_sku", "duplicate_evidence")), ("manual_option_risk_review", ("narrow_risk",)), ("find_or_mark_missing_evidence", ("evidence_missing",)), ("do_not_overwrite_existing_mapping", ("alias_conflict", "mapping_conflict"))]


def workbench(rows: DataFrame, key: list[str], always: Column | None = None) -> DataFrame:
    """Rows that a person must see: review_id (md5 of the key), evidence_level, risk_type, reasons, action and scope beside the key.

    rows: the key, WORKBENCH_FLAGS, duplicate_evidence, n_items (items that the evidence leads to), direct, same_target (an existing alias or mapping has the same item: such rows
    are done and dropped). always: rows that are listed without a flag. Level, type and action are the first rule that holds; null flags don't."""
    flags = (*WORKBENCH_FLAGS, "duplicate_evidence", "direct", "same_target")
    f = {k: F.coalesce(F.col(k), F.lit(False)) for k in flags}
    n = F.coalesce(F.col("n_items"), F.lit(0))

    def any_of(names) -> Column:
        out = F.lit(False)
        for k in names:
            out = out | f[k]
        return out

    def first(rules: list, last: str) -> Column:
        out = None
        for name, of in rules:
            out = F.when(any_of(of), name) if out is None else out.when(any_of(of), name)
        return out.otherwise(last)

    level = F.when(f["source_conflict"], "source_conflict").when(f["duplicate_evidence"] | f["duplicate_sku"], "duplicate").when((n == 1) & f["direct"], "direct").when(n == 1, "unique").when(n == 0, "missing").otherwise("needs_review")
    seen = any_of(WORKBENCH_FLAGS) | (F.coalesce(always, F.lit(False)) if always is not None else F.lit(False))
    return rows.where(~f["same_target"] & seen).select(
        stable_id(*(F.col(k) for k in key)).alias("review_id"), *key, level.alias("evidence_level"), first(WORKBENCH_TYPES, "manual_review_required").alias("risk_type"), joined_reasons({k: f[k] for k in WORKBENCH_FLAGS}).alias("reasons"),
        first(WORKBENCH_ACTIONS, "manual_match_review").alias("action"), F.when(f["absent_possible"], "deletion_or_inactive_review_candidate").otherwise("manual_matching_candidate").alias("scope"),
    )


def long_template(rows: DataFrame, row: str, lists: list[str], score: str, most: int) -> DataFrame:
    """Parallel |-joined lists of unequal length as one row per place, short ones padded with null, and a priority of 10000 (few candidates) + 100 x score - candidates."""
    held = {c: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(c, r"\|")) for c in lists}
    n = F.greatest(*(F.size(c) for c in held.values())) if len(held) > 1 else F.size(next(iter(held.values())))
    out = rows.withColumns({f"_{c}": v for c, v in held.items()}).withColumn("n_candidates", n.cast("long"))
    priority = F.when(F.col("n_candidates") <= most, 10000).otherwise(0) + 100 * F.col(score) - F.col("n_candidates")
    out = out.where("n_candidates > 0").withColumn("priority", priority.cast("long")).withColumn("place", F.explode(F.sequence(F.lit(0), F.col("n_candidates").cast("int") - 1)))
    return out.select(row, "n_candidates", "priority", (F.col("place") + 1).cast("long").alias("place"), *(F.get(f"_{c}", F.col("place")).alias(c) for c in lists))


def shared_tags(rows: DataFrame, tags: DataFrame, keys: list[str], tag: str = "tags") -> DataFrame:
    """Adds tag_names: the tags given to any of the row's keys, each once, sorted. tags: (scope, key, tags), cells split at commas, semicolons and line breaks."""
    each = tags.select("scope", "key", F.explode(F.split(tag, r"[,;\n\r]+")).alias("t")).select("scope", "key", F.trim("t").alias("t")).where("t != ''")
    held = each.groupBy("scope", "key").agg(F.array_sort(F.collect_set("t")).alias("t"))
    for k in keys:
        own = held.where(F.col("scope") == k).select(F.col("key").alias(k), F.col("t").alias(f"_t_{k}"))
        rows = rows.join(own, k, "left")
    none = F.array().cast("array<string>")
    return rows.withColumn("tag_names", F.array_sort(F.array_distinct(F.concat(*(F.coalesce(f"_t_{k}", none) for k in keys))))).drop(*(f"_t_{k}" for k in keys))


def best_image(images: DataFrame, key: str) -> DataFrame:
    """One image for each key: primary first, then the least sort order, then the address."""
    return top_rows(images, [key], [F.col("is_primary").desc(), F.col("sort_order").asc_nulls_last(), F.col("url")])


# Words that mark a row in its reasons and actions.
CONFLICT_WORDS, AUTO_WORDS, FAST_WORDS = "(?i)중복|충돌|duplicate|conflict", "(?i)자동승인|auto.?approve", "(?i)빠른검토|fast.?review"
UNLINKED_BUCKETS = ("no_match", "code_blank", "stock_missing")


def review_predicates(tier: Column, policy: Column, bucket: Column, texts: list[Column], duplicates: Column, linked: Column, unlinked: Column, discontinued: Column, required: Column, risk: Column | None = None, label: Column | None = None) -> dict[str, Column]:
    """Columns conflict, needs_linking, auto, fast and pending; nulls are false, empty or 0. texts (reason, action) are searched for all words, risk for those of a conflict alone, label (of the policy) for those of an approval.

    pending: rows that were unlinked by hand or are to be discontinued never are; then conflicts, rows without link and rows that ask for a review are;
    of the rest those that can't be approved by themselves."""
    no = lambda c: F.coalesce(c, F.lit(False))
    doubt, text = (F.concat_ws(" ", *([] if more is None else [more]), *texts) for more in (risk, label))
    conflict = (F.coalesce(duplicates, F.lit(0)) > 1) | doubt.rlike(CONFLICT_WORDS) | no(tier.rlike(CONFLICT_WORDS))
    needs = no(unlinked) | ~no(linked) | no(bucket.isin(*UNLINKED_BUCKETS))
    fast = no(tier == "FAST_REVIEW") | no(policy == "FAST_REVIEW_REQUIRED") | text.rlike(FAST_WORDS)
    auto = no(tier.isin("AUTO_APPROVE_CANDIDATE", "FAST_REVIEW")) | no(policy.isin("AUTO_APPROVE_CANDIDATE", "APPROVAL_CANDIDATE_CODE_EVIDENCE_WEAK", "FAST_REVIEW_REQUIRED")) | text.rlike(AUTO_WORDS)
    pending = ~no(unlinked) & ~no(discontinued) & (conflict | needs | no(required) | ~auto)
    return {"conflict": conflict, "needs_linking": needs, "auto": auto, "fast": fast, "pending": pending}


def tag_targets(uploads: DataFrame, queue: DataFrame) -> DataFrame:
    """(upload, tag, scope, product, item, match): the tags of uploaded cells and what they are for.

    uploads: upload (unique), tags, scope, product, item, channel, channel_product, channel_option; queue: channel, channel_product, channel_option,
    product, item. A row with item or product is direct (an item's product is its code up to the first hyphen); else the queue's rows with
    the given channel codes decide: one target is seller_resolved, several are multiple_targets, none is not_found. A code that isn't given matches
    any, so uploads are joined once for each set of given codes, on these alone. Cells split at commas, semicolons and line breaks."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    keys = ["channel", "channel_product", "channel_option"]
    ups = uploads.select("upload", "tags", F.lower(F.trim("scope")).alias("scope"), blank("product").alias("product"), blank("item").alias("item"), *(blank(k).alias(k) for k in keys))
    ups = ups.withColumn("product", F.coalesce("product", F.substring_index("item", "-", 1)))
    here = queue.select(*(blank(k).alias(k) for k in keys), F.coalesce(blank("product"), F.substring_index(blank("item"), "-", 1)).alias("_p"), blank("item").alias("_i")).where("_p is not null or _i is not null")
    target = F.struct(F.coalesce("_p", F.lit("")).alias("p"), F.coalesce("_i", F.lit("")).alias("i"))
    found = None
    for n in range(2 ** len(keys)):
        given = [k for j, k in enumerate(keys) if n >> j & 1]
        test = F.col("item").isNull() & F.col("product").isNull()
        for k in keys:
            test = test & (F.col(k).isNotNull() if k in given else F.col(k).isNull())
        # the targets of a key are counted before the join: only whether there is one or more than one matters
        held = here.groupBy(*given).agg(F.min(target).alias("_least"), F.max(target).alias("_most"))
        some = ups.where(test).select("upload", *given)
        if not given:  # one row for all
            some, held = some.withColumn("_all", F.lit(1)), F.broadcast(held.where("_least is not null").withColumn("_all", F.lit(1)))
        each = some.join(held, given or ["_all"])
        each = each.select("upload", "_least", "_most")
        found = each if found is None else found.unionByName(each)
    out = ups.join(found, "upload", "left")
    direct, one = F.col("item").isNotNull() | F.col("product").isNotNull(), F.col("_least") == F.col("_most")
    match = F.when(direct, "direct").when(F.col("_least").isNull(), "not_found").when(one, "seller_resolved").otherwise("multiple_targets")
    out = out.withColumn("match", match)
    resolved = F.col("match") == "seller_resolved"
    product, item = F.when(resolved, F.nullif("_least.p", F.lit(""))).otherwise(F.col("product")), F.when(resolved, F.nullif("_least.i", F.lit(""))).otherwise(F.col("item"))
    scope = F.when(F.col("scope").isin("product", "상품", "상품태그"), "product").when(F.col("scope").isin("option", "sku", "옵션", "옵션태그"), "option").when(item.isNotNull(), "option").otherwise("product")
    tag = F.explode(F.array_distinct(F.filter(F.transform(F.split("tags", r"[,;\n\r]+"), lambda x: F.trim(x)), lambda x: x != "")))
    return out.select("upload", scope.alias("scope"), product.alias("product"), item.alias("item"), "match", tag.alias("tag"))


# Tiers that stay in the light queue.
OPEN_TIERS = ("REVIEW", "FAST_REVIEW", "NO_MATCH", "MANUAL_LINKED")


def light_queue(rows: DataFrame, tier: str, stock: str, required: str, texts: list[str], held_stock: tuple[str, ...] = ("STOCK_HOLD_REVIEW",)) -> DataFrame:
    """Rows that a person may have to see, with queue_priority (10 first) and search_text (the texts joined by spaces, nulls skipped).

    held_stock: states of the stock comparison that hold a row, those of a channel where the item wasn't found among them."""
    held, at = F.col(stock).isin(*held_stock), F.col(tier)
    priority = F.when(at == "NO_MATCH", 10).when(held, 20).when(at == "REVIEW", 30).when(at == "FAST_REVIEW", 40).when(at == "MANUAL_LINKED", 90).otherwise(50)
    shown = F.coalesce(F.col(required), F.lit(False)) | F.coalesce(at.isin(*OPEN_TIERS), F.lit(False)) | F.coalesce(held, F.lit(False))
    return rows.where(shown).withColumns({"queue_priority": priority.cast("long"), "search_text": F.concat_ws(" ", *texts)})
