"""Reconciliation operators on hand-made rows: traps of blanks, nulls, order of rules, ties."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from matchloom.functions import text as X
from matchloom.operators import codes, evidence, lookup, options, queue, relational, review, stock, validation, weak
from matchloom.plans import apply, changes, export_rules
from matchloom.sources import files, inventory


def one(spark, **columns):
    row = spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()
    return row.asDict()


def test_blanks_and_parsing(spark):
    got = one(
        spark, a=X.nonblank(F.lit(None).cast("string")), b=X.nonblank(F.lit(" ")), c=X.nonblank(F.lit("\t")), d=X.number(F.lit("1,000")), e=X.number(F.lit(" ")), f=X.number(F.lit("abc")), g=X.replace_first(F.lit("a-b-c"), "-", "+"),
        h=X.last_code(F.lit("x AB-1 AB-2_3"), F.lit("CD-9")), i=X.last_code(F.lit(None).cast("string"), F.lit("CD-9")), j=X.option_number(F.lit("AB-007")), k=X.key(F.lit(" ab1.0 ")), l=X.compact(F.lit("가 나-A")), m=X.whole_number(F.lit("12x")),
        n=X.words(F.lit("Red [x y] blue a red"), 2), o=X.excel_text(F.lit('a"b')), p=X.truth(F.lit("Yes")),
    )
    assert got == {"a": False, "b": False, "c": True, "d": 1000.0, "e": 0.0, "f": None, "g": "a+b-c", "h": "AB-2_3", "i": "CD-9", "j": "7", "k": "AB1", "l": "가나a", "m": None, "n": ["red", "blue"], "o": '="a""b"', "p": True}


def test_codes(spark):
    a, b = F.lit("q [AB-1-2-3]"), F.lit("[CD-1-2_3] ef-1-2-3")
    assert one(spark, c=codes.extract_code(F.lit(" "), a, b, "v2"))["c"].asDict() == {"code": "CD-1-2_3", "method": "b_bracket", "pattern": "bracket", "family": "existing", "loose": "AB-1-2-3"}
    # a short bracket of either text comes before four parts in v2, the second text before the first in v3
    a, b = F.lit("[AB-1-2]"), F.lit("[CD-1-2-3]")
    assert [one(spark, c=codes.extract_code(F.lit(None), a, b, v))["c"].method for v in ("v2", "v3")] == ["a_bracket", "b_four_parts"]
    assert one(spark, c=codes.extract_code(F.lit(" X "), a, b))["c"].code == "X" and one(spark, c=codes.extract_code(F.lit(None), F.lit(None), F.lit("")))["c"].code is None
    score = lambda x, y, option, numbers: one(spark, s=codes.token_score(*codes.token_parts(F.lit(x)).values(), *codes.token_parts(F.lit(y)).values(), F.lit(option), F.array(*(F.lit(n).cast("string") for n in numbers))))["s"]
    assert [score("Red 10", "red-10", "1", ["1"]), score("red 10", "red", "1", ["10"]), score("1 2", "2 1", None, [None]), score("a b", "ab", "", [""]), score("", None, "3", ["2", "3"])] == [190, 40, 0, 0, 30]
    assert one(spark, a=codes.composite_key(F.lit(" a"), F.lit("b ")), b=codes.composite_key(F.lit("a"), F.lit(" "))) == {"a": "a-b", "b": None}
    alias = spark.createDataFrame([("x", 1), ("x", 1), ("y", 1), ("y", 2)], "value string, target long")
    rows = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "code string")
    got = {r.code: (r.match_count, r.resolved) for r in codes.resolve_alias(rows, alias, "code").collect()}
    assert got == {"x": (1, 1), "y": (2, None), "z": (0, None), None: (0, None)}


def test_aligned_lines(spark):
    rows = spark.createDataFrame([(1, "a\r\nb", "head\nx\ny\n", "on\noff"), (2, "a\n\nb", "x", "on"), (3, None, None, None)], "row long, c string, o string, s string")
    got = [tuple(r) for r in evidence.aligned_lines(rows, "row", "c", "o", "s").orderBy("row", "line_no").collect()]
    assert got[:2] == [(1, 1, "a", "x", "on", "header"), (1, 2, "b", "y", "off", "header")]
    assert [(r[2], r[3], r[4], r[5]) for r in got[2:5]] == [("a", None, None, "needs_review"), ("", None, None, "needs_review"), ("b", None, None, "needs_review")]
    assert len(got) == 6


def test_profile_and_scope_take_blanks_for_none(spark):
    rows = spark.createDataFrame([("i", "B", "2", True), ("i", "A", None, False), ("i", " ", "1", True), ("j", "", None, False)], "item string, product string, option string, sure boolean")
    got = {r["item"]: tuple(r)[1:] for r in evidence.mapping_profile(rows, "item", "product", "option", F.col("sure")).collect()}
    assert got == {"i": (3, 2, 1, 2, 2, "A", "1"), "j": (1, 0, 1, 0, 0, None, None)}  # the least product is that of a candidate row
    items = spark.createDataFrame([("i", "X", 1, "f", "C"), ("i", "Y", 1, "f", "C"), ("j", "X", None, " ", ""), ("k", " ", 2, "g", "D")], "item string, code string, product int, family string, channel string")
    got = {r["item"]: tuple(r)[1:] for r in evidence.code_scope(items, "code", "item", "product", "family", "channel").collect()}
    assert got == {"i": (2, 2, 1, 1, 1), "j": (1, 2, 1, 1, 1)}


def test_unique_evidence_and_conflicts(spark):
    items = [(1, "s1", "c1", False), (2, "s2", "c2", False), (3, "s3", "c3", True), (4, "s4", "c4", False), (5, "s5", "c5", False), (6, "s6", "c6", None), (6, "s6", "c6b", None), (7, "s7", " ", False), (8, "s8", "c8", True), (9, "s9", "c9", False), (10, "s9", "c10", False)]
    mapping = [("c1", "p1", "o1"), ("c1", "p1", "o1"), ("c2", "p2", "o2"), ("c3", "p2", "o2"), ("c4", "p4", "o1"), ("c4", "p4", "o2"), ("c5", None, " "), ("c6", "p6", "o"), ("c6b", "p6", None), ("c8", "p8", "o"), ("c9", "p9", "o"), ("c10", "p10", "o"), (None, "x", "y")]
    got = evidence.unique_evidence(spark.createDataFrame(items, "item long, shared string, code string, risk boolean"), spark.createDataFrame(mapping, "code string, product string, option string"))
    # a clean item whose pair also serves a risky one is not unique
    assert {r.item: r.verdict for r in got.collect()} == {1: "clean", 2: "duplicate_pair", 3: "duplicate_pair", 4: "duplicate_evidence", 5: "evidence_missing", 6: "duplicate_evidence", 7: "evidence_missing", 8: "risk", 9: "duplicate_product", 10: "duplicate_product"}
    # half an address is never clean: the counts take plain equality, so a pair without product or option has none
    half = [(1, "s1", "h1", False), (2, "s2", "h2", False), (3, None, "h3", False), (4, "s4", "h4", True)]
    halves = [("h1", "P1", None), ("h2", None, "O2"), ("h3", "P3", "O3"), ("h4", "P4", "")]
    got = evidence.unique_evidence(spark.createDataFrame(half, "item long, shared string, code string, risk boolean"), spark.createDataFrame(halves, "code string, product string, option string"))
    assert {r.item: (r.n_items, r.n_products, r.verdict) for r in got.collect()} == {1: (0, 1, "half_pair"), 2: (0, 0, "half_pair"), 3: (1, 0, "half_pair"), 4: (0, 1, "half_pair")}
    rows = spark.createDataFrame([("i", "a", "s1"), ("i", "b", "s1"), ("j", "a", "s2"), ("k", "c", "s1"), ("k", "c", "s2")], "item string, code string, source string")
    got = {(r.item, r.code): (r.code_conflict, r.item_conflict) for r in relational.source_conflicts(rows, "item", "code", "source").collect()}
    assert got == {("i", "a"): (False, True), ("j", "a"): (False, True)}


@pytest.mark.parametrize("a,b,bucket", [("", "0", "NO_CHANGE"), ("abc", "1", "RECHECK_REQUIRED"), ("5", "0", "ZERO_OUT"), ("5", "6", "INCREASE"), ("100", "80", "LARGE_DECREASE"), ("100", "81", "SMALL_DECREASE"), ("10", "5", "LARGE_DECREASE"), ("1,000", "999", "SMALL_DECREASE"), ("-5", "0", "INCREASE"), ("0", "-1", "SMALL_DECREASE"), ("-100", "-101", "SMALL_DECREASE"), ("0", "-20", "LARGE_DECREASE"), ("0", "0", "NO_CHANGE")])
def test_stock_bucket(spark, a, b, bucket):
    assert one(spark, x=stock.stock_bucket(F.lit(a), F.lit(b)))["x"] == bucket


def test_dictionary(spark):
    terms = [("c", "red", "token"), ("m", "steel", "contains"), ("m", "stainlesssteel", "contains")]
    hit = lambda s: (lambda r: r and r.term)(one(spark, h=options.dictionary_term(F.lit(s), terms))["h"])
    assert [hit("Stainless-Steel red"), hit("bored"), hit("a RED b"), hit("")] == ["stainlesssteel", None, "red", None]


def test_review_rules(spark):
    bucket = lambda tier, text, stock=None, rules="browser": one(spark, x=review.workflow_bucket(F.lit(tier), [F.lit(tier), F.lit(text)], F.lit(stock), rules))["x"]
    assert [bucket("NO_MATCH", "단종"), bucket("REVIEW", "단종 세트"), bucket("REVIEW", "my set"), bucket("REVIEW", "subset"), bucket("REVIEW", "a my_set"), bucket("REVIEW", "my_set", None, "summary"), bucket("REVIEW", "추가상품"), bucket("REVIEW", "코드공란"), bucket("REVIEW", "코드공란", None, "summary")] == ["no_match", "excluded", "bundle", "bundle", "bundle", "bundle", "suboption", "code_blank", "hold"]
    assert [bucket("REVIEW", "sets", None), bucket("REVIEW", "xset", None, "summary"), bucket("FAST_REVIEW", "x"), bucket("FAST_REVIEW", "x", "STOCK_DIFF", "summary"), bucket("MANUAL_LINKED", "x", None, "summary"), bucket("REVIEW", "", "STOCK_SMARTSTORE_NOT_FOUND"), bucket(None, None, None)] == ["hold", "hold", "candidate", "stock_diff", "candidate", "stock_missing", "hold"]
    policy = lambda tier, dup, reason: one(spark, x=review.policy_tier(F.lit(tier), F.lit(dup), F.lit(reason), "seen", ("exact", "part")))["x"]
    assert [policy("FAST_REVIEW", 3, "seen part"), policy("FAST_REVIEW", 4, "seen part"), policy("FAST_REVIEW", None, "exact part"), policy("AUTO_APPROVE_CANDIDATE", 9, ""), policy(None, 0, None)] == ["APPROVAL_CANDIDATE_CODE_EVIDENCE_WEAK", "FAST_REVIEW_REQUIRED", "FAST_REVIEW_REQUIRED", "AUTO_APPROVE_CANDIDATE", ""]
    why = lambda known=False, listed=None, code="", name="", hints="", marks="": one(spark, x=review.exclusion(F.lit(known), F.array(*map(F.lit, listed)) if listed else F.lit(None).cast("array<string>"), F.lit(code), F.lit(name), F.lit(hints), F.lit(marks), "shop"))["x"]
    assert [why(code="boxxed"), why(code="a-XX-1"), why(name="[xx] a"), why(name="a xx"), why(hints="orange ffff00", marks="yes"), why(marks="so shop_excluded"), why(marks="yesterday"), why(True, ["gone", "gone"], "xx"), why(True, None, "xx"), why(False, ["gone"], "xx")] == ["", "xx", "xx", "", "orange,yellow", "explicit", "", "gone", "", "gone,xx"]
    rows = spark.createDataFrame([(1, "a|b|c", "x", 2), (2, None, "", 1)], "row long, p string, q string, s int")
    got = [tuple(r) for r in review.long_template(rows, "row", ["p", "q"], "s", 2).orderBy("place").collect()]
    assert got == [(1, 3, 197, 1, "a", "x"), (1, 3, 197, 2, "b", None), (1, 3, 197, 3, "c", None)]


def test_auto_approval(spark):
    schema = "k long, channel string, tier string, product_code string, option_code string, item_product string, item string, name string, item_name string, option string, item_option string, reason string, action string, duplicates long, duplicate_risk string, stock string, tagged boolean"
    good = dict(channel="a", tier="REVIEW", product_code="p", option_code="o", item_product="ip", item="i", name="Ring (A)", item_name="ring a", option="[x] Red=1\nmore", item_option="red-모델착용", reason=None, action="ok", duplicates=1, duplicate_risk=None, stock=None, tagged=None)
    held = good | dict(action=review.HOLD_ACTION, channel="b")
    cases = [good, good | dict(item_name="ring a big"), good | dict(tagged=True), good | dict(action=None), good | dict(tier="FAST_REVIEW"), good | dict(item=None), good | dict(duplicates=2), good | dict(duplicate_risk="yes"), good | dict(stock="STOCK_DIFF"), good | dict(reason="a set of"), good | dict(reason="1+1"), good | dict(option="blue"), good | dict(name="")]
    cases += [held | dict(option_code="o1"), held | dict(option_code="o2", tagged=True), held | dict(option_code="o3", item_name="ring a big"), held | dict(option_code="o4", channel="a"), held | dict(option_code="o5"), held | dict(option_code="o5", item="j"), held | dict(option_code="o6"), held | dict(option_code="o6", item="j", tagged=True)]
    names = [x.split()[0] for x in schema.split(", ")][1:]
    rows = spark.createDataFrame([(k, *(c[n] for n in names)) for k, c in enumerate(cases)], schema)
    got = {r.k: r.approval for r in review.auto_approval(rows, "b").collect()}
    assert got == dict.fromkeys(range(len(cases))) | {0: "P1A", 1: "P1B", 13: "P2", 19: "P2"}


def test_promotion_support_and_workbench(spark):
    high = dict.fromkeys(evidence.PROMOTION_FLAGS, False) | dict.fromkeys(("blocked", "duplicate", "one_target", "pair", "one_item", "same_family", "code"), True)
    tier = lambda **x: tuple(one(spark, **evidence.promotion({k: F.lit(v) for k, v in (high | x).items()})).values())
    assert [tier(), tier(quantity=True), tier(semantic=True), tier(split=True), tier(same_family=False), tier(same_family=False, unique_code=True, cross_product=True), tier(duplicate=False), tier(one_item=False, absent=True)] == [
        ("high", False), ("medium", False), ("not_candidate", True), ("not_candidate", True), ("not_candidate", False), ("medium", False), ("not_candidate", False), ("not_candidate", True),
    ]
    rows = spark.createDataFrame([(1, "w", "p", "o", True), (2, "w", "p", "x", True), (3, "w", None, None, True), (4, "w", "p", "x", False), (5, "v", "p", "o", True), (6, "u", "p", "o", True), (None, "w", "q", None, True)], "item long, own string, product string, option string, compares boolean")
    second = spark.createDataFrame([(1, None, "p", "o"), (2, None, "p", "o"), (3, None, "p", "o"), (4, None, "p", "o"), (5, None, "p", "o"), (5, None, "p", "o2"), (None, "w", "p", "o")], "item long, own string, product string, option string")
    assert {r.item: r.support for r in evidence.evidence_support(rows, second).collect()} == {1: "supported", 2: "conflict", 3: "relaxed", 4: "relaxed", 5: "incomplete", 6: "none", None: "conflict"}
    names = (*review.WORKBENCH_FLAGS, "duplicate_evidence", "direct", "same_target")
    flagged = [{"source_conflict": True, "absent_possible": True}, {"alias_conflict": True, "direct": True}, {}, {"warning": True, "same_target": True}, {"narrow_risk": True, "duplicate_sku": True}]
    rows = spark.createDataFrame([(k, 1, *(f.get(n) for n in names)) for k, f in enumerate(flagged)], "k long, n_items long, " + ", ".join(f"{n} boolean" for n in names))
    got = {r.k: (r.evidence_level, r.risk_type, r.reasons, r.action) for r in review.workbench(rows, ["k"]).collect()}
    assert got == {0: ("source_conflict", "source_conflict", "source_conflict,absent_possible", "classify_channel_absent_or_inactive"), 1: ("direct", "existing_conflict", "alias_conflict", "do_not_overwrite_existing_mapping"), 4: ("duplicate", "duplicate_sku", "duplicate_sku,narrow_risk", "compare_duplicate_candidates")}


def test_keys_that_repeat_fail(spark):
    table, twice = spark.createDataFrame([(1, "a")], "k long, v string"), spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    for change in (lambda: apply.upsert(table, twice, ["k"], []), lambda: apply.update_from(table, twice, ["k"], ["v"])):
        with pytest.raises(Exception, match="more than once"):
            change().collect()


def test_long_cells_stay_linear(spark):
    text = "\n".join(f"line {i}" for i in range(20_000))
    rows = spark.createDataFrame([(1, text, "head\n" + text, text)], "row long, c string, o string, s string")
    got = evidence.aligned_lines(rows, "row", "c", "o", "s").where("code = option and option = status").agg(F.count("*"), F.max("line_no")).first()
    assert tuple(got) == (20_000, 20_000)


def test_apply_protocol(spark, tmp_path):
    table = apply.VersionedTable(spark, f"{tmp_path}/t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert table.write(first) == 1
    change = lambda df: apply.upsert(df, spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string"), ["k"], [])
    _, version = apply.run(table, change, lambda b, a: apply.expect(a, {"rows": (F.count("*"), 3)}))
    assert version is None and table.versions() == [1]
    with pytest.raises(apply.GuardError):
        apply.run(table, change, lambda b, a: apply.expect(a, {"rows": (F.count("*"), 4)}), dry=False)
    after, version = apply.run(table, change, lambda b, a: apply.expect(a, {"rows": (F.count("*"), 3)}), dry=False)
    assert version == 2 and sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    again, _ = apply.run(table, change, lambda b, a: None)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))
    table.rollback(1)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")]


def test_decisions(spark, tmp_path):
    table = apply.VersionedTable(spark, f"{tmp_path}/q")
    events = "array<struct<action:string,before:string,after:string,reviewer:string,at:string>>"
    table.write(spark.createDataFrame([(1, "open", None, None, None), (2, "open", None, "S-0", None)], f"queue_id long, status string, reviewer string, sku_code string, events {events}"))
    service = apply.DecisionService(table, {"ann"})
    service.decide(1, "approve", "ann", "t0")
    service.link(1, "S-1", "ann", "t1")
    service.unlink(2, "ann", "t2")
    service.edit(2, " SKU_code ", "S-9", "ann", "t3")
    assert table.versions() == [1] and service.log().count() == 4
    assert sorted((r.queue_id, r.status, r.sku_code) for r in service.current().collect()) == [(1, "approve_match", "S-1"), (2, "open", "S-9")]
    assert service.compact() == 2 and service.log().count() == 0
    rows = {r.queue_id: r for r in service.current().collect()}
    assert [(e.action, e.before, e.after) for e in rows[1].events] == [("approve", "open", "approve_match"), ("link", None, "S-1")]
    assert [(e.action, e.before, e.after) for e in rows[2].events] == [("unlink", "S-0", None), ("edit", None, "S-9")]
    assert service.status("ann")["can_write"] and not service.status("bob")["can_write"] and not service.status(" ")["known"]
    for wrong in (lambda: service.discontinue(1, "bob", "t2"), lambda: service.decide(1, "hold", " ", "t2")):
        with pytest.raises(PermissionError):
            wrong()
    with pytest.raises(apply.GuardError):
        service.unlink(9, "ann", "t2")
    with pytest.raises(ValueError):
        service.edit(1, "status", "x", "ann", "t2")


def test_context_summary_and_json(spark, tmp_path):
    with apply.transaction(spark, read_only=True) as here:
        here.require(database=here.database, read_only=True)
        with pytest.raises(apply.GuardError, match="read_only is True"):
            here.require(read_only=False, user=here.user)
    cache = apply.VersionedTable(spark, f"{tmp_path}/s")
    summary = spark.createDataFrame([("{}",)], "summary string")
    assert apply.refresh_summary(cache, summary, "t0") == 1 and apply.refresh_summary(cache, summary, "t1") == 2
    assert tuple(cache.read().first()) == ("{}", True, "t1")
    with pytest.raises(apply.GuardError):
        apply.refresh_summary(cache, summary.union(summary), "t2")
    got = one(spark, a=apply.merge_json(F.lit('{"b":"1","c":null}'), {"a": F.lit(2), "b": F.lit(None).cast("string")}), b=apply.merge_json(F.lit(None), {"a": F.lit(None).cast("string")}, strip_nulls=False), c=apply.json_contains(F.lit('{"a":"1","b":"2"}'), {"a": "1"}), d=apply.json_contains(F.lit(None), {"a": "1"}))
    assert got == {"a": '{"a":"2"}', "b": '{"a":null}', "c": True, "d": False}


def test_more_shapes(spark):
    rows = spark.createDataFrame([(1, "s", "p"), (2, "s", "q"), (3, " ", "p"), (4, None, None), (5, "s", "p")], "id long, sku string, product string")
    got = {r.row: [] for r in relational.related_rows(rows, "id", ["sku", "product"]).collect()}
    for r in relational.related_rows(rows, "id", ["sku", "product"], most=2).orderBy("row", "other").collect():
        got[r.row].append(r.other)
    assert got == {1: [2, 3], 2: [1, 5], 3: [1, 5], 5: [1, 2]}
    from matchloom.functions import aggregates

    held = spark.createDataFrame([(2, "b"), (None, "z"), (1, None)], "k long, v string").agg(aggregates.ordered_array(F.col("v"), F.col("k")).alias("x")).first().x
    assert held == [None, "b", "z"]
    common = relational.most_common(spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string"), "v", 3)
    assert sorted((r.place, r.value, r.row_count) for r in common.collect()) == [(1, "c", 2), (2, None, 1), (3, "a", 1)]
    lists = spark.createDataFrame([([("1", "x"), None, ("2", "y")], [("1", "z"), ("3", "w")]), (None, [("1", "z")])], "a array<struct<id:string,name:string>>, b array<struct<id:string,name:string>>")
    merged = [[(x.id, x.name) for x in r.m] for r in lists.select(relational.merged_lists(["a", "b"], lambda t: t.id).alias("m")).collect()]
    assert merged == [[("1", "x"), ("2", "y"), ("3", "w")], [("1", "z")]]
    items = spark.createDataFrame([("i1", "c1", "p1"), ("i2", "c2", "p2"), ("i3", None, "p9")], "item string, code string, product string")
    images = spark.createDataFrame([("x", "c1", None, "by_code", False, 1), ("i1", None, None, "by_item", False, 5), (None, None, "p2", "late", True, 2), (None, None, "p2", "first", True, 1)], "item string, code string, product string, url string, is_primary boolean, sort_order int")
    best = relational.ranked_matches(items, "item", images, {"item": 0, "code": 1, "product": None}, [F.col("is_primary").desc(), F.col("sort_order"), F.col("url")], ["url"])
    assert {r.item: r.url for r in best.collect()} == {"i1": "by_item", "i2": "first", "i3": None}


def test_all_candidates_of_a_group_are_paired(spark):
    from matchloom import queries

    sf = "/root/testdata/sf0.001"
    part = queries.t(spark, sf, "part")
    want = part.groupBy("p_brand", "p_type").count().agg(F.sum(F.col("count") * (F.col("count") - 1))).first()[0]
    got = queries.token_score_rank(spark, sf)
    assert got.count() == want and "p_brand" in queries.SQL["token_score_rank"]
    rows = spark.range(90).select("id", (F.col("id") % 2).alias("k"))
    others = rows.select(F.col("id").alias("other"), "k")
    pairs, dealt = codes.candidate_pairs(rows, others, ["k"], "id", pairs=100)
    assert dealt == ["k", "_deal"] and pairs.select("_deal").distinct().count() > 10
    assert sorted((r.id, r.other) for r in pairs.collect()) == [(a, b) for a in range(90) for b in range(a % 2, 90, 2)]
    ranked = codes.rank_candidates(pairs.withColumn("score", F.lit(1)), "id", "other", dealt=dealt)
    above = ranked._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "Window" in above and "Exchange" not in above  # no pair is moved


def test_rows_that_are_alike_share_a_ranking(spark, tmp_path, monkeypatch):
    """Copies of a table with other keys make far fewer scored pairs than rows are given back, and no ranking moves a pair."""
    from matchloom import queries

    part = queries.t(spark, "/root/testdata/sf0.001", "part")
    part.crossJoin(spark.range(24)).withColumn("p_partkey", F.col("p_partkey") + 60_000 * F.col("id")).drop("id").write.parquet(f"{tmp_path}/part.parquet")
    made, real = [], codes.candidate_pairs
    monkeypatch.setattr(codes, "candidate_pairs", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    got = queries.token_score_rank(spark, str(tmp_path))
    above = got._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0].split("BroadcastHashJoin")[0].split("ShuffledHashJoin")[0]
    assert "Window" in above and "Exchange" not in above
    sizes = part.groupBy("p_brand", "p_type").agg((F.count("*") * 24).alias("n"))
    assert got.count() == sizes.agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] > 100 * sum(pairs.count() for pairs, _ in made)
    assert got.groupBy("row_id").agg(F.max("candidate_rank").alias("n"), F.count("*").alias("m"), F.count_distinct("candidate").alias("d")).where("n != m or d != m").count() == 0


@pytest.mark.parametrize("ids", ["once", "repeated"])
def test_shared_rankings_are_each_rows_own(spark, ids):
    """Against pairs of single rows: null ids, keys and values, groups of one row, kinds in several rows, rankings in several pieces, and ids that stand in one group or two."""
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", "xy", "z", None]), rng.choice([1, 2, None])) for i in rng.sample(range(-500, 500), 90)]
    rows += [(1000, "alone", "x", 1), (None, "a", "x", 1), (None, "a", "x", 1), *((2000 + i, "c", "x", 1) for i in range(25)), (3000, "two", "x", 1), (3001, "two", "z", 1)]
    if ids == "repeated":
        rows += [rows[0], rows[0], (rows[1][0], "b", "z", 2), (2003, "c", "xy", None), (3000, "one", "x", 1), (3002, "one", "q", 1)]
    table = spark.createDataFrame(rows, "id long, k string, t string, n int")
    score = F.when(F.col("t").eqNullSafe(F.col("c_t")), 3).otherwise(0) + F.when(F.contains("c_t", "t"), 2).otherwise(0) + F.when(F.col("n") == F.col("c_n"), 1).otherwise(0)
    other = table.toDF("other", "k", "c_t", "c_n")
    want = codes.rank_candidates(table.join(other, "k").where("id != other").select("id", "other", score.alias("score")), "id", "other")
    got = codes.ranked_within(table, ["k"], "id", "other", score, band=4)
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert codes.ranked_within(table.limit(0), ["k"], "id", "other", score).count() == 0


def test_related_lists_dont_make_pairs(spark):
    """Lists of a key's first rows are joined and merged, so the first of a key count each id once and no pair is a row before it is given back."""
    rows = spark.range(400).select(F.pmod("id", F.lit(300)).alias("id"), F.when(F.col("id") % 3 != 0, (F.col("id") % 5).cast("string")).alias("a"), F.when(F.col("id") % 4 != 0, F.concat(F.lit(" "), (F.col("id") % 11).cast("string"))).alias("b"))
    rows = rows.union(spark.range(50).select(F.lit(7), F.lit("9"), F.lit(None))).union(spark.createDataFrame([(900, "9", " "), (901, "9", None), (None, "9", None)], rows.schema))
    held = [r for r in rows.collect() if r.id is not None]
    for most in (1, 6, 80, None):
        want = {}
        for r in held:
            own = want.setdefault(r.id, set())
            own |= {o.id for o in held if o.id != r.id and any(x and y and x.strip() and x.strip() == y.strip() for x, y in ((r.a, o.a), (r.b, o.b)))}
        want = sorted((r, o) for r, own in want.items() for o in sorted(own)[:most])
        got = relational.related_rows(rows, "id", ["a", "b"], most)
        assert sorted((r.row, r.other) for r in got.collect()) == want
    plan = relational.related_rows(rows, "id", ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan[: plan.index("Union")] and "Window" not in plan[: plan.index("Union")]


def test_matches_dont_grow_with_a_hot_key(spark):
    """Each row meets one other for each set of keys, and the best is still the one that all pairs give."""
    keys, order = {"a": 0, "b": 1, "c": None, "d": None}, [F.col("place").desc_nulls_last(), F.col("n")]
    made = lambda n, seed: spark.range(n).select(F.col("id").alias("n"), *(F.when(F.pmod(F.xxhash64("id", F.lit(seed + i)), F.lit(2)) != 0, F.pmod(F.xxhash64("id", F.lit(seed + 10 + i)), F.lit(3 + i))).alias(k) for i, k in enumerate(keys)), F.nullif(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(5)), F.lit(0)).alias("place"))
    rows, others = made(60, 1).select(F.col("n").alias("row"), *keys), made(40, 50)
    held = [r.asDict() for r in others.collect()]
    want = {}
    for r in rows.collect():
        met = [o for o in held if any(r[k] is not None and r[k] == o[k] for k in keys)]
        best = min(met, key=lambda o: (*(r[k] is None or r[k] != o[k] for k in "ab"), o["place"] is None, -(o["place"] or 0), o["n"]), default=None)
        want[r.row] = best and best["n"]
    got = relational.ranked_matches(rows, "row", others, keys, order, ["n"])
    assert {r.row: r.n for r in got.collect()} == want and None in want.values()
    hot = relational.ranked_matches(spark.range(3000).select("id", F.lit(1).alias("a")), "id", spark.range(3000).select(F.col("id").alias("n"), F.lit(1).alias("a")), {"a": 0}, [F.col("n")], ["n"])
    assert hot.where("n = 0").count() == 3000
    # others are ranked before the join, which made 9,000,000 pairs
    text = hot._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in text[text.index("Join Inner") :]


def test_queue_filter(spark):
    rows = spark.createDataFrame([(1, "a", "REVIEW", "STOCK_DIFF", "hold", ["x", "y"], True, "Blue Ring"), (2, "a", "REVIEW", "STOCK_MATCH", "stock_match", ["x"], False, None), (3, "b", "NO_MATCH", None, "no_match", None, True, "red")], "k long, channel string, tier string, stock string, bucket string, tag_names array<string>, has_image boolean, name string")
    ids = lambda channels=("a", "b"), **x: [r.k for r in review.queue_filter(rows, list(channels), columns=("k", "name"), **x).orderBy("k").collect()]
    assert [ids(), ids(["a"]), ids([]), ids(tier="REVIEW"), ids(stock="STOCK_DIFF"), ids(bucket="stock_diff"), ids(bucket="hold"), ids(mode="problem"), ids(mode="candidate"), ids(tags=("x",)), ids(tags=("x", "y")), ids(image_only=True), ids(text=" BLUE "), ids(text="3 RED")] == [
        [1, 2, 3], [1, 2], [], [1, 2], [1], [1], [1], [1, 3], [2], [1, 2], [1], [1, 3], [1], [3],
    ]
    rows = rows.withColumns({"left_out": F.when(F.col("k") == 1, True), "bucket": F.when(F.col("k") == 3, "excluded").otherwise(F.col("bucket"))})
    assert [ids(hide_excluded=True), ids(exclusions="hide"), ids(exclusions="only"), ids(exclusions="hide", hide_excluded=True), ids(bucket="excluded")] == [[1, 2], [2, 3], [1], [2], [3]]


def test_code_letters_and_loose_codes(spark):
    found = lambda a, b="": one(spark, x=codes.extract_code(F.lit(None).cast("string"), F.lit(a), F.lit(b)))["x"]
    assert [found(x).code for x in ("[ab-1-2]", "[ABCDEFG-1-2]", "[aBc-1-2_3]", "[abcdefgh-1-2-3]", "[A1-1-2]", "[-1-2]", "ab-1-2-3")] == ["ab-1-2", "ABCDEFG-1-2", "aBc-1-2_3", "abcdefgh-1-2-3", None, None, None]
    assert found("x abcdefgh-1-2-3").loose == "abcdefgh-1-2-3"
    reason = lambda key, matched, loose: one(spark, x=codes.classify_match(F.lit(key), F.lit(matched), F.lit(0), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("string"), loose=F.lit(loose).cast("boolean")))["x"]
    assert [reason("k", False, True), reason("k", False, None), reason("k", True, True), reason(" ", False, True)] == ["loose_only", "pattern_unmatched", "not_in_alias", "null_key"]
    assert one(spark, x=review.workflow_bucket(F.lit("no_match"), [F.lit("")], F.lit(None), "summary"))["x"] == "hold"


def test_long_lists_merge_in_order(spark):
    rows = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(59_999)), lambda i: F.struct((i % 20_000).cast("string").alias("id"), i.alias("n"))).alias("a"), F.lit(None).cast("array<struct<id:string,n:int>>").alias("b"))
    got = rows.select(relational.merged_lists(["a", "b"], lambda x: x.id).alias("m")).first().m
    assert [x.n for x in got] == list(range(20_000))
    tags = "array<struct<tag_id:long,tag_name:string,tag_scope:string,assignment_id:string>>"
    rows = spark.createDataFrame([("g", 2, [(1, "a", None, None), None]), ("g", 1, [(None, "x", "s", "1"), (None, "x", "s", "2")]), ("g", 3, [(1, "other", "", None), (None, "x", "s", "1")]), ("h", 4, None)], f"g string, o long, t {tags}").withColumns({"c": F.lit("c"), "d": F.lit(1)})
    got = {r.g: [(t.tag_id, t.assignment_id) for t in r.shared_tags] for r in review.group_matrix(rows, ["g"], "c", "o", F.lit(True), "d", ["c"], shared_tags="t").collect()}
    assert got == {"g": [(None, "1"), (None, "2"), (1, None)], "h": []}


def test_encodings_and_integrity(spark, tmp_path):
    (tmp_path / "k.csv").write_bytes("이름,값\n가나,1\n".encode("cp949"))
    (tmp_path / "u.csv").write_bytes("\ufeff이름,값\n가나,1\n".encode())
    (tmp_path / "bad.csv").write_bytes(b"a\n\xff\xff\n")
    for name, encoding in (("k", "cp949"), ("u", "utf-8-sig")):
        got, used = files.read_csv_any(spark, f"{tmp_path}/{name}.csv")
        assert used == encoding and got.columns == ["이름", "값"] and got.first()[0] == "가나"
    with pytest.raises(ValueError):
        files.read_csv_any(spark, f"{tmp_path}/bad.csv")
    rows = spark.createDataFrame([("p1", "1", "C", "x", ""), ("p1", "1", " ", "[AB-1-2]", "y [AB-1-2]"), ("p2", "1", None, None, "[CD-1-2]"), (None, "", "", "", "z")], "product_uid string, sto_id string, sto_code string, opt_value string, opt_values string")
    got = {r.metric: r.value for r in files.csv_integrity(rows, codes.BRACKET).collect()}
    assert len(got) == 17 and [got[k] for k in ("row_count", "product_uid_distinct", "product_uid_blank_rows", "sto_code_blank_rows", "opt_value_bracket_hits", "opt_values_bracket_unique_codes", "own_sku_candidate_resolvable", "sto_id_duplicate_keys", "sto_id_duplicate_rows", "product_sto_duplicate_keys", "product_sto_duplicate_rows")] == [4, 2, 1, 3, 1, 2, 3, 1, 3, 1, 2]
    (tmp_path / "m.json").write_text('{"rows": [{"no": " 1 ", "code": "a", "qty": 1}, {"no": "1", "code": "a", "qty": 2}, {"no": "", "code": "b", "qty": 3}]}')
    held = files.keyed_rows(files.read_json_rows(spark, f"{tmp_path}/m.json", "no string, code string, qty long"), ["no", "code"], "row_no").collect()
    assert [(r.apply_key, r.qty) for r in held] == [("1|a", 2)]
    sheet = spark.createDataFrame([("f", "s", 1, ["A", "B"]), ("f", "s", 2, ["1", "2"]), ("f", "t", 2, ["3"])], "path string, sheet string, row_no long, cells array<string>")
    assert tuple(files.table_facts(sheet).first()) == ("f", 3, 2, 2)
    assert [tuple(r)[3:] for r in files.with_header(sheet.where("sheet = 's'"), {"x": ["b"], "y": ["nope"]}, fixed={"y": 0, "z": 7}).collect()] == [("2", "1", None)]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿Code,Name\nA-1,"x ""y""\nz"\n , \nB,\n'.encode())
    got = files.read_csv(spark, f"{tmp_path}/a.csv")
    assert got.columns == ["Code", "Name"] and got.count() == 2 and got.first().Name == 'x "y"\nz'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook><sheets><sheet name="S"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>Code No</t></si><si><t>v1</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>B</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>7</v></c></row></sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(book.getvalue())
    rows = files.with_header(files.read_sheets(spark, f"{tmp_path}/b.xlsx"), {"code": ["codeno"], "qty": ["x", " b "], "none": ["zzz"]})
    assert [tuple(r)[2:] for r in rows.collect()] == [(2, "v1", "7", None)]
    xml = b'<Workbook xmlns:ss="urn"><Worksheet ss:Name="W"><Table><Row><Cell><Data>a</Data></Cell><Cell ss:Index="3"><Data>c</Data></Cell></Row><Row/><Row><Cell><Data>d</Data></Cell></Row></Table></Worksheet></Workbook>'
    assert list(files.spreadsheetml_rows(xml)) == [("W", 1, ["a", "", "c"]), ("W", 3, ["d"])]
    known = files.file_registry(spark, f"{tmp_path}/a.csv")
    assert known.count() == 1 and files.file_registry(spark, f"{tmp_path}/a.csv", known).count() == 0
    with pytest.raises(ValueError):
        files.require(known, ["nope"])


ROW = "row long, item_code string, own_code string, product_no string, raw_option string, plain_option string, name string, warning string, status string"


def validated(spark, rows):
    alias = spark.createDataFrame([("c1", 1), ("c2", 2), ("c2", 3)], "value string, target long")
    own = spark.createDataFrame([("w1", 1), ("w9", 9)], "value string, target long")
    catalog = spark.createDataFrame([(1, "Ring A", "로즈골드", ["n1"]), (2, None, None, None)], "target long, item_name string, item_option string, product_nos array<string>")
    return {r.row: (r.item, r.blocked, r.tier) for r in validation.evidence_validation(spark.createDataFrame(rows, ROW + ", tier string"), alias, own, catalog).collect()}


def test_option_key(spark):
    texts = ["Rose  Gold", "RG", "핑크골드(주문제작)", "14K 골드", "One Type", "10mm바", "[x]", "", None]
    assert [one(spark, k=validation.option_key(F.lit(x).cast("string")))["k"] for x in texts] == ["rosegold", "rosegold", "rosegold", "yellowgold", "onetype", "10mm", "x", "", ""]


def test_evidence_validation(spark):
    rows = [
        (1, "c1", "w1", "n1", "rose gold", None, "ring-a", None, "ok", "x"), (2, "c2", None, None, "red", None, None, None, None, None), (3, "c1", "w9", "n1", "핑골", None, "Other", "ab?", None, None),
        (4, None, None, "n9", "red", None, None, None, "odd", None), (5, "zz", None, "n8", "blue", None, None, None, "", None), (6, None, None, None, None, None, None, None, None, None), (7, None, None, None, "[a", "크리스탈AB", None, None, None, None),
    ]
    assert validated(spark, rows) == {
        1: (1, "", "high"), 2: (None, "duplicate_item", "blocked_risk"), 3: (1, "ab_token,own_code,name", "blocked_risk"), 4: (None, "", "parse_warning"), 5: (None, "", "parse_good"), 6: (None, "", "manual"), 7: (None, "crystal,bracket", "blocked_risk"),
    }
    assert validated(spark, rows[:1] * 2) == {1: (1, "", "high")}  # a repeated row changes nothing
    assert validated(spark, [(1, "c1", None, "n1", "rose gold", None, None, None, None, None), (2, "c1", None, "n2", "rose gold", None, None, None, None, None)])[1] == (1, "duplicate_item", "blocked_risk")


def test_narrow_risk_and_impact(spark):
    rows = spark.createDataFrame([("p", "크리스탈AB"), ("p", "크리스탈"), ("p", "x 1+1"), (None, "크리스탈"), ("q", None), ("q", "SET")], "product string, text string")
    got = {(r.product, r.text): (r.narrow, r.clean) for r in validation.narrow_risk(rows, "product", "text").collect()}
    assert got[("p", "x 1+1")] == ("one_plus_one,variant_conflict", False) and got[(None, "크리스탈")] == ("", True) and got[("q", None)] == ("", True) and got[("q", "SET")][0] == "set_or_quantity" and len(got) == 6
    rows = spark.createDataFrame([("c", 1, "P", "O1", "w", "red one", "RED"), ("c", 2, "P", "O2", "w", "red", "red x"), ("c", 3, None, None, None, None, None), ("c", 4, "Q", "O", "w", "blue-ab", "blue")], "channel string, item long, product_code string, option_code string, own_code string, option string, channel_option string")
    out = validation.option_impact(rows, [("c", "red", "token"), ("c", "blue", "contains")], mixed=("blueab", "blue", "ab"))
    got = {r.item: (r.rule, r.before, r.after, r.candidate, r.ambiguous, r.manual) for r in out.collect()}
    assert got == {1: ("red", False, True, True, True, False), 2: ("red", False, True, True, True, False), 3: ("raw_text", False, False, False, False, True), 4: ("blue", False, True, True, True, False)}


def test_presence_rates(spark):
    names = ["n_alias", "n_confirmed", "n_candidate", "alias_products", "alias_options", "n_mapping", "n_identity", "mapping_products", "mapping_options", "mapping_owns", "fan_out", "n_images"]
    rows = [dict.fromkeys(names, None), dict.fromkeys(names, 0) | {"n_images": 2}, dict.fromkeys(names, 1), dict.fromkeys(names, 0) | {"n_alias": 1, "n_candidate": 1, "fan_out": 2}, dict.fromkeys(names, 0) | {"n_alias": 1}]
    df = spark.createDataFrame([tuple(r[k] for k in names) for r in rows], ", ".join(f"{k} long" for k in names))
    df = df.withColumn("s", evidence.presence_from_counts(df)).withColumn("c", F.lit("one"))
    assert [r.s for r in df.collect()] == ["absent", "unknown", "confirmed", "blocked", "manual"]
    got = {r.type: (r.row_count, r.rate) for r in evidence.presence_rates(df, "c", "s").collect()}
    assert got["total_rows"] == (5, None) and got["match_rate_of_present"] == (None, 25.0) and got["absent_rate_of_total"] == (None, 20.0) and sum(n for k, (n, _) in got.items() if n and k[:5] not in ("total", "prese")) == 5
    assert evidence.presence_rates(df.limit(0), "c", "s").count() == 0


def test_review_queue(spark):
    items = spark.createDataFrame([(1, "w", 1), (2, None, 1), (3, "w", None)], "item long, own_code string, n_images long")
    mapping = spark.createDataFrame([("a", 1, False, "p0", "o0"), ("a", 1, True, "p", "o"), ("b", 1, None, "p", None), ("z", 1, True, "p", "o")], "channel string, item long, is_primary boolean, product_code string, option_code string")
    mapping = mapping.select("*", *(F.lit(None).cast("string").alias(c) for c in ("product_candidate", "option_candidate", "own_code")))
    got = {(r.channel, r.item): r.reason for r in queue.review_queue(items, mapping, {"a": queue.QueuePolicy(), "b": queue.QueuePolicy(missing_if="all")}).collect()}
    assert got == {("b", 1): "review_required", ("a", 2): "own_code_missing", ("b", 2): "own_code_missing", ("a", 3): "image_missing", ("b", 3): "image_missing"}


def test_lookup(spark):
    items = spark.createDataFrame([("1", "P"), ("2", "P"), ("3", None)], "item string, product string")
    alias = spark.createDataFrame([("ITEM", "1", "own", "S", False), ("ITEM", "1", "own", "A", True), ("ITEM", "1", "own", "S", False), ("PRODUCT", "P", "own", "S", None), ("ITEM", "3", "other", "S", True)], "kind string, target string, system string, value string, is_primary boolean")
    images = spark.createDataFrame([("1", "u2", None, 2), ("1", "u1", None, 1), ("9", "u", True, 1)], "item string, url string, is_primary boolean, sort_order long")
    got = sorted(tuple(r) for r in lookup.code_lookup(items, alias, images, "own", "S").collect())
    assert got == [("1", "P", "S", "u1", "item"), ("2", "P", None, None, "product")]
    rows = spark.createDataFrame([(1, None, "Abc"), (1, None, "Abc"), (2, "xaB", "q"), (3, None, None)], "id long, a string, b string")
    assert sorted(map(tuple, lookup.text_search("ab", [("k", rows, "id", ["a", "b"]), ("other", rows, "id", ["a"])], {"k"}).collect())) == [("k", "1", "Abc"), ("k", "2", "xaB")]
    with pytest.raises(ValueError):
        lookup.text_search("ab", [], None)


def test_insert_classes(spark):
    rows = spark.createDataFrame([("a", "1", True), ("b", "1", None), (" ", "1", True), ("c", None, True), ("d", "x", True), ("e", "7", True), ("f", "1", True), ("f", "1", True), ("g", "1", True), ("h", "1", True)], "code string, item string, ok boolean")
    existing, master = spark.createDataFrame([("g", "1"), ("g", "1"), ("h", "2")], "code string, item string"), spark.createDataFrame([("1",), ("1",)], "item string")
    got = sorted((r.code, r.apply_class) for r in changes.insert_classes(rows, existing, master, {"ok": F.col("ok")}, "^[0-9]$").collect())
    assert got == [(" ", "null_code"), ("a", "insert"), ("b", "ok"), ("c", "blank_item"), ("d", "invalid_item"), ("e", "missing_item"), ("f", "duplicate_source"), ("f", "duplicate_source"), ("g", "idempotent_existing"), ("h", "conflict_existing")]
    table = spark.createDataFrame([(1, "a")], "k long, v string")
    assert sorted(map(tuple, changes.insert_by_plan(table, spark.createDataFrame([("2", "q"), ("x", "r")], "k string, extra string")).collect()), key=str) == [(1, "a"), (2, None), (None, None)]


def test_change_requests(spark, tmp_path):
    target, table = apply.VersionedTable(spark, f"{tmp_path}/t"), apply.VersionedTable(spark, f"{tmp_path}/r")
    target.write(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k long, v string, n int"))
    requests, ids = changes.ChangeRequests(table), lambda *x: spark.createDataFrame([(i,) for i in x], "request_id string")
    new = lambda *x: spark.createDataFrame(list(x), "request_id string, kind string, target_key string, field string, value string")
    requests.draft(new(("r1", "sku_update", "1", "v", "c"), ("r2", "sku_update", "1", "n", "9"), ("r3", "sku_update", "2", "v", "z")), "ann", "t0")
    for bad in (new(("r1", "sku_update", "1", "v", "c")), new(("r9", "odd", "1", "v", "c")), new(("r8", "sku_update", "1", "v", "c"), ("r8", "sku_update", "1", "v", "d"))):
        with pytest.raises(apply.GuardError):
            requests.draft(bad, "ann", "t0")
    for action, which in (("approve", ids("r1")), ("submit", ids("r1", "nope"))):
        with pytest.raises(apply.GuardError):
            requests.move(which, action, "ann", "t1")
    requests.move(ids("r1", "r2", "r3"), "submit", "ann", "t1")
    requests.move(ids("r3"), "reject", "bob", "t2")
    requests.move(ids("r1", "r2"), "approve", "bob", "t2")
    with pytest.raises(apply.GuardError):
        requests.apply(target, "k", ("v",), "bob", "t3")
    requests.apply(target, "k", ("v", "n"), "bob", "t3")
    assert sorted(map(tuple, target.read().collect())) == [(1, "c", 9), (2, "b", 6)]
    got = {r.request_id: (r.state, [e.action for e in r.events]) for r in table.read().collect()}
    assert got == {"r1": ("applied", ["draft", "submit", "approve", "apply"]), "r2": ("applied", ["draft", "submit", "approve", "apply"]), "r3": ("rejected", ["draft", "submit", "reject"])}
    with pytest.raises(apply.GuardError):
        requests.move(ids("r1"), "cancel", "ann", "t4")


def test_export_check(spark):
    rows = spark.createDataFrame([(1, "5", "https://a.b/c"), (2, "0", "x y"), (3, None, None), (4, "NaN", "p.JPG"), (5, " ", "http://")], "k long, price string, image string")
    rules = {"INVALID_PRICE": export_rules.bad_number(F.col("price"), 0, 100, above=True), "INVALID_IMAGE_REFERENCE": export_rules.bad_reference(F.col("image")), "PRICE_PRIORITY_UNCONFIRMED": F.col("price").isNull()}
    got = {r.k: (r.blockers, r.warnings, r.state) for r in export_rules.export_check(rows, rules).collect()}
    assert got == {1: ("", "", "ready"), 2: ("INVALID_PRICE,INVALID_IMAGE_REFERENCE", "", "blocked"), 3: ("", "PRICE_PRIORITY_UNCONFIRMED", "warning"), 4: ("INVALID_PRICE", "", "blocked"), 5: ("INVALID_IMAGE_REFERENCE", "", "blocked")}
    assert len(export_rules.BLOCKERS) + len(export_rules.WARNINGS) == 28
    with pytest.raises(ValueError):
        export_rules.export_check(rows, {"NOPE": F.lit(True)})


def test_inventory(spark):
    tables = {"a": spark.createDataFrame([(1, "x")], "k long, v string"), "b": spark.range(3)}
    assert sorted(map(tuple, inventory.row_counts(tables).collect())) == [("a", 1, 2), ("b", 3, 1)]
    assert inventory.columns(spark, tables).count() == 3 and inventory.missing(tables, {"a": ["k", "q"], "c": ["z"]}) == ["a.q", "c"]


def test_line_evidence(spark):
    schema = "row long, channel string, product_code string, codes string, options string, statuses string, sale_status string, warning string"
    rows = [(1, "shop", "p", "a\r\nb", "head\nx\n ", "Y\nN", "판매중", "clash"), (2, None, " ", "a\n\nzz", "x", "Y", None, None), (3, "shop", "p", None, None, None, "판매대기", None), (4, "shop", "p", "a", "x", "Y", "판매중", None)]
    out = evidence.line_evidence(spark.createDataFrame(rows, schema), spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "code string"))
    got = {(r.row, r.line_no): (r.code, r.option, r.status, r.alignment, r.sale_state, r.option_state, r.active, r.warning) for r in out.collect()}
    assert got == {
        (1, 1): ("a", "x", "Y", "header", "active", "active", True, ""), (1, 2): ("b", None, "N", "header", "active", "inactive", False, "no_option"), (2, 1): ("a", "x", None, "needs_review", "needs_review", "needs_review", False, "unknown_channel; no_product_code; line_count"),
        (2, 2): (None, None, None, "needs_review", "needs_review", "needs_review", False, "unknown_channel; no_product_code; no_code; no_option; line_count; not_in_dictionary"),
        (2, 3): ("zz", None, None, "needs_review", "needs_review", "needs_review", False, "unknown_channel; no_product_code; no_option; line_count; not_in_dictionary"),
        (3, 1): (None, None, None, "direct", "inactive", "needs_review", False, "no_code; no_option; not_in_dictionary"), (4, 1): ("a", "x", "Y", "direct", "active", "active", True, ""),
    }


def test_weak_candidates(spark):
    names = "product code item option_id aliases option item_option name item_name score n_candidates".split()
    good = ("p", "c1", "i", "07", "X-007|Y-2", "Red [x] 1", "red", "Ring red 반지", "red 반지", "70", "3")
    rows = [good, ("p", "c2", "i", "3", "X-003", "blue", "BLUE", "a", None, " 99 ", "1"), ("q", "d", None, "", None, None, "x", None, "red", "7.5", ""), ("q", "d", "i", "x", "X", "a", "b", None, None, None, None), (None, None, "i", "1", "X-1", "a", "a", None, None, "80", "1")]
    out = weak.weak_candidates(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)))
    got = [(r.code, r.primary_no, r.overlap, r.failed, r.strong, r.n_group, r.group_ratio, r.group_consistent) for r in out.orderBy("code", "item").collect()]
    assert got == [
        (None, "1", 0, "code_blank,code_not_single", False, 1, 1.0, False), ("c1", "7", 1, "", True, 2, 1.0, True), ("c2", "3", 0, "", True, 2, 1.0, True),
        ("d", None, 0, "score,candidates,option_no,option_text,item_blank,code_not_single", False, 2, 0.0, False), ("d", None, 0, "score,candidates,option_no,option_text,code_not_single", False, 2, 0.0, False),
    ]
    groups = {r.product: (r.n_group, r.n_strong, r.least_option, r.greatest_option, r.names) for r in weak.weak_groups(out).collect()}
    assert groups == {"p": (2, 2, 3, 7, "Ring red 반지 | a"), "q": (2, 0, 0, 0, ""), None: (1, 0, 1, 1, "")}


def test_review_predicates_and_light_queue(spark):
    null = F.lit(None)
    args = lambda **k: [k.get(n, null.cast(kind)) for n, kind in (("tier", "string"), ("policy", "string"), ("bucket", "string"))] + [[k.get("text", null.cast("string"))], k.get("dup", null.cast("int")), k.get("linked", null.cast("boolean")), k.get("unlinked", null.cast("boolean")), k.get("gone", null.cast("boolean")), k.get("required", null.cast("boolean"))]
    of = lambda **k: {n for n, v in one(spark, **review.review_predicates(*args(**k))).items() if v}
    yes = F.lit(True)
    assert of() == {"needs_linking", "pending"} and of(linked=yes) == {"pending"} and of(linked=yes, tier=F.lit("FAST_REVIEW")) == {"auto", "fast"}
    assert of(linked=yes, policy=F.lit("AUTO_APPROVE_CANDIDATE"), dup=F.lit(2)) == {"auto", "conflict", "pending"} and of(linked=yes, unlinked=yes) == {"needs_linking"} and of(gone=yes) == {"needs_linking"}
    assert of(linked=yes, text=F.lit("자동승인"), required=yes) == {"auto", "pending"}
    risky = one(spark, **review.review_predicates(*args(linked=yes), risk=F.lit("중복 auto-approve"), label=F.lit("fast-review conflict")))
    assert risky["conflict"] and risky["fast"] and not risky["auto"]
    assert not one(spark, **review.review_predicates(*args(linked=yes), label=F.lit("conflict")))["conflict"]
    rows = spark.createDataFrame([(1, "NO_MATCH", None, None), (2, None, None, None), (3, "AUTO", "STOCK_HOLD_REVIEW", False), (4, "MANUAL_LINKED", "x", None), (5, "AUTO", None, True), (6, "AUTO", None, False)], "k long, tier string, stock string, required boolean")
    got = {r.k: (r.queue_priority, r.search_text) for r in review.light_queue(rows, "tier", "stock", "required", ["tier", "stock"]).collect()}
    assert got == {1: (10, "NO_MATCH"), 3: (20, "AUTO STOCK_HOLD_REVIEW"), 4: (90, "MANUAL_LINKED x"), 5: (50, "AUTO")}


def test_tag_targets(spark):
    ups = "upload long, tags string, scope string, product string, item string, channel string, channel_product string, channel_option string"
    rows = [(1, "a, b;a", None, None, "AB-1", None, None, None), (2, "c\nd", "상품", None, " ", "x", "p1", None), (3, "e", None, None, None, "x", None, None), (4, "f", None, None, None, "zz", None, None), (5, "g", None, None, None, None, None, None), (6, " ;", None, "AB", None, None, None, None), (7, None, None, "AB", None, None, None, None)]
    queue_rows = [("x", "p1", "o1", None, "AB-2"), ("x", "p1", "o2", "AB", "AB-2"), ("x", "p2", "o3", "CD", None), ("zz", "p", "o", None, None)]
    out = review.tag_targets(spark.createDataFrame(rows, ups), spark.createDataFrame(queue_rows, "channel string, channel_product string, channel_option string, product string, item string"))
    got = sorted((r.upload, r.tag, r.scope, r.product, r.item, r.match) for r in out.collect())
    assert got == [(1, "a", "option", "AB", "AB-1", "direct"), (1, "b", "option", "AB", "AB-1", "direct"), (2, "c", "product", "AB", "AB-2", "seller_resolved"), (2, "d", "product", "AB", "AB-2", "seller_resolved"), (3, "e", "product", None, None, "multiple_targets"), (4, "f", "product", None, None, "not_found"), (5, "g", "product", None, None, "multiple_targets")]
