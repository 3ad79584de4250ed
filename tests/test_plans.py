"""Guarded writes, keyed tables with before-images, ordered tables."""

import os

import pytest
from pyspark.sql import functions as F

from matchloom.operators import evidence, options, relational
from matchloom.plans import apply, json_values, keyed, ordered, summary


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_counts_are_taken_in_the_write(spark, tmp_path):
    table = apply.VersionedTable(spark, f"{tmp_path}/t")
    rows = spark.range(0, 1000, 1, 7)
    assert table.write(rows, {"n": (F.count("*"), 1000), "even": (F.count_if(F.col("id") % 2 == 0), 500)}) == 1
    with pytest.raises(apply.GuardError, match="n is 1000, not 999.*odd is 500, not 1"):
        table.write(rows, {"n": (F.count("*"), 999), "odd": (F.count_if(F.col("id") % 2 == 1), 1)})
    assert table.versions() == [1] and not os.path.exists(f"{tmp_path}/t/v2")
    with apply.transaction(spark, read_only=True):
        with pytest.raises(apply.GuardError, match="read_only"):
            table.write(rows)
        with pytest.raises(apply.GuardError):
            with apply.transaction(spark, read_only=False):
                pass
        with pytest.raises(apply.GuardError):
            apply.refresh_summary(table, rows.limit(1), "t")
        with pytest.raises(apply.GuardError):
            apply.DecisionService(table, None).decide(1, "approve", "x", "t")
    assert table.write(rows.limit(0), {"n": (F.count("*"), 0)}) == 2 and table.read().count() == 0
    assert table.rollback(1) == 3 and table.read().count() == 1000
    after, version = apply.run(table, lambda df: df.where("id < 10"), lambda a, b: None, dry=False, metrics={"n": (F.count("*"), 10)})
    assert version == 4 and after.count() == 10
    assert apply.RunContext.of(spark).read_only is False


SCHEMA = "k long, a string, b string"


def made(spark, tmp_path, n=200, buckets=16):
    table = keyed.KeyedTable(spark, f"{tmp_path}/k")
    table.create(spark.createDataFrame([(i, f"a{i}", None if i % 3 else "b") for i in range(n)] + [(None, "null key", "b")], SCHEMA), ["k"], buckets)
    return table


def files(tmp_path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{tmp_path}/k/data") for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = made(spark, tmp_path)
    first, before = rows_of(table.read()), files(tmp_path)
    assert len(before) == 16 and len(first) == 201
    table.update(spark.createDataFrame([(5, "x", "y")], SCHEMA), ["a"], expected=1)
    assert len(files(tmp_path) - before) == 1 and before < files(tmp_path)
    assert {r.k: r.a for r in table.read().collect()}[5] == "x" and rows_of(table.read(1)) == first
    changed = [f for b, f in table.manifest().get("folders").items() if f != table.manifest(1)["folders"][b]]
    assert len(changed) == 1
    assert [r.a for r in table.lookup(spark.createDataFrame([(5,), (None,), (77777,)], "k long")).orderBy("k").collect()] == ["null key", "x"]
    plan = table.lookup(spark.createDataFrame([(5,)], "k long"))
    assert len(plan.inputFiles()) == 1


def test_keyed_changes(spark, tmp_path):
    table = made(spark, tmp_path)
    want = {r.k: (r.a, r.b) for r in table.read().collect()}
    table.upsert(spark.createDataFrame([(1, "new", "B"), (1000, "added", "B"), (None, "n", "B")], SCHEMA), keep=("b",), expected=3)
    want |= {1: ("new", None), 1000: ("added", "B"), None: ("n", "b")}
    table.insert(spark.createDataFrame([(1, "no", "no"), (1001, "yes", None), (None, "no", "no")], SCHEMA), expected=1)
    want |= {1001: ("yes", None)}
    table.update(spark.createDataFrame([(2, None, "set"), (5555, "nobody", "")], SCHEMA), ["a", "b"])
    want |= {2: (None, "set")}
    table.delete(spark.createDataFrame([(3,), (4,), (None,), (9999,)], "k long"), expected=3)
    for k in (3, 4, None):
        del want[k]
    assert {r.k: (r.a, r.b) for r in table.read().collect()} == want and table.read().count() == len(want)
    at = table.versions()[-1]
    for wrong in (
        lambda: table.update(spark.createDataFrame([(9999, "a", "b")], SCHEMA), ["a"], expected=1),
        lambda: table.insert(spark.createDataFrame([(1, "a", "b")], SCHEMA), expected=1),
        lambda: table.delete(spark.createDataFrame([(9999,)], "k long"), expected=1),
        lambda: table.upsert(spark.createDataFrame([(1, "a", "b")], SCHEMA), expected=2),
        lambda: table.update(spark.createDataFrame([], SCHEMA), ["a"], expected=1),
        lambda: table.create(table.read(), ["k"]),
    ):
        with pytest.raises(apply.GuardError):
            wrong()
    with pytest.raises(Exception, match="more than once"):
        table.upsert(spark.createDataFrame([(1, "a", "b"), (1, "c", "b")], SCHEMA))
    with apply.transaction(spark, read_only=True), pytest.raises(apply.GuardError):
        table.update(spark.createDataFrame([(1, "a", "b")], SCHEMA), ["a"])
    assert table.versions()[-1] == at and {r.k: (r.a, r.b) for r in table.read().collect()} == want
    table.delete(table.read())
    assert table.read().count() == 0 and table.insert(spark.createDataFrame([(1, "a", "b")], SCHEMA), expected=1) and table.read().count() == 1


def test_a_second_writer_fails(spark, tmp_path):
    table = made(spark, tmp_path)
    base, manifest = table.versions()[-1], table.manifest()
    table.update(spark.createDataFrame([(1, "first", "")], SCHEMA), ["a"])
    with pytest.raises(apply.GuardError, match="another writer"):
        table.change(spark.createDataFrame([(1,)], "k long"), lambda old: old.withColumn("_changed", F.lit(True)), None, manifest, base)
    assert {r.k: r.a for r in table.read().collect()}[1] == "first"


def test_restore_leaves_later_changes_alone(spark, tmp_path):
    table = made(spark, tmp_path)
    before = {r.k: (r.a, r.b) for r in table.read().collect()}
    one = spark.createDataFrame([(i, "one", None) for i in range(10)], SCHEMA)
    with pytest.raises(apply.GuardError, match="before_images is 10, not 9"):
        table.apply_marked(one, ["a"], "m1", 9)
    with pytest.raises(apply.GuardError):
        table.apply_marked(one.union(spark.createDataFrame([(7777, "x", "")], SCHEMA)), ["a"], "m1", 11)
    assert table.versions() == [1]
    table.apply_marked(one, ["a"], "m1", 10)
    table.apply_marked(spark.createDataFrame([(i, "two", "two") for i in range(5, 15)], SCHEMA), ["b"], "m2", 10)
    with pytest.raises(apply.GuardError, match="exists"):
        table.apply_marked(one, ["a"], "m1", 10)
    assert sorted((r.k, r.before.a, r.after.a) for r in table.marked("m1").collect()) == [(i, f"a{i}", "one") for i in range(10)]
    assert [tuple(r) for r in table.restored_counts("m1").collect()] == [("a", 0, 10)]
    with pytest.raises(apply.GuardError):
        table.restore("m1", 9)
    with pytest.raises(apply.GuardError):
        table.restore("m3", 1)
    table.restore("m1", 10)
    want = before | {i: (before[i][0], "two") for i in range(5, 15)}
    assert {r.k: (r.a, r.b) for r in table.read().collect()} == want
    assert [tuple(r) for r in table.restored_counts("m1").collect()] == [("a", 10, 10)]
    with pytest.raises(apply.GuardError):
        table.restore("m1", 10)
    table.restore("m2", 10)
    assert {r.k: (r.a, r.b) for r in table.read().collect()} == before


def test_numbers_and_pages(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 5).select(((F.col("id") * 7919) % 5000).alias("k"), F.when(F.col("id") % 11 != 0, F.col("id") % 13).alias("g"), F.lit("x").alias("n"))
    table = ordered.OrderedTable.write(rows, ["g", "k"], f"{tmp_path}/o", ranges=12)
    want = sorted(((r.g, r.k) for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    got = {r.row_no: (r.g, r.k) for r in table.numbered().collect()}
    assert [got[i + 1] for i in range(5000)] == want and len(got) == 5000
    assert table.ranges().count() > 8
    for number in (1, 2, 50, 100, 101, 0):
        at = max(number, 1) - 1
        page = table.page(number, 50).collect()
        assert [(r.g, r.k) for r in page] == want[at * 50 : at * 50 + 50] and [r.row_no for r in page] == list(range(at * 50 + 1, at * 50 + 1 + len(page)))
    deep, first = table.page(90, 50), table.page(1, 50)
    assert len(deep.inputFiles()) <= 2 and len(first.inputFiles()) == 1
    assert [(r.g, r.k) for r in table.page_after(None, 30).collect()] == want[:30]
    at = 600
    while want[at][0] is None:
        at += 1
    for size in (30, 900):
        after = table.page_after(list(want[at]), size)
        assert [(r.g, r.k) for r in after.collect()] == want[at + 1 : at + 1 + size] and (size > 30 or len(after.inputFiles()) <= 2)
    assert table.page_after(list(want[-1]), 10).count() == 0
    empty = ordered.OrderedTable.write(rows.limit(0), ["g"], f"{tmp_path}/e")
    assert empty.numbered().count() == 0 and empty.page(1, 5).count() == 0 and empty.page_after([1], 5).count() == 0 and empty.forward_fill(["g"], ["n"]).count() == 0
    tied = ordered.numbered(rows.select("n"), ["n"], f"{tmp_path}/t")
    assert sorted(r.row_no for r in tied.collect()) == list(range(1, 5001))


def test_fill_down_over_ranges(spark, tmp_path):
    """One file of many rows with few values: every range but those with a value takes what earlier ranges hand on."""
    n = 40_000
    k = F.col("id")
    rows = spark.range(0, n, 1, 3).select(k.alias("line"), F.when(k % 4 != 0, F.when(k % 2 == 0, "f").otherwise("g")).alias("file"), F.when((k % 9973).isin(5, 6, 8), k.cast("string")).when(k % 7 == 0, "  ").alias("x"), F.when(k == 11, "only").alias("y"))
    table = ordered.OrderedTable.write(rows, ["line"], f"{tmp_path}/f", ranges=9)
    held, want = {}, []
    for r in sorted(rows.collect(), key=lambda r: r.line):
        own = held.setdefault(r.file, {"x": None, "y": None})
        own |= {c: r[c] for c in ("x", "y") if r[c] is not None and r[c].strip()}
        want.append((r.line, r.file, own["x"], own["y"]))
    got = table.forward_fill(["file"], ["x", "y"])
    assert rows_of(got.select("line", "file", "x", "y")) == sorted(want, key=repr) and got.columns == ["line", "file", "x", "y"]
    assert table.ranges().count() == 9


def test_summary_is_kept_up(spark, tmp_path):
    table = made(spark, tmp_path)
    group, size = F.col("b"), F.length("a")
    held = summary.KeptSummary(table, apply.VersionedTable(spark, f"{tmp_path}/s"), {"b": group, "long": size > 3}, {"chars": size.cast("long")})
    assert held.refresh() == 1 and rows_of(held.read()) == rows_of(held.recount()) and held.version() == 1
    steps = [
        lambda: table.update(spark.createDataFrame([(1, "longer text", "b"), (2, None, None)], SCHEMA), ["a", "b"]),
        lambda: table.delete(spark.createDataFrame([(5,), (6,), (None,)], "k long")),
        lambda: table.upsert(spark.createDataFrame([(900, "x", "new"), (3, "y", "new")], SCHEMA)),
    ]
    for step in steps:
        step()
        files_before = len(table.differing(held.version(), table.versions()[-1])[1].inputFiles())
        assert 0 < files_before <= 3
        assert held.refresh() == table.versions()[-1] and rows_of(held.read()) == rows_of(held.recount())
    steps[0]()
    steps[1]()
    assert held.refresh() == table.versions()[-1] and rows_of(held.read()) == rows_of(held.recount()) and held.refresh() == table.versions()[-1]
    table.delete(table.read())
    held.refresh()
    assert held.read().count() == 0 and held.version() == table.versions()[-1]
    table.insert(spark.createDataFrame([(1, "a", "b")], SCHEMA))
    held.refresh()
    assert rows_of(held.read()) == [("b", False, 1, 1)]


def test_dictionary_of_any_size(spark):
    terms = [("c", "red", "token"), ("m", "steel", "contains"), ("m", "stainlesssteel", "contains"), ("z", "red", "token"), ("p", "ring", "contains"), ("m", "two words", "token"), ("n", "", "token"), ("n", None, "contains")]
    texts = ["Stainless-Steel red", "bored", "a RED b", "", None, "two  words", "ring red", "Rings", "r e d"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "k long, text string")
    known = [t for t in terms if t[1]]
    for pinned in (None, "p"):
        want = {r.k: (r.h and (r.h.category, r.h.term)) for r in rows.select("k", options.dictionary_term(F.col("text"), known, pinned).alias("h")).collect()}
        for block in (16_000_000, 70):  # one automaton, or one for each term
            got = options.dictionary_terms(rows, "text", spark.createDataFrame(terms, "category string, term string, mode string"), pinned, block)
            assert {r.k: (r.term and (r.category, r.term)) for r in got.collect()} == want and got.columns == ["k", "text", "category", "term"]
    many = spark.range(20_000).select((F.col("id") % 7).cast("string").alias("category"), F.concat(F.lit("term"), F.col("id").cast("string"), F.lit("x")).alias("term"), F.when(F.col("id") % 2 == 0, "token").otherwise("contains").alias("mode"))
    rows = spark.range(3000).select("id", F.concat(F.lit("a Term"), (F.col("id") * 7).cast("string"), F.lit("x b")).alias("text"))
    got = {r.id: r.term for r in options.dictionary_terms(rows, "text", many).collect()}
    assert got == {i: f"term{i * 7}x" if i * 7 < 20_000 else None for i in range(3000)}
    assert options.dictionary_terms(rows, "text", many.limit(0)).where("term is null").count() == 3000


def test_a_large_dictionary_is_joined(spark):
    """Beyond the size of one automaton no Python worker holds the terms, and the terms found are the same."""
    mode, k = F.when(F.col("id") % 3 == 0, "token").otherwise("contains"), F.col("id")
    made = F.when(k % 5 == 0, F.concat(F.lit("customer"), F.lpad(k.cast("string"), 9, "0"))).when(k % 5 == 1, F.concat(F.lit("ab "), k.cast("string"), F.lit(" é"))).when(k % 5 == 2, F.concat(F.lit("x"), (k % 90).cast("string"))).when(k % 5 == 3, F.concat(F.lit("аб"), k.cast("string"))).otherwise(F.concat(k.cast("string"), F.lit("zzzzzzzzz")))
    terms = spark.range(2000).select((k % 4).cast("string").alias("category"), made.alias("term"), mode.alias("mode"))
    terms = terms.union(spark.createDataFrame([("0", "ABC", "token"), ("0", " q", "token"), ("9", "customer000000005", "contains"), (None, "x7", None), ("1", "o\u0301a", "contains")], "category string, term string, mode string"))
    texts = spark.range(1500).select(k.alias("i"), F.concat(F.when(k % 2 == 0, "Customer#").when(k % 3 == 0, "AB ").otherwise("АБ"), F.when(k % 2 == 0, F.lpad(k.cast("string"), 9, "0")).otherwise(k.cast("string")), F.when(k % 7 == 0, " É x7").when(k % 7 == 1, "zzzzzzzzz-").otherwise(F.concat(F.lit("/x"), (k % 95).cast("string")))).alias("text"))
    long = "".join(f"wörd{i}, " for i in range(700))
    texts = texts.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "?!"), (-4, long + "Customer#000000010 " + long), (-5, "q  abc"), (-6, "c" * 300 + "ustomer#000000015"), (-7, long + "ab 6 é")], "i long, text string"))
    for pinned in (None, "2"):
        small, large = (options.dictionary_terms(texts.union(texts), "text", terms, pinned, block) for block in (16_000_000, 1000))
        assert rows_of(small) == rows_of(large)
        assert "MapInArrow" in small._jdf.queryExecution().toString() and "InArrow" not in large._jdf.queryExecution().toString()
        assert large.where("i = -4 and term = 'customer000000010'").count() == 2


def test_lines_are_cut_once(spark):
    """Each expression over a cell's lines stands once in the plan."""
    rows = spark.createDataFrame([(1, "a\nb", "h\nx\ny", "Y\nN", "c", "p", "s")], "row long, codes string, options string, statuses string, channel string, product_code string, sale_status string")
    for df in (evidence.aligned_lines(rows, "row", "codes", "options", "statuses"), evidence.line_evidence(rows, rows.selectExpr("codes as code"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("split(") <= 3 and plan.count("arrays_zip(") == 1, plan


def test_dimension_counts_as_grouping_sets(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "x string, y int")
    assert rows_of(relational.dimension_counts(rows, ["x", "y"])) == sorted([("total", "all", 3), ("x", "a", 2), ("x", "(blank)", 1), ("y", "1", 2), ("y", "(blank)", 1)], key=repr)


def test_nested_json(spark):
    row = spark.range(1)
    value = lambda text: json_values.parsed(F.lit(text).cast("string"))
    shown = lambda c: row.select(json_values.json_text(c).alias("x")).first().x
    put = lambda text, path, new: shown(json_values.set_path(value(text), path, json_values.json_value(F.lit(new))))
    assert put('{"a":{"b":1},"c":[1]}', ["a", "b"], "x") == '{"a":{"b":"x"},"c":[1]}' and put('{"a":1}', ["b"], 2) == '{"a":1,"b":2}'
    assert put('{"a":1}', ["x", "y"], 2) == '{"a":1}' and put('{"a":1}', ["a", "y"], 2) == '{"a":1}' and put("[1]", ["a"], 2) == "[1]" and put(None, ["a"], 2) is None and put('{"a b":null}', ["a b"], None) == '{"a b":null}'
    added = lambda text, path: shown(json_values.append_path(value(text), path, json_values.json_value(F.struct(F.lit(1).alias("n"), F.lit(None).cast("string").alias("z")))))
    assert added(None, ["e"]) == '{"e":[{"n":1,"z":null}]}' and added('{"e":[true],"k":"v"}', ["e"]) == '{"e":[true,{"n":1,"z":null}],"k":"v"}' and added('{"e":"one"}', ["e"]) == '{"e":["one",{"n":1,"z":null}]}' and added('{"d":{}}', ["d", "e"]) == '{"d":{"e":[{"n":1,"z":null}]}}'
    assert shown(json_values.without_nulls(value('{"a":null,"b":null,"c":1}'), ["a", "c"])) == '{"b":null,"c":1}'
    has = lambda text, part: row.select(json_values.contains(value(text), part).alias("x")).first().x
    whole = '{"a":{"b":[1,{"c":"x","d":null},2.5,true]},"e":"1"}'
    assert all(has(whole, p) for p in ({}, {"e": "1"}, {"a": {"b": [2.5]}}, {"a": {"b": [{"c": "x"}, 1]}}, {"a": {"b": [{"d": None}]}}, {"a": {"b": [True]}}, {"a": {"b": []}}))
    assert not any(has(whole, p) for p in ({"e": 1}, {"a": {"b": [{"c": "y"}]}}, {"a": {"b": [False]}}, {"z": None}, {"a": []}, [], "1", {"a": {"b": ["1"]}}, {"a": {"b": {"c": "x"}}}))
    assert has("[1,2]", 2) and has("[[1],2]", [[1]]) and not has("[[1]]", 1) and has('"s"', "s") and not has(None, {}) and has("null", None)
