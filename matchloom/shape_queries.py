"""Queries of shapes, files' checks, run context and caches that the other two modules lack. Importing it adds them to the others."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import aggregates as A
from matchloom.functions import text as X
from matchloom.operators import codes, relational, review
from matchloom.plans import apply
from matchloom.queries import ALIASES, _aliases, query, t
from matchloom.sources import files

# ---- files' checks -------------------------------------------------------------------------------------------------------

SHEET = """r as (select case when o_orderkey % 10 = 0 then ' ' else 'P' || (o_custkey % 300) end as product_uid, case when o_orderkey % 12 <> 0 then cast(o_orderkey % 4000 as varchar) end as sto_id, case when o_orderkey % 3 = 0 then 'C' || o_orderkey when o_orderkey % 3 = 1 then '' end as sto_code,
    case when o_orderkey % 15 = 0 then 'x [abcdefg-' || (o_custkey % 50) || '-1]' when o_orderkey % 5 = 0 then 'x [AB-' || (o_custkey % 50) || '-1]' else o_orderpriority end as opt_value, case when o_orderkey % 7 = 0 then '[CD-' || (o_custkey % 40) || '-2_1] y' when o_orderkey % 7 = 1 then null else ' ' end as opt_values from orders)"""


def _sheet(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda head, x, tail="": F.concat(F.lit(head), x.cast("string"), F.lit(tail))
    return t(spark, sf, "orders").select(
        F.when(k % 10 == 0, " ").otherwise(text("P", c % 300)).alias("product_uid"), F.when(k % 12 != 0, (k % 4000).cast("string")).alias("sto_id"), F.when(k % 3 == 0, text("C", k)).when(k % 3 == 1, "").alias("sto_code"),
        F.when(k % 15 == 0, text("x [abcdefg-", c % 50, "-1]")).when(k % 5 == 0, text("x [AB-", c % 50, "-1]")).otherwise(F.col("o_orderpriority")).alias("opt_value"), F.when(k % 7 == 0, text("[CD-", c % 40, "-2_1] y")).when(k % 7 == 1, None).otherwise(" ").alias("opt_values"),
    )


@query(f"""with {SHEET}, x as (select trim(coalesce(product_uid, '')) as p, trim(coalesce(sto_id, '')) as s, trim(coalesce(sto_code, '')) as c, trim(coalesce(opt_value, '')) as a, trim(coalesce(opt_values, '')) as b,
    nullif(regexp_extract(coalesce(opt_value, ''), '\\[([A-Za-z]+-[0-9]+-[0-9]+(?:_[0-9]+)?)\\]', 1), '') as ca, nullif(regexp_extract(coalesce(opt_values, ''), '\\[([A-Za-z]+-[0-9]+-[0-9]+(?:_[0-9]+)?)\\]', 1), '') as cb from r),
m as (select count(*) as row_count, count(distinct nullif(p, '')) as product_uid_distinct, count(*) filter (p = '') as product_uid_blank_rows, count(*) filter (s = '') as sto_id_blank_rows, count(*) filter (c = '') as sto_code_blank_rows, count(*) filter (a = '') as opt_value_blank_rows, count(*) filter (b = '') as opt_values_blank_rows,
    count(ca) as opt_value_bracket_hits, count(distinct ca) as opt_value_bracket_unique_codes, count(cb) as opt_values_bracket_hits, count(distinct cb) as opt_values_bracket_unique_codes, count(*) filter (c <> '' or ca is not null or cb is not null) as own_sku_candidate_resolvable, count(*) filter (c = '' and ca is null and cb is null) as own_sku_candidate_unresolvable from x),
s as (select count(*) filter (n > 1) as sto_id_duplicate_keys, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as sto_id_duplicate_rows from (select s, count(*) as n from x where s <> '' group by 1)), p as (select count(*) filter (n > 1) as product_sto_duplicate_keys, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as product_sto_duplicate_rows from (select p, s, count(*) as n from x where p <> '' and s <> '' group by 1, 2))
select name as metric, value from (unpivot m on columns(*) into name name value value) union all select name, value from (unpivot s on columns(*) into name name value value) union all select name, value from (unpivot p on columns(*) into name name value value)""")
def csv_integrity(spark, sf):
    return files.csv_integrity(_sheet(spark, sf), codes.BRACKET)


@query(f"""with {SHEET}, n as (select *, row_number() over (order by sto_code, product_uid, sto_id) as row_no from (select distinct * from r)), k as (select trim(product_uid) as product_uid, trim(sto_id) as sto_id, max(coalesce(sto_code, '')) as sto_code from n where trim(product_uid) <> '' and trim(sto_id) <> '' group by 1, 2)
select product_uid, sto_id, sto_code, product_uid || '|' || sto_id as apply_key from k""")
def apply_map(spark, sf):
    """The last row of each product and option, by its code."""
    rows = _sheet(spark, sf).select("product_uid", "sto_id", F.coalesce("sto_code", F.lit("")).alias("sto_code"))
    return files.keyed_rows(rows, ["product_uid", "sto_id"], "sto_code").select("product_uid", "sto_id", "sto_code", "apply_key")


@query("""select p_partkey, sha256('{"p_brand":"' || p_brand || '","p_name":' || case when p_size % 9 = 0 then 'null' else '"' || p_name || '"' end || ',"p_size":' || p_size || '}') as row_hash from part""")
def row_hashes(spark, sf):
    part = t(spark, sf, "part").withColumn("p_name", F.when(F.col("p_size") % 9 != 0, F.col("p_name")))
    return part.select("p_partkey", files.row_hash(["p_size", "p_name", "p_brand"]).alias("row_hash"))


@query("""select p_brand as path, count(*) as row_count, max(len(string_split(p_name || ' ' || p_type, ' '))) as column_count, count(distinct p_type) as sheet_count from part group by 1""")
def table_facts(spark, sf):
    return files.table_facts(t(spark, sf, "part").select(F.col("p_brand").alias("path"), F.col("p_type").alias("sheet"), F.col("p_partkey").alias("row_no"), F.split(F.concat_ws(" ", "p_name", "p_type"), " ").alias("cells")))


@query("""with r as (select p_brand as path, p_type as sheet, p_partkey, row_number() over (partition by p_brand, p_type order by p_partkey) as row_no, p_name, p_size from part)
select path, sheet, row_no, case when row_no > 1 then p_name end as item, case when row_no > 1 then cast(p_size as varchar) end as size, cast(null as varchar) as missing from r where row_no > 1""")
def sheet_columns(spark, sf):
    """Rows of sheets with a header, named by the header's aliases and, for the last, by a fixed place that no row has."""
    from pyspark.sql import Window

    part = t(spark, sf, "part")
    rows = part.withColumn("row_no", F.row_number().over(Window.partitionBy("p_brand", "p_type").orderBy("p_partkey")).cast("long"))
    head = F.array(F.lit(" Item Name "), F.lit("SIZE"))
    rows = rows.select(F.col("p_brand").alias("path"), F.col("p_type").alias("sheet"), "row_no", F.when(F.col("row_no") == 1, head).otherwise(F.array("p_name", F.col("p_size").cast("string"))).alias("cells"))
    return files.with_header(rows, {"item": ["nothing", "itemname"], "size": ["size"]}, fixed={"missing": 5})


# ---- shapes --------------------------------------------------------------------------------------------------------------


@query("""select p_brand, array_to_string(list_transform((list(p_name order by nullif(p_size, 7) nulls last, p_partkey)), lambda x: coalesce(x, '-')), ',') as names from (select *, case when p_partkey % 5 = 0 then null else p_name end as name2 from part) group by 1""".replace("list(p_name", "list(name2"))
def ordered_arrays(spark, sf):
    """Names by size, then key: nulls stay in their places, a null size comes last."""
    rows = t(spark, sf, "part").withColumns({"n": F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")), "s": F.nullif("p_size", F.lit(7))})
    held = rows.groupBy("p_brand").agg(A.ordered_array(F.col("n"), F.col("s"), F.col("p_partkey")).alias("x"))
    return held.select("p_brand", F.array_join(F.transform("x", lambda v: F.coalesce(v, F.lit("-"))), ",").alias("names"))


@query("""select value, row_count, row_number() over (order by row_count desc, value nulls first) as place from (select nullif(p_name, 'small ring') as value, count(*) as row_count from part group by 1 order by 2 desc, 1 nulls first limit 20)""")
def most_common(spark, sf):
    return relational.most_common(t(spark, sf, "part").select(F.nullif("p_name", F.lit("small ring")).alias("name")), "name")


@query("""with r as (select p_partkey as id, p_brand || '-' || (p_size % 10) as sku, case when p_partkey % 3 = 0 then p_type || (p_partkey % 97) end as product from part), x as (select a.id as row, b.id as other from r a join r b on a.id <> b.id and (a.sku = b.sku or coalesce(a.product = b.product, false)))
select row, other from (select *, row_number() over (partition by row order by other) as n from x) where n <= 80""")
def related_rows(spark, sf):
    k = F.col("p_partkey")
    rows = t(spark, sf, "part").select(k.alias("id"), F.concat("p_brand", F.lit("-"), (F.col("p_size") % 10).cast("string")).alias("sku"), F.when(k % 3 == 0, F.concat("p_type", (k % 97).cast("string"))).alias("product"))
    return relational.related_rows(rows, "id", ["sku", "product"])


@query("""with g as (select url, page_id, case when page_id % 3 = 0 then page_id % 900 end as item, case when page_id % 4 = 1 then 'c' || (page_id % 500) end as code, case when page_id % 5 = 2 then page_id % 300 end as product, page_id % 7 = 0 as is_primary, page_id % 11 as sort_order from pages),
i as (select p_partkey as item, 'c' || (p_partkey % 700) as code, p_partkey // 4 as product from part),
x as (select i.item, g.url, row_number() over (partition by i.item order by coalesce(g.item = i.item, false) desc, coalesce(g.code = i.code, false) desc, is_primary desc, sort_order, page_id) as r from i join g on g.item = i.item or g.code = i.code or g.product = i.product)
select i.item, url from i left join x on x.item = i.item and r = 1""")
def ranked_image(spark, sf):
    """An item's picture by its own key, else its code, else its product: which key matched goes before primary and order."""
    g, k = F.col("page_id"), F.col("p_partkey")
    images = t(spark, sf, "pages").select(
        "url", "page_id", F.when(g % 3 == 0, g % 900).alias("item"), F.when(g % 4 == 1, F.concat(F.lit("c"), (g % 500).cast("string"))).alias("code"), F.when(g % 5 == 2, g % 300).alias("product"), (g % 7 == 0).alias("is_primary"), (g % 11).alias("sort_order")
    )
    items = t(spark, sf, "part").select(k.alias("item"), F.concat(F.lit("c"), (k % 700).cast("string")).alias("code"), F.floor(k / 4).alias("product"))
    order = [F.col("is_primary").desc(), F.col("sort_order"), F.col("page_id")]
    return relational.ranked_matches(items, "item", images, {"item": 0, "code": 1, "product": None}, order, ["url"])


@query("""with l as (select o_orderkey, list_concat(case when o_orderkey % 5 <> 0 then ['t' || (o_orderkey % 3), 't' || (o_orderkey % 7)] else [] end, ['t' || (o_orderkey % 2), case when o_orderkey % 4 = 0 then null else 't9' end]) as all_tags from orders)
select o_orderkey, array_to_string(list_filter(all_tags, lambda x, i: x is not null and list_position(all_tags, x) = i), ',') as tags from l""")
def merged_tags(spark, sf):
    k = F.col("o_orderkey")
    tag = lambda x: F.struct(F.concat(F.lit("t"), x.cast("string")).alias("name"), x.cast("string").alias("id"))
    rows = t(spark, sf, "orders").select("o_orderkey", F.when(k % 5 != 0, F.array(tag(k % 3), tag(k % 7))).alias("a"), F.array(tag(k % 2), F.when(k % 4 != 0, tag(F.lit(9)))).alias("b"))
    return rows.select("o_orderkey", F.array_join(F.transform(relational.merged_lists(["a", "b"], lambda x: x["name"]), lambda x: x["name"]), ",").alias("tags"))


@query("""select o_orderkey from orders where o_orderstatus in ('F', 'O') and o_orderkey % 4 = 1 and (o_orderkey % 3 = 0) and o_orderkey % 5 <> 0 and o_custkey % 4 <> 0 and contains(lower(o_orderpriority || ' ' || o_custkey), 'high 1')""")
def queue_filter(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("channel"), F.when(k % 4 == 1, "REVIEW").otherwise("NO_MATCH").alias("tier"), F.when(k % 5 == 0, "STOCK_DIFF").otherwise("STOCK_MATCH").alias("stock"), F.when(k % 5 == 0, "hold").otherwise("candidate").alias("bucket"),
        F.when(k % 3 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"))).alias("tag_names"), F.lit(True).alias("has_image"), "o_orderpriority", "o_custkey",
        (F.col("o_custkey") % 4 == 0).alias("left_out"),
    )
    return review.queue_filter(rows, ["F", "O"], tier="REVIEW", stock="STOCK_MATCH", mode="candidate", tags=("a", "b"), image_only=True, text=" HIGH 1", columns=("o_orderpriority", "o_custkey"), hide_excluded=True, exclusions="hide").select("o_orderkey")


@query("""select p_partkey from part order by try_cast(case when p_size % 10 = 0 then 'n/a' else cast(p_size as varchar) end as int) desc nulls last, p_partkey limit 50""")
def numeric_text_order(spark, sf):
    """A page ordered by a text as a number, the larger first, texts that are none last."""
    rows = t(spark, sf, "part").withColumn("text", F.when(F.col("p_size") % 10 == 0, "n/a").otherwise(F.col("p_size").cast("string")))
    return relational.page(rows, [X.number(F.col("text")).desc_nulls_last(), F.col("p_partkey")], 50, 0).select("p_partkey")


# ---- codes ---------------------------------------------------------------------------------------------------------------


@query(f"""with {ALIASES}, r as (select event_id, 'digits' as pattern, 'S' || regexp_extract(props, '[0-9]+', 0) as candidate from events where regexp_extract(props, '[0-9]+', 0) <> '' union all select event_id, 'word', regexp_extract(event_type, '^[a-m]+', 0) from events where regexp_extract(event_type, '^[a-m]+', 0) <> '')
select pattern, count(*) as n_matched, count(distinct candidate) as n_candidates, count(*) filter (coalesce(n, 0) = 1) as n_unique, count(*) filter (n > 1) as n_ambiguous, count(*) filter (coalesce(n, 0) = 0) as n_unmatched from r left join held on candidate = value group by 1""")
def regex_coverage(spark, sf):
    rows = t(spark, sf, "events").select("event_id", F.concat(F.lit("S"), F.regexp_extract("props", "[0-9]+", 0)).alias("a"), "event_type")
    trial = codes.regex_trial(rows, "a", {"digits": "^S[0-9]+"}).select("event_id", "pattern", "candidate").union(codes.regex_trial(rows, "event_type", {"word": "^[a-m]+"}).select("event_id", "pattern", "candidate"))
    return codes.regex_coverage(trial, _aliases(spark, sf))


@query(f"""with {ALIASES}, c as (select coalesce(nullif(trim(case when l_partkey % 4 = 0 then ' ' else 'S' || (l_partkey // 3) end), ''), case when l_suppkey % 5 <> 0 then 'S-' || l_suppkey end) as code from lineitem)
select regexp_replace(regexp_replace(code, '[A-Za-z]+', 'A', 'g'), '[0-9]+', '9', 'g') as shape, count(*) as n_lines, count(*) filter (coalesce(n, 0) = 1) as n_unique, count(*) filter (n > 1) as n_ambiguous, count(*) filter (coalesce(n, 0) = 0) as n_unmatched, cast(round(100.0 * count(*) filter (coalesce(n, 0) = 1) / count(*), 2) as double) as unique_rate
from c left join held on code = value group by 1""")
def code_shapes(spark, sf):
    """Order lines by the first code, else the second: match rates by the code's pattern."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    lines = t(spark, sf, "lineitem").select(F.when(p % 4 == 0, " ").otherwise(F.concat(F.lit("S"), F.floor(p / 3).cast("string"))).alias("code1"), F.when(s % 5 != 0, F.concat(F.lit("S-"), s.cast("string"))).alias("code2"))
    return codes.match_rates(codes.cross_map(lines, "code1", "code2", _aliases(spark, sf)), ["shape"])


@query("""select p_partkey, case when p_size % 3 = 0 then null when p_size % 4 = 0 then null else p_brand || '-' || p_partkey end as key, case when p_size % 5 = 0 then 0.0 when p_size % 7 = 0 then null else cast(p_size as double) end as number, p_size % 6 in (0, 2) as truth, upper(case when p_size % 2 = 0 then p_name else p_name || '1.5' end) as upper_key, case when p_size % 11 <> 0 then p_size end as whole from part""")
def guarded_casts(spark, sf):
    """Composite keys, numbers from texts, truth words, keys without a trailing .0, whole numbers."""
    size, name = F.col("p_size"), F.col("p_name")
    number = F.when(size % 5 == 0, " ").when(size % 7 == 0, "x1").otherwise(F.concat(F.lit(" "), size.cast("string")))
    truth = F.get(F.array(*(F.lit(x) for x in (" YES", "no", "t", "0", "", "f"))), (size % 6).cast("int"))
    return t(spark, sf, "part").select(
        "p_partkey", codes.composite_key(F.when(size % 3 != 0, F.concat(F.lit(" "), F.col("p_brand"))), F.when(size % 4 == 0, " ").otherwise(F.col("p_partkey").cast("string"))).alias("key"), X.number(number).alias("number"), X.truth(truth).alias("truth"),
        X.key(F.when(size % 2 == 0, F.concat(name, F.lit(".0"))).otherwise(F.concat(name, F.lit("1.5")))).alias("upper_key"), X.whole_number(F.when(size % 11 == 0, F.concat(size.cast("string"), F.lit("x"))).otherwise(size.cast("string"))).alias("whole"),
    )


@query("""with w as (select p_partkey, case when p_partkey % 3 = 0 then 'x AB-' || p_partkey || ' AB-2_3' when p_partkey % 3 = 1 then 'none' end as a, 'CD-' || p_partkey as b from part)
select p_partkey, case when a like 'x %' then 'AB-2_3' else b end as code, case when p_partkey % 3 = 0 then 'x+' || p_partkey || '-2' else 'y' end as first_only from w join part using (p_partkey)""")
def last_codes(spark, sf):
    k = F.col("p_partkey")
    text = k.cast("string")
    a = F.when(k % 3 == 0, F.concat(F.lit("x AB-"), text, F.lit(" AB-2_3"))).when(k % 3 == 1, "none")
    return t(spark, sf, "part").select("p_partkey", X.last_code(a, F.concat(F.lit("CD-"), text)).alias("code"), X.replace_first(F.when(k % 3 == 0, F.concat(F.lit("x-"), text, F.lit("-2"))).otherwise("y"), "-", "+").alias("first_only"))


# ---- context, caches, JSON, rollback -------------------------------------------------------------------------------------


@query("""select o_orderkey, '{' || concat_ws(',', case when o_orderkey % 3 <> 0 then '"a":"' || o_orderkey || '"' end, '"rule":"auto"', case when o_orderkey % 2 = 0 then '"status":"' || o_orderstatus || '"' end) || '}' as evidence, o_orderkey % 2 = 0 and o_orderstatus = 'F' as is_done from orders""")
def evidence_json(spark, sf):
    """Keys set in a JSON object, nulls stripped, and a test for a part of it."""
    k = F.col("o_orderkey")
    base = F.when(k % 3 != 0, F.concat(F.lit('{"rule":"old","a":"'), k.cast("string"), F.lit('"}')))
    rows = t(spark, sf, "orders").select("o_orderkey", apply.merge_json(base, {"status": F.when(k % 2 == 0, F.col("o_orderstatus")), "rule": F.lit("auto")}).alias("evidence"))
    return rows.withColumn("is_done", apply.json_contains(F.col("evidence"), {"status": "F"}))
