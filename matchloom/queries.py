"""Queries of the reconciliation operators over the test tables, each beside the SQL that gives the same rows.

Items are parts, shared codes their names, order lines line items, channels market segments or order states, evidence events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.functions import aggregates as A
from matchloom.functions import text as X
from matchloom.operators import codes, evidence, options, relational, review, stock
from matchloom.plans import apply

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _aliases(spark, sf):
    """(value, target): own codes of three parts each, of parts of some size only."""
    return t(spark, sf, "part").where("p_size > 5").select(F.concat(F.lit("S"), F.floor(F.col("p_partkey") / 3).cast("string")).alias("value"), F.col("p_partkey").alias("target"))


ALIASES = "aliases as (select 'S' || (p_partkey // 3) as value, p_partkey as target from part where p_size > 5), held as (select value, count(distinct target) as n, case when count(distinct target) = 1 then min(target) end as resolved from aliases group by 1)"


# ---- codes ---------------------------------------------------------------------------------------------------------------


@query(f"""with {ALIASES}, lines as (select l_returnflag, case when l_partkey % 10 < 8 then 'S' || (l_partkey // 3) end as code from lineitem),
m as (select l_returnflag, coalesce(n, 0) as n from lines left join held on code = value)
select l_returnflag, count(*) as n_lines, count(*) filter (n = 1) as n_unique, count(*) filter (n > 1) as n_ambiguous, count(*) filter (n = 0) as n_unmatched,
  cast(round(100.0 * count(*) filter (n = 1) / nullif(count(*), 0), 2) as double) as unique_rate from m group by 1""")
def cross_map_rate(spark, sf):
    lines = t(spark, sf, "lineitem").select("l_returnflag", F.when(F.col("l_partkey") % 10 < 8, F.concat(F.lit("S"), F.floor(F.col("l_partkey") / 3).cast("string"))).alias("code"))
    return codes.match_rates(codes.resolve_alias(lines, _aliases(spark, sf), "code"), ["l_returnflag"])


@query(f"""with {ALIASES} select s_suppkey, 'S' || s_suppkey as code, coalesce(n, 0) as match_count, resolved,
  (select string_agg(cast(target as varchar), ',' order by target) from (select distinct value, target from aliases) a where a.value = 'S' || s_suppkey) as candidates from supplier left join held on value = 'S' || s_suppkey""")
def alias_resolve(spark, sf):
    rows = t(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"))
    return codes.resolve_alias(rows, _aliases(spark, sf), "code").select("s_suppkey", "code", "match_count", "resolved", F.array_join(F.transform("candidates", lambda x: x.cast("string")), ",").alias("candidates"))


@query(f"""with {ALIASES}, r as (select p_partkey, case when p_size % 7 = 0 then ' ' else 'S' || (p_partkey // 3) end as k, p_size % 5 <> 0 as matched, p_size % 10 = 0 as loose, case when p_partkey % 11 = 0 then p_partkey + p_partkey % 2 end as existing,
  case when p_partkey % 13 = 0 then 'Deleted row' else 'ok' end as status from part)
select p_partkey, case when trim(k) = '' then 'null_key' when not matched and loose then 'loose_only' when not matched then 'pattern_unmatched' when coalesce(n, 0) = 0 then 'not_in_alias' when n > 1 then 'ambiguous' when existing is not null then 'conflict'
    when status ilike '%deleted%' then 'inactive' else 'auto_confirm' end as reason,
  case when trim(k) = '' then 'null_key' when not matched and loose then 'loose_only' when not matched then 'pattern_unmatched' when coalesce(n, 0) = 0 then 'not_in_alias' when n > 1 then 'ambiguous' when status ilike '%deleted%' then 'inactive'
    when existing = resolved then 'already_applied' when existing is not null then 'conflict' else 'auto_confirm' end as reason_split from r left join held on value = k""")
def alias_classify(spark, sf):
    part = t(spark, sf, "part")
    rows = part.select(
        "p_partkey", F.when(F.col("p_size") % 7 == 0, " ").otherwise(F.concat(F.lit("S"), F.floor(F.col("p_partkey") / 3).cast("string"))).alias("k"), (F.col("p_size") % 5 != 0).alias("matched"), (F.col("p_size") % 10 == 0).alias("loose"),
        F.when(F.col("p_partkey") % 11 == 0, F.col("p_partkey") + F.col("p_partkey") % 2).alias("existing"), F.when(F.col("p_partkey") % 13 == 0, "Deleted row").otherwise("ok").alias("status"),
    )
    out = codes.resolve_alias(rows, _aliases(spark, sf), "k")
    args = [F.col(c) for c in ("k", "matched", "match_count", "existing", "resolved", "status")]
    return out.select("p_partkey", codes.classify_match(*args, loose=F.col("loose")).alias("reason"), codes.classify_match(*args, split_same=True, loose=F.col("loose")).alias("reason_split"))


@query("""with r as (select p_partkey as k, case when p_partkey % 4 = 0 then 'AB-' || p_partkey when p_partkey % 4 = 1 then ' ' end as direct, case when p_partkey % 6 = 0 then 'x [abcDEFgh-' || p_partkey || '-1]' when p_partkey % 3 = 0 then 'x [AB-' || p_partkey || '-1]' when p_partkey % 7 = 0 then '[EF-' || p_partkey || '-3-4]' else p_name end as a,
    case when p_partkey % 10 = 0 then null when p_partkey % 4 = 2 then 'y [cd-' || p_partkey || '-2-3]' when p_partkey % 2 = 0 then 'y [CD-' || p_partkey || '-2-3]' when p_partkey % 5 = 0 then '[GH-' || p_partkey || '-9_1] z' else 'loose ij-' || p_partkey || '-5-6' end as b from part),
x as (select *, nullif(trim(direct), '') as d, nullif(regexp_extract(a, '\\[([A-Za-z]+-[0-9]+-[0-9]+(?:_[0-9]+)?)\\]', 1), '') as a3, nullif(regexp_extract(a, '\\[([A-Za-z]+-[0-9]+-[0-9]+-[0-9]+)\\]', 1), '') as a4,
    nullif(regexp_extract(b, '\\[([A-Za-z]+-[0-9]+-[0-9]+(?:_[0-9]+)?)\\]', 1), '') as b3, nullif(regexp_extract(b, '\\[([A-Za-z]+-[0-9]+-[0-9]+-[0-9]+)\\]', 1), '') as b4 from r),
e as (select k as p_partkey, coalesce(d, a3, b3, a4, b4) as old, coalesce(d, b3, b4, a3, a4) as new, case when d is not null then 'direct' when b3 is not null then 'b_bracket' when b4 is not null then 'b_four_parts' when a3 is not null then 'a_bracket' when a4 is not null then 'a_four_parts' end as method,
    case when d is not null or b3 is not null then 'existing' when b4 is not null then 'new' when a3 is not null then 'existing' when a4 is not null then 'new' end as family, nullif(regexp_extract(coalesce(a, '') || ' ' || coalesce(b, ''), '([A-Za-z]+-[0-9]+-[0-9]+-[0-9]+)', 1), '') as loose from x)
select p_partkey, old, new, method, family, loose, case when old is not distinct from new then 'same' when old is null then 'new' when new is null then 'lost' else 'changed' end as change from e""")
def version_compare(spark, sf):
    k = F.col("p_partkey")
    text = k.cast("string")
    made = lambda head, tail: F.concat(F.lit(head), text, F.lit(tail))
    rows = t(spark, sf, "part").select(
        "p_partkey", F.when(k % 4 == 0, F.concat(F.lit("AB-"), text)).when(k % 4 == 1, " ").alias("direct"), F.when(k % 6 == 0, made("x [abcDEFgh-", "-1]")).when(k % 3 == 0, made("x [AB-", "-1]")).when(k % 7 == 0, made("[EF-", "-3-4]")).otherwise(F.col("p_name")).alias("a"),
        F.when(k % 10 == 0, None).when(k % 4 == 2, made("y [cd-", "-2-3]")).when(k % 2 == 0, made("y [CD-", "-2-3]")).when(k % 5 == 0, made("[GH-", "-9_1] z")).otherwise(made("loose ij-", "-5-6")).alias("b"),
    )
    both = rows.select("p_partkey", codes.extract_code(F.col("direct"), F.col("a"), F.col("b"), "v2").code.alias("old"), codes.extract_code(F.col("direct"), F.col("a"), F.col("b")).alias("n"))
    both = both.select("p_partkey", "old", F.col("n.code").alias("new"), "n.method", "n.family", "n.loose")
    return both.withColumn("change", codes.version_changes(both, "old", "new"))


@query("""with n as (select p_partkey, p_brand, p_type, cast(p_size as varchar) as size, case when p_partkey % 4 = 0 then p_name || ' ' || (p_partkey % 3) || '-' || (p_partkey % 5) else p_name end as text from part),
c as (select *, lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')) as norm, trim(regexp_replace(text, '[^0-9]+', ' ', 'g')) as nums from n),
p as (select a.p_partkey as row_id, b.p_partkey as candidate, cast(case when a.norm = b.norm then 100 else 0 end + case when contains(a.norm, b.norm) or contains(b.norm, a.norm) then 40 else 0 end + case when a.nums <> '' and a.nums = b.nums then 20 else 0 end
    + case when a.size = b.size then 30 else 0 end as bigint) as score from c a join c b on a.p_brand = b.p_brand and a.p_type = b.p_type and a.p_partkey <> b.p_partkey),
w as (select *, max(score) over (partition by row_id) as top_score, dense_rank() over (partition by row_id order by score desc, candidate) as candidate_rank from p),
v as (select *, count(*) filter (score = top_score) over (partition by row_id) as n_top from w)
select row_id, candidate, score, top_score, n_top, candidate_rank, case when n_top = 1 and top_score >= 100 then 'strong' when n_top = 1 and top_score > 0 then 'weak' else 'manual' end as label from v""")
def token_score_rank(spark, sf):
    """Items of one brand and type as each other's candidates; texts are brought to one form before rows are paired."""
    k = F.col("p_partkey")
    text = F.when(k % 4 == 0, F.concat("p_name", F.lit(" "), (k % 3).cast("string"), F.lit("-"), (k % 5).cast("string"))).otherwise(F.col("p_name"))
    part = t(spark, sf, "part").select(k.alias("row_id"), "p_brand", "p_type", F.col("p_size").cast("string").alias("size"), *(c.alias(n) for n, c in codes.token_parts(text).items()))
    score = codes.token_score(*(F.col(c) for c in ("norm", "numbers", "c_norm", "c_numbers", "size")), F.array(F.lit(" "), "c_size", F.lit(None))).cast("long")
    return codes.ranked_within(part, ["p_brand", "p_type"], "row_id", "candidate", score)


@query("""select p_partkey, array_to_string(list_filter([case when not p_size > 10 then 'size' end, case when not p_retailprice > 1200 then 'price' end, case when not p_brand <> 'Brand#11' then 'brand' end], lambda x: x is not null), ',') as failed,
  (p_size > 10 and p_retailprice > 1200 and p_brand <> 'Brand#11') as reduced from part""")
def weak_reduce(spark, sf):
    checks = {"size": F.col("p_size") > 10, "price": F.col("p_retailprice") > 1200, "brand": F.col("p_brand") != "Brand#11"}
    return t(spark, sf, "part").select("p_partkey", *(c.alias(k) for k, c in codes.weak_reasons(checks).items()))


@query("""with p as (select regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') as plain, count(distinct p_partkey) as n_targets, min(p_partkey) as least_target from part where p_size > 25 group by 1)
select distinct s.p_name, n_targets, least_target, case when n_targets = 1 then 'unique' when n_targets > 1 then 'multiple' else 'none' end as backfill from part s left join p on plain = regexp_replace(upper(s.p_name), '[^A-Z0-9]', '', 'g')""")
def alias_backfill(spark, sf):
    part = t(spark, sf, "part")
    alias = part.where("p_size > 25").select(F.lower("p_name").alias("value"), F.col("p_partkey").alias("target"))
    return codes.alias_backfill(part.select("p_name").distinct(), alias, "p_name")


@query("""select event_id, 'digits' as pattern, regexp_extract(props, '[0-9]+', 0) as candidate from events where regexp_extract(props, '[0-9]+', 0) <> '' union all
select event_id, 'pair', regexp_extract(props, '"[a-z]+": [0-9]', 0) from events where regexp_extract(props, '"[a-z]+": [0-9]', 0) <> ''""")
def regex_trial(spark, sf):
    return codes.regex_trial(t(spark, sf, "events").select("event_id", "props"), "props", {"digits": "[0-9]+", "pair": '"[a-z]+": [0-9]'}).select("event_id", "pattern", "candidate")


@query("""select p_partkey, regexp_extract(p_brand, '^([A-Za-z]+)', 1) as word, split_part(p_brand, '#', 1) as prefix, nullif(ltrim(regexp_extract(p_brand, '#0*([0-9]+)$', 1), '0'), '') as option_no,
  md5(p_brand || '|' || p_partkey) as stable, '="' || replace(p_name, '"', '""') || '"' as cell, lower(regexp_replace(p_name, '[^\\p{L}\\p{N}]+', '', 'g')) as compacted from part""")
def code_parse(spark, sf):
    brand, name = F.col("p_brand"), F.col("p_name")
    return t(spark, sf, "part").select(
        "p_partkey", X.extract(brand, "^([A-Za-z]+)").alias("word"), X.code_prefix(brand, "#").alias("prefix"), X.option_number(F.replace(brand, F.lit("#"), F.lit("-"))).alias("option_no"),
        X.stable_id(brand, F.col("p_partkey")).alias("stable"), X.excel_text(name).alias("cell"), X.compact(name).alias("compacted"),
    )


# ---- evidence ------------------------------------------------------------------------------------------------------------


@query("""with r as (select l_partkey, l_returnflag, case when l_suppkey % 7 = 0 then ' ' else 'P' || l_suppkey end as p, case when l_linenumber % 3 = 0 then null else l_linenumber end as o from lineitem)
select l_partkey, count(*) as n_rows, count(*) filter (l_returnflag = 'N') as n_confirmed, count(*) filter (l_returnflag <> 'N') as n_candidate, count(distinct p) filter (trim(p) <> '') as n_products, count(distinct o) as n_options,
  min(p) filter (trim(p) <> '') as product, min(o) as option from r group by 1""")
def alias_profile(spark, sf):
    product, option = F.when(F.col("l_suppkey") % 7 == 0, " ").otherwise(F.concat(F.lit("P"), F.col("l_suppkey").cast("string"))), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber"))
    return evidence.mapping_profile(t(spark, sf, "lineitem").select("l_partkey", "l_returnflag", product.alias("p"), option.alias("o")), "l_partkey", "p", "o", F.col("l_returnflag") == "N")


@query("""with i as (select p_partkey, p_name, p_brand, p_type, case when p_size % 9 = 0 then ' ' else p_brand end as f, case when p_size % 6 = 0 then ' ' else 'C' || (p_size % 6) end as c from part),
x as (select p_partkey, p_name as code, p_type, f, c from i union all select p_partkey, p_brand, p_type, f, c from i union all select p_partkey, ' ', p_type, f, c from i),
s as (select code, count(distinct p_partkey) as i, count(distinct p_type) as p, count(distinct f) filter (trim(f) <> '') as f, count(distinct c) filter (trim(c) <> '') as c from x where trim(code) <> '' group by 1)
select p_partkey, count(distinct code) as n_codes, max(s.i) as max_items, max(s.p) as max_products, max(s.f) as max_families, max(s.c) as max_channel_codes from x join s using (code) group by 1""")
def own_code_scope(spark, sf):
    size = F.col("p_size")
    rows = t(spark, sf, "part").withColumns({"f": F.when(size % 9 == 0, " ").otherwise(F.col("p_brand")), "c": F.when(size % 6 == 0, " ").otherwise(F.concat(F.lit("C"), (size % 6).cast("string")))})
    rows = rows.select("p_partkey", "p_type", "f", "c", F.explode(F.array("p_name", "p_brand", F.lit(" "))).alias("code"))
    return evidence.code_scope(rows, "code", "p_partkey", "p_type", "f", "c")


@query("""with f as (select p_partkey, count(l_orderkey) as n, count(l_orderkey) filter (l_returnflag = 'R') as r, sum(l_quantity) as q from part left join lineitem on l_partkey = p_partkey group by 1)
select case when n > 40 then 'confirmed' when r > 8 then 'blocked' when q > 700 then 'high' when q > 500 then 'medium' when n = 0 then 'absent' when n < 20 then 'unknown' else 'manual' end as candidate,
  case when n > 40 then 'confirmed' when r > 8 then 'blocked' when q > 700 then 'high' when n = 0 then 'absent' when q > 500 then 'medium' when n < 20 then 'unknown' else 'manual' end as rate,
  case when n > 40 then 'confirmed' when r > 8 then 'blocked' when q > 700 then 'high' when q > 500 then 'medium' when n = 0 then 'absent' else 'unknown' end as without_manual, count(*) as n_items from f group by 1, 2, 3""")
def presence_status(spark, sf):
    lines = t(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), A.count_when(F.col("l_returnflag") == "R").alias("r"), F.sum("l_quantity").alias("q"))
    rows = t(spark, sf, "part").select("p_partkey").join(lines, "p_partkey", "left").fillna(0, ["n", "r"])
    flags = {"confirmed": F.col("n") > 40, "blocked": F.col("r") > 8, "high": F.col("q") > 700, "medium": F.col("q") > 500, "absent": F.col("n") == 0, "unknown": F.col("n") < 20}
    return rows.select(*(evidence.presence_status(flags, k).alias(k) for k in evidence.PRESENCE)).groupBy(*evidence.PRESENCE).agg(F.count("*").alias("n_items"))


@query("""with f as (select p_partkey as k, p_size as z, p_size > 10 as blocked, p_partkey % 3 <> 0 as duplicate, p_partkey % 4 <> 0 as one_target, p_partkey % 2 = 0 as pair, p_partkey % 5 <> 0 as one_item, p_partkey % 11 = 0 as split, p_name like '%red%' as semantic, p_size > 45 as quantity,
    p_partkey % 7 < 3 as family, p_partkey % 13 = 0 as product, p_partkey % 7 > 4 as cross_p, p_partkey % 6 = 1 as unique_code, p_size % 3 = 0 as absorbable, p_size % 17 = 0 as single, p_partkey % 8 <> 1 as code, p_size % 9 = 0 as absent from part),
g as (select *, blocked and duplicate as scope, one_target and pair and one_item and not split and not semantic and not quantity and (family or product) as strong from f)
select case when scope and strong then 'high' when scope and not split and not semantic and not absent and (unique_code or absorbable or quantity or single or (code and family)) then 'medium' else 'not_candidate' end as tier,
  scope and (split or (pair and not one_item) or semantic or (cross_p and not unique_code) or (not code and not absent)) as conflict, count(*) as n_items from g group by 1, 2""")
def promotion_tiers(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    flags = {
        "blocked": size > 10, "duplicate": k % 3 != 0, "one_target": k % 4 != 0, "pair": k % 2 == 0, "one_item": k % 5 != 0, "split": k % 11 == 0, "semantic": F.col("p_name").like("%red%"), "quantity": size > 45, "same_family": k % 7 < 3, "same_product": k % 13 == 0,
        "cross_product": k % 7 > 4, "unique_code": k % 6 == 1, "absorbable": size % 3 == 0, "single_risk": size % 17 == 0, "code": k % 8 != 1, "absent": size % 9 == 0,
    }
    found = t(spark, sf, "part").select(*(c.alias(n) for n, c in evidence.promotion(flags).items()))
    return found.groupBy("tier", "conflict").agg(F.count("*").alias("n_items"))


@query("""with f as (select p_size > 10 as blocked, p_partkey % 10 = 0 as confirmed, p_partkey % 3 = 0 as risk, p_partkey % 2 = 0 as pair, p_partkey % 5 <> 0 as one_item, p_partkey % 7 <> 0 as one_own, p_size % 3 = 0 as option_only, p_size % 4 = 0 as product_only, p_size % 5 = 0 as absorbable from part)
select case when not blocked or confirmed then null when risk then 'residual' when pair and one_item and one_own then 'high' when option_only or product_only or absorbable then 'medium' else 'residual' end as tier, count(*) as n_items from f group by 1""")
def strict_promotion(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    flags = {"blocked": size > 10, "confirmed": k % 10 == 0, "true_risk": k % 3 == 0, "pair": k % 2 == 0, "one_item": k % 5 != 0, "one_own": k % 7 != 0, "option_only": size % 3 == 0, "product_only": size % 4 == 0, "absorbable": size % 5 == 0}
    return t(spark, sf, "part").groupBy(evidence.strict_promotion(flags).alias("tier")).agg(F.count("*").alias("n_items"))


@query("""with i as (select p_partkey as item, 'S' || (p_partkey // 2) as shared, 'C' || p_partkey as code, p_name like '%red%' as risk from part union all select p_partkey, 'S' || (p_partkey // 2), 'D' || (p_partkey // 3), false from part where p_partkey % 11 = 0 union all select p_partkey, 'S' || (p_partkey // 2), ' ', null from part),
m as (select 'C' || p_partkey as code, 'P' || (p_partkey // 4) as product, 'O' || (p_partkey % case when p_size % 3 = 0 then 2 else 4 end) as option from part where p_partkey % 13 <> 0 union all select 'C' || p_partkey, null, ' ' from part where p_partkey % 13 = 0 union all select 'C' || p_partkey, 'P0', 'O9' from part where p_partkey % 17 = 0
  union all select 'C' || p_partkey, 'Q' || p_partkey, null from part where p_partkey % 26 = 0 union all select 'D' || p_partkey, 'P' || p_partkey, 'O1' from part where p_partkey % 5 = 0),
b as (select item, min(shared) as shared, coalesce(bool_or(risk), false) as risk from i group by 1), c as (select distinct item, trim(code) as code from i where trim(code) <> ''), h as (select distinct code, nullif(trim(product), '') as product, nullif(trim(option), '') as option from m where trim(coalesce(product, '')) <> '' or trim(coalesce(option, '')) <> ''),
f as (select item, count(distinct concat_ws('|', product, option)) as n_pairs, min(product) as product, min(option) as option from c join h using (code) group by 1), r as (select b.*, coalesce(n_pairs, 0) as n_pairs, product, option from b left join f using (item)), s as (select * from r where n_pairs = 1),
p as (select product, option, count(distinct item) as n_items from s where product is not null and option is not null group by 1, 2), q as (select shared, count(distinct product) as n_products from s group by 1)
select r.item, r.n_pairs, case when r.n_pairs = 1 then r.product end as product, case when r.n_pairs = 1 then r.option end as option, case when r.n_pairs = 1 then coalesce(p.n_items, 0) end as n_items, case when r.n_pairs = 1 then coalesce(q.n_products, 0) end as n_products, risk,
  case when r.n_pairs = 0 then 'evidence_missing' when r.n_pairs > 1 then 'duplicate_evidence' when p.n_items > 1 then 'duplicate_pair' when q.n_products > 1 then 'duplicate_product' when coalesce(p.n_items, 0) = 0 or coalesce(q.n_products, 0) = 0 then 'half_pair' when risk then 'risk' else 'clean' end as verdict
from r left join p on r.n_pairs = 1 and p.product = r.product and p.option = r.option left join q on r.n_pairs = 1 and q.shared = r.shared""")
def unique_evidence(spark, sf):
    part, k, size = t(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    text = lambda letter, x: F.concat(F.lit(letter), F.floor(x).cast("string"))
    shared = text("S", k / 2).alias("shared")
    items = part.select(k.alias("item"), shared, text("C", k).alias("code"), F.col("p_name").like("%red%").alias("risk"))
    items = items.union(part.where("p_partkey % 11 = 0").select(k, shared, text("D", k / 3), F.lit(False))).union(part.select(k, shared, F.lit(" "), F.lit(None).cast("boolean")))
    mapping = part.where("p_partkey % 13 != 0").select(text("C", k).alias("code"), text("P", k / 4).alias("product"), text("O", k % F.when(size % 3 == 0, 2).otherwise(4)).alias("option"))
    for rule, row in (("% 13 = 0", [text("C", k), F.lit(None), F.lit(" ")]), ("% 17 = 0", [text("C", k), F.lit("P0"), F.lit("O9")]), ("% 26 = 0", [text("C", k), text("Q", k), F.lit(None)]), ("% 5 = 0", [text("D", k), text("P", k), F.lit("O1")])):
        mapping = mapping.union(part.where(f"p_partkey {rule}").select(*row))
    return evidence.unique_evidence(items, mapping)


@query("""with r as (select distinct l_partkey as item, l_suppkey as code, l_returnflag as source from lineitem),
x as (select *, count(*) over (partition by item) - count(*) over (partition by item, code) - count(*) over (partition by item, source) + 1 > 0 as code_conflict,
  count(*) over (partition by code) - count(*) over (partition by code, item) - count(*) over (partition by code, source) + 1 > 0 as item_conflict from r)
select * from x where code_conflict or item_conflict""")
def source_conflict(spark, sf):
    """Over all lines, by return flag; source_conflict_lines takes the line status into the source too."""
    rows = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("code"), F.col("l_returnflag").alias("source"))
    return relational.source_conflicts(rows, "item", "code", "source")


@query("""with r as (select distinct l_partkey as item, l_suppkey as code, l_linestatus || l_returnflag as source from lineitem),
x as (select *, count(*) over (partition by item) - count(*) over (partition by item, code) - count(*) over (partition by item, source) + 1 > 0 as code_conflict,
  count(*) over (partition by code) - count(*) over (partition by code, item) - count(*) over (partition by code, source) + 1 > 0 as item_conflict from r)
select * from x where code_conflict or item_conflict""")
def source_conflict_lines(spark, sf):
    """As source_conflict, over all lines; the SQL counts too, as its EXISTS with <> would be slow here."""
    rows = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("code"), F.concat("l_linestatus", "l_returnflag").alias("source"))
    return relational.source_conflicts(rows, "item", "code", "source")


@query("""with d as (select doc_id, regexp_replace(text, '(\\r\\n|\\r|\\n)+$', '') as c from documents), l as (select doc_id, regexp_split_to_array(c, '\\r\\n|\\r|\\n') as c from d),
x as (select doc_id, c, case when doc_id % 3 = 0 then list_prepend('head', c) when doc_id % 3 = 1 then c else ['only', 'two', 'or', 'four', 'lines', 'of', 'other', 'length', 'than', 'codes', 'have', 'here'] end as o from l),
a as (select *, case when len(o) = len(c) then 'direct' when len(o) = len(c) + 1 then 'header' else 'needs_review' end as alignment from x),
e as (select doc_id, c, o, alignment, unnest(range(1, len(c) + 1)) as line_no from a)
select doc_id, line_no, md5(trim(c[line_no])) as code, md5(trim(case alignment when 'header' then o[line_no + 1] when 'direct' then o[line_no] end)) as option, alignment from e""")
def multiline_align(spark, sf):
    docs = t(spark, sf, "documents").repartition(32, "doc_id")  # the table may be one row group, which one task would cut into lines
    other = F.lit("\n".join("only two or four lines of other length than codes have here".split()))
    rows = docs.select("doc_id", F.col("text").alias("c"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("head\n"), "text")).when(F.col("doc_id") % 3 == 1, F.col("text")).otherwise(other).alias("o"), F.lit("").alias("s"))
    return evidence.aligned_lines(rows, "doc_id", "c", "o", "s").select("doc_id", "line_no", F.md5("code").alias("code"), F.md5("option").alias("option"), "alignment")


@query("""with second as (select case when o_orderkey % 6 = 0 then o_orderkey // 8 else -1 - o_orderkey end as item, cast(null as varchar) as own, case when o_orderkey % 7 <> 0 then o_orderpriority end as product, cast(o_custkey % 3 as varchar) as option from orders union all select null, case when o_orderkey % 997 = 0 then 'Brand#' || (o_orderkey % 60) else 'Other' || o_orderkey end, o_orderpriority, '1' from orders),
i as (select item, count(distinct product) as np, min(product) as p, count(distinct option) as no, min(option) as o from second where item is not null group by 1), w as (select own, count(distinct product) as np, min(product) as p, count(distinct option) as no, min(option) as o from second where own is not null group by 1),
r as (select p_partkey, p_brand, case when p_size % 5 <> 0 then '1-URGENT' end as product, case when p_size % 7 <> 0 then cast(p_size % 3 as varchar) end as option, p_partkey % 4 <> 0 as compares from part),
j as (select r.*, i.item is not null or w.own is not null as found, case when i.item is not null then case when i.np = 1 then i.p end else case when w.np = 1 then w.p end end as p, case when i.item is not null then case when i.no = 1 then i.o end else case when w.no = 1 then w.o end end as o
  from r left join i on i.item = p_partkey left join w on w.own = p_brand)
select p_partkey, case when not found then 'none' when p is null or o is null then 'incomplete' when compares and coalesce(product = p, false) and coalesce(option = o, false) then 'supported' when compares and (coalesce(product <> p, false) or coalesce(option <> o, false)) then 'conflict' else 'relaxed' end as support from j""")
def evidence_support(spark, sf):
    orders, k = t(spark, sf, "orders"), F.col("o_orderkey")
    second = orders.select(F.when(k % 6 == 0, F.floor(k / 8)).otherwise(-1 - k).alias("item"), F.lit(None).cast("string").alias("own"), F.when(k % 7 != 0, F.col("o_orderpriority")).alias("product"), (F.col("o_custkey") % 3).cast("string").alias("option"))
    second = second.union(orders.select(F.lit(None).cast("long"), F.when(k % 997 == 0, F.concat(F.lit("Brand#"), (k % 60).cast("string"))).otherwise(F.concat(F.lit("Other"), k.cast("string"))), "o_orderpriority", F.lit("1")))
    size = F.col("p_size")
    rows = t(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("own"), F.when(size % 5 != 0, "1-URGENT").alias("product"), F.when(size % 7 != 0, (size % 3).cast("string")).alias("option"), (F.col("p_partkey") % 4 != 0).alias("compares"))
    return evidence.evidence_support(rows, second).select(F.col("item").alias("p_partkey"), "support")


@query("""with a as (select distinct upper(trim(c_name)) as v, c_nationkey as target from customer), r as (select s_suppkey, s_name, 'customer#' || lpad(cast(s_suppkey as varchar), 9, '0') as c2 from supplier),
x as (select s_suppkey, 's_name' as type, upper(trim(s_name)) as v from r union all select s_suppkey, 'c2', upper(trim(c2)) from r), f as (select s_suppkey, count(distinct target) as n, bool_or(type = 's_name') as d from x join a using (v) group by 1)
select s_suppkey, coalesce(n, 0) as n_targets, coalesce(d, false) as direct from supplier left join f using (s_suppkey)""")
def cross_source(spark, sf):
    rows = t(spark, sf, "supplier").select("s_suppkey", "s_name", F.concat(F.lit("customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("c2"))
    alias = t(spark, sf, "customer").select(F.col("c_name").alias("value"), F.col("c_nationkey").alias("target"))
    return evidence.cross_source_matches(rows, "s_suppkey", ["s_name", "c2"], alias)


# ---- options, stock, review ----------------------------------------------------------------------------------------------

TERMS = [("colour", "red", "token"), ("colour", "blue", "contains"), ("metal", "steel", "contains"), ("metal", "brass", "token"), ("finish", "polished", "contains"), ("finish", "a", "contains")]


@query("""with n as (select p_partkey, lower(regexp_replace(p_name || ' ' || p_type, '[^\\p{L}\\p{N}]+', '', 'g')) as f, ' ' || trim(lower(regexp_replace(p_name || ' ' || p_type, '[^\\p{L}\\p{N}]+', ' ', 'g'))) || ' ' as s from part)
select p_partkey, case when contains(f, 'steel') then 'metal' when contains(s, ' brass ') then 'metal' when contains(f, 'polished') then 'finish' when contains(f, 'blue') then 'colour' when contains(s, ' red ') then 'colour' when contains(f, 'a') then 'finish' end as category,
  case when contains(f, 'steel') then 'steel' when contains(s, ' brass ') then 'brass' when contains(f, 'polished') then 'polished' when contains(f, 'blue') then 'blue' when contains(s, ' red ') then 'red' when contains(f, 'a') then 'a' end as term from n""")
def dict_normalise(spark, sf):
    hit = options.dictionary_term(F.concat_ws(" ", "p_name", "p_type"), TERMS, pinned="metal")
    return t(spark, sf, "part").select("p_partkey", hit.alias("h")).select("p_partkey", "h.category", "h.term")


@query("""select doc_id, (text ilike '%token%' or text ilike '%@%') as personal, (text ilike '%copyright%' or text ilike '%license%') as legal, text ilike '%the%' as common,
  array_to_string(list_filter([case when text ilike '%token%' or text ilike '%@%' then 'personal' end, case when text ilike '%copyright%' or text ilike '%license%' then 'legal' end, case when text ilike '%the%' then 'common' end], lambda x: x is not null), ',') as reasons from documents""")
def risk_flags(spark, sf):
    flags = options.risk_flags(F.col("text"), {"personal": ["token", "@"], "legal": ["copyright", "license"], "common": ["the"]})
    return t(spark, sf, "documents").select("doc_id", *(c.alias(k) for k, c in flags.items()), options.joined_reasons(flags).alias("reasons"))


@query("""with r as (select case when l_partkey % 17 = 0 then null when l_partkey % 19 = 0 then 0 when l_partkey % 23 = 0 then -5 when l_partkey % 29 = 0 then -100 else l_quantity end as a, case when l_suppkey % 23 = 0 then null when l_suppkey % 7 = 0 then 0.0 when l_suppkey % 11 = 0 then -101 else l_quantity - 25 + l_partkey % 40 end as b from lineitem)
select case when a is null or b is null then 'RECHECK_REQUIRED' when a = b then 'NO_CHANGE' when b = 0 and a > 0 then 'ZERO_OUT' when a < b then 'INCREASE' when a - b >= 20 or (case when a > 0 then (a - b) / a else 0 end) >= 0.5 then 'LARGE_DECREASE' else 'SMALL_DECREASE' end as bucket, count(*) as n_rows from r group by 1""")
def stock_buckets(spark, sf):
    q, p, s = F.col("l_quantity"), F.col("l_partkey"), F.col("l_suppkey")
    a = F.when(p % 17 == 0, "n/a").when(p % 19 == 0, " ").when(p % 23 == 0, "-5").when(p % 29 == 0, "-100").otherwise(F.concat(q.cast("string"), F.lit(" ")))
    b = F.when(s % 23 == 0, "abc").when(s % 7 == 0, "0").when(s % 11 == 0, "-101").otherwise((q - 25 + p % 40).cast("string"))
    rows = t(spark, sf, "lineitem").select(a.alias("current"), b.alias("proposed"))
    return rows.select(stock.stock_bucket(F.col("current"), F.col("proposed")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n_rows"))


@query("""with s as (select user_id, event_id, case when event_type = 'click' then value end as a, value as b from events), l as (select *, row_number() over (partition by user_id order by event_id desc) as r, count(*) over (partition by user_id) - 1 as d from s)
select c_custkey as user_id, coalesce(a, b) as stock, d as duplicates from customer left join l on user_id = c_custkey and r = 1""")
def latest_overlay(spark, sf):
    snapshot = t(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("a"), F.col("value").alias("b"))
    return stock.latest_overlay(t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")), snapshot, "user_id", "event_id", ["a", "b"])


@query("""with r as (select *, (['x', 'y', 'z'])[1:o_orderkey % 4] as tags, ['hold', 'candidate', 'excluded', 'stock_match', 'no_match', 'other'][case when o_orderkey % 9 < 5 then o_orderkey % 2 + 1 else o_orderkey % 6 + 1 end] as b from orders)
select o_custkey, o_orderpriority, max(o_orderkey) filter (o_orderstatus = 'F') as "at_F", max(o_orderkey) filter (o_orderstatus = 'O') as "at_O", coalesce(max(o_orderkey) filter (o_totalprice > 200000), max(o_orderkey)) as primary_row,
  cast(sum(o_orderkey % 4) as bigint) as duplicates, count(*) as n_rows, array_to_string((list(tags order by len(tags) desc, o_orderkey))[1], ',') as tags,
  case when bool_or(b = 'excluded') then 'excluded' when bool_or(b = 'no_match') then 'no_match' when bool_or(b = 'hold') then 'hold' when bool_or(b = 'candidate') then 'candidate' when bool_or(b = 'stock_match') then 'stock_match' else 'hold' end as bucket,
  (select string_agg(g, ',' order by first_o, first_i) from (select g, min(o) as first_o, arg_min(i, o) as first_i from (select o_orderkey as o, 1 as i, 'g' || (o_orderkey % 3) || '|s' as g from orders x where x.o_custkey = r.o_custkey and x.o_orderpriority = r.o_orderpriority
    union all select o_orderkey, 2, 'g' || (o_orderkey % 2) || '|' from orders x where x.o_custkey = r.o_custkey and x.o_orderpriority = r.o_orderpriority) group by 1)) as shared_tags from r group by 1, 2""")
def group_matrix(spark, sf):
    k = F.col("o_orderkey")
    tag = lambda n, scope: F.struct(F.lit(None).cast("long").alias("tag_id"), F.concat(F.lit("g"), n.cast("string")).alias("tag_name"), scope.cast("string").alias("tag_scope"), F.lit(None).cast("string").alias("assignment_id"))
    names = F.array(*(F.lit(x) for x in ("hold", "candidate", "excluded", "stock_match", "no_match", "other")))
    rows = t(spark, sf, "orders").withColumns({"dup": k % 4, "t": F.slice(F.array(F.lit("x"), F.lit("y"), F.lit("z")), F.lit(1), (k % 4).cast("int")), "b": F.get(names, F.when(k % 9 < 5, k % 2).otherwise(k % 6).cast("int")), "s": F.array(tag(k % 3, F.lit("s")), tag(k % 2, F.lit(None)))})
    out = review.group_matrix(rows, ["o_custkey", "o_orderpriority"], "o_orderstatus", "o_orderkey", F.col("o_totalprice") > 200000, "dup", ["F", "O"], tags="t", bucket="b", shared_tags="s")
    shown = F.transform("shared_tags", lambda x: F.concat(x.tag_name, F.lit("|"), F.coalesce(x.tag_scope, F.lit(""))))
    return out.withColumns({"tags": F.array_join("tags", ","), "shared_tags": F.array_join(shown, ",")})


QUEUE = """q as (select o_orderkey, case o_orderkey % 4 when 0 then 'AUTO_APPROVE_CANDIDATE' when 1 then 'FAST_REVIEW' when 2 then 'REVIEW' else 'NO_MATCH' end as tier, case when o_orderkey % 5 = 0 then 'set of ' || o_orderpriority when o_orderkey % 7 = 0 then 'offset name' else 'name code' end as reason,
  case when o_orderkey % 9 <> 0 then 'C' || o_custkey else ' ' end as code, o_orderkey % 6 as dup from orders)"""


# Texts of actions, by o_orderkey % 13.
ACTIONS = ["단종 상품", "discontinued", "보조옵션", "code blank", "코드공백", "코드공란", "sets", "my_set", "bundle", "추가상품", "plain", None, "name"]


def _queue(spark, sf):
    k = F.col("o_orderkey")
    return t(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 4 == 0, "AUTO_APPROVE_CANDIDATE").when(k % 4 == 1, "FAST_REVIEW").when(k % 4 == 2, "REVIEW").otherwise("NO_MATCH").alias("tier"),
        F.when(k % 5 == 0, F.concat(F.lit("set of "), "o_orderpriority")).when(k % 7 == 0, "offset name").otherwise("name code").alias("reason"),
        F.when(k % 9 != 0, F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).otherwise(" ").alias("code"), (k % 6).alias("dup"),
    )


@query(f"""with {QUEUE}, r as (select *, {{texts}}[o_orderkey % 13 + 1] as action, ['STOCK_MATCH', 'STOCK_DIFF', 'STOCK_SMARTSTORE_NOT_FOUND', null][o_orderkey // 4 % 4 + 1] as stock, case when o_orderkey % 16 = 15 then 'MANUAL_LINKED' else tier end as tier2 from q), x as (select *, lower(tier2 || ' ' || coalesce(action, '') || ' ' || reason) as b from r)
select case when tier2 = 'NO_MATCH' then 'no_match' when regexp_matches(b, '단종|삭제|제외|excluded|discontinued|hidden') then 'excluded' when regexp_matches(b, '세트|조합|bundle|set($|[^a-z0-9_])') then 'bundle' when regexp_matches(b, '보조옵션|보조 옵션|하위옵션|suboption|추가상품') then 'suboption'
    when regexp_matches(b, '코드 근거|코드공란|코드 공란|자사코드 공란|code blank|blank code') then 'code_blank' when tier2 in ('AUTO_APPROVE_CANDIDATE', 'FAST_REVIEW', 'MANUAL_LINKED') then 'candidate' when stock = 'STOCK_MATCH' then 'stock_match' when stock = 'STOCK_DIFF' then 'stock_diff' when stock = 'STOCK_SMARTSTORE_NOT_FOUND' then 'stock_missing' else 'hold' end as browser,
  case when tier2 = 'NO_MATCH' then 'no_match' when regexp_matches(b, '단종|삭제|제외|excluded|discontinued|hidden') then 'excluded' when regexp_matches(b, '세트|조합|bundle|(^|[^a-z0-9])set([^a-z0-9]|$)') then 'bundle' when regexp_matches(b, '보조옵션|보조 옵션|하위옵션|suboption|추가상품') then 'suboption'
    when regexp_matches(b, '코드 근거|코드공백|코드 공백|자사코드 공백|code blank|blank code') then 'code_blank' when tier2 in ('AUTO_APPROVE_CANDIDATE', 'MANUAL_LINKED') then 'candidate' when stock = 'STOCK_MATCH' then 'stock_match' when stock = 'STOCK_DIFF' then 'stock_diff' when stock = 'STOCK_SMARTSTORE_NOT_FOUND' then 'stock_missing' else 'hold' end as summary,
  case when tier2 = 'AUTO_APPROVE_CANDIDATE' then tier2 when tier2 = 'FAST_REVIEW' and dup <= 3 and contains(reason, 'name') and (contains(reason, 'code') or contains(reason, 'exact')) then 'APPROVAL_CANDIDATE_CODE_EVIDENCE_WEAK' when tier2 = 'FAST_REVIEW' then 'FAST_REVIEW_REQUIRED' else tier2 end as policy, count(*) as n_rows from x group by 1, 2, 3""".replace("{texts}", str(ACTIONS).replace("None", "null")))
def workflow_bucket(spark, sf):
    k, reason = F.col("o_orderkey"), F.col("reason")
    tier, action = F.when(k % 16 == 15, "MANUAL_LINKED").otherwise(F.col("tier")), F.get(F.array(*(F.lit(x).cast("string") for x in ACTIONS)), (k % len(ACTIONS)).cast("int"))
    stocked = F.get(F.array(*(F.lit(x).cast("string") for x in ("STOCK_MATCH", "STOCK_DIFF", "STOCK_SMARTSTORE_NOT_FOUND", None))), (F.floor(k / 4) % 4).cast("int"))
    rows = _queue(spark, sf).select(*(review.workflow_bucket(tier, [tier, action, reason], stocked, r).alias(r) for r in review.WORKFLOW), review.policy_tier(tier, F.col("dup"), reason, "name", ("code", "exact")).alias("policy"))
    return rows.groupBy("browser", "summary", "policy").agg(F.count("*").alias("n_rows"))


@query("""with f as (select o_orderkey as k, o_orderstatus as channel, o_orderkey % 11 = 0 as source_conflict, o_orderkey % 7 = 0 as warning, o_orderkey % 5 = 0 as duplicate_sku, o_orderkey % 13 = 0 as narrow_risk, o_orderkey % 3 = 0 as evidence_missing, case when o_orderkey % 17 = 0 then true when o_orderkey % 2 = 0 then false end as absent_possible,
    o_orderkey % 19 = 0 as alias_conflict, o_orderkey % 23 = 0 as mapping_conflict, o_orderkey % 29 = 0 as duplicate_evidence, case when o_orderkey % 3 <> 0 then o_orderkey % 4 end as n, o_orderkey % 8 < 4 as direct, o_orderkey % 31 = 0 as same_target from orders)
select md5(channel || '|' || k) as review_id, channel, k as o_orderkey, case when source_conflict then 'source_conflict' when duplicate_evidence or duplicate_sku then 'duplicate' when n = 1 and direct then 'direct' when n = 1 then 'unique' when coalesce(n, 0) = 0 then 'missing' else 'needs_review' end as evidence_level,
  case when source_conflict then 'source_conflict' when warning then 'warning_bucket' when duplicate_sku then 'duplicate_sku' when narrow_risk then 'narrow_risk' when evidence_missing then 'evidence_missing' when absent_possible then 'channel_absent_or_inactive_possible' when alias_conflict or mapping_conflict then 'existing_conflict' else 'manual_review_required' end as risk_type,
  concat_ws(',', case when source_conflict then 'source_conflict' end, case when warning then 'warning' end, case when duplicate_sku then 'duplicate_sku' end, case when narrow_risk then 'narrow_risk' end, case when evidence_missing then 'evidence_missing' end, case when absent_possible then 'absent_possible' end, case when alias_conflict then 'alias_conflict' end, case when mapping_conflict then 'mapping_conflict' end) as reasons,
  case when absent_possible then 'classify_channel_absent_or_inactive' when source_conflict then 'compare_conflicting_candidates' when warning then 'inspect_source_warning' when duplicate_sku or duplicate_evidence then 'compare_duplicate_candidates' when narrow_risk then 'manual_option_risk_review' when evidence_missing then 'find_or_mark_missing_evidence' when alias_conflict or mapping_conflict then 'do_not_overwrite_existing_mapping' else 'manual_match_review' end as action,
  case when absent_possible then 'deletion_or_inactive_review_candidate' else 'manual_matching_candidate' end as scope
from f where not same_target and (source_conflict or warning or duplicate_sku or narrow_risk or evidence_missing or coalesce(absent_possible, false) or alias_conflict or mapping_conflict or channel = 'P')""")
def review_workbench(spark, sf):
    k = F.col("o_orderkey")
    flags = {"source_conflict": k % 11 == 0, "warning": k % 7 == 0, "duplicate_sku": k % 5 == 0, "narrow_risk": k % 13 == 0, "evidence_missing": k % 3 == 0, "absent_possible": F.when(k % 17 == 0, True).when(k % 2 == 0, False), "alias_conflict": k % 19 == 0, "mapping_conflict": k % 23 == 0}
    more = {"duplicate_evidence": k % 29 == 0, "n_items": F.when(k % 3 != 0, k % 4), "direct": k % 8 < 4, "same_target": k % 31 == 0}
    rows = t(spark, sf, "orders").select(F.col("o_orderstatus").alias("channel"), "o_orderkey", *(c.alias(n) for n, c in (flags | more).items()))
    return review.workbench(rows, ["channel", "o_orderkey"], F.col("channel") == "P")


@query("""with r as (select o_orderkey, o_custkey, unnest(list_filter(['random', case when o_totalprice > 250000 then 'dear' end, case when o_orderstatus = 'F' then 'done' end], lambda x: x is not null)) as bucket from orders),
s as (select *, count(*) over (partition by bucket) as bucket_size, row_number() over (partition by bucket order by case when bucket = 'random' then md5(o_orderkey || bucket) else lpad(coalesce(cast(nullif(o_custkey, 7) as varchar), ''), 32, '0') || o_orderkey end, o_orderkey) as sample_rank from r) select bucket, bucket_size, sample_rank, o_orderkey from s where sample_rank <= 20""")
def stratified_sample(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.nullif("o_custkey", F.lit(7)).alias("code"))
    out = relational.stratified_sample(orders, {"random": F.lit(True), "dear": F.col("o_totalprice") > 250000, "done": F.col("o_orderstatus") == "F"}, "o_orderkey", "code")
    return out.select("bucket", "bucket_size", "sample_rank", "o_orderkey")


@query("""with r as (select p_partkey, string_split(p_name, ' ') as a, case when p_size % 3 = 0 then [] else string_split(p_type, ' ') end as b, p_size from part), n as (select *, greatest(len(a), len(b)) as n from r), e as (select *, unnest(range(1, n + 1)) as place from n)
select p_partkey, n as n_candidates, cast(case when n <= 2 then 10000 else 0 end + 100 * p_size - n as bigint) as priority, place, a[place] as names, b[place] as types from e""")
def template_long(spark, sf):
    rows = t(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("|")).alias("names"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.replace("p_type", F.lit(" "), F.lit("|"))).alias("types"), "p_size")
    return review.long_template(rows, "p_partkey", ["names", "types"], "p_size", 2)


@query("""with x as (select c_custkey as k, case when c_custkey % 10 = 0 then null when c_custkey % 6 = 1 then 'XX-' || c_custkey when c_custkey % 6 = 2 then 'boxx' || c_custkey else 'k' || c_custkey end as code, case when c_custkey % 9 = 0 then ' [XX] ring' when c_custkey % 9 = 1 then 'foxx' end as name,
    case when c_custkey % 7 = 0 then 'fill ffc000' when c_custkey % 7 = 1 then '노랑 주황' when c_custkey % 7 = 2 then 'red' end as hints, case when c_custkey % 5 = 0 then 'note shop_excluded' when c_custkey % 5 = 1 then 'unexcluded' end as marks, c_custkey % 4 = 0 as known, case when c_custkey % 8 = 0 then ['discontinued', 'discontinued'] when c_custkey % 8 = 3 then ['late'] end as listed from customer),
f as (select *, list_filter([case when regexp_matches(coalesce(code, ''), '(?i)(^|[^a-z0-9])xx([^a-z0-9]|$)') or regexp_matches(coalesce(name, ''), '(?i)^\\s*\\[?xx') then 'xx' end, case when regexp_matches(coalesce(hints, ''), 'orange|주황|ffc000|ff9900|ff7a00') then 'orange' end, case when regexp_matches(coalesce(hints, ''), 'yellow|노랑|노란|ffff00|ffe65a') then 'yellow' end], lambda v: v is not null) as h from x)
select k as c_custkey, case when known then case when listed is not null then 'discontinued' else '' end else array_to_string(list_concat(coalesce(listed, []), case when len(h) > 0 then h when regexp_matches(coalesce(marks, ''), '(^|\\s)(true|1|yes|y|exclude|excluded|md_excluded|shop_excluded)(\\s|$)') then ['explicit'] else [] end), ',') end as excluded from f""")
def exclusion_overlay(spark, sf):
    k = F.col("c_custkey")
    text = k.cast("string")
    code = F.when(k % 10 == 0, None).when(k % 6 == 1, F.concat(F.lit("XX-"), text)).when(k % 6 == 2, F.concat(F.lit("boxx"), text)).otherwise(F.concat(F.lit("k"), text))
    name, hints = F.when(k % 9 == 0, " [XX] ring").when(k % 9 == 1, "foxx"), F.when(k % 7 == 0, "fill ffc000").when(k % 7 == 1, "노랑 주황").when(k % 7 == 2, "red")
    marks, listed = F.when(k % 5 == 0, "note shop_excluded").when(k % 5 == 1, "unexcluded"), F.when(k % 8 == 0, F.array(F.lit("discontinued"), F.lit("discontinued"))).when(k % 8 == 3, F.array(F.lit("late")))
    return t(spark, sf, "customer").select("c_custkey", review.exclusion(k % 4 == 0, listed, code, name, hints, marks, "shop").alias("excluded"))


@query("""with r as (select p_partkey as k, ['one', 'two'][p_partkey % 2 + 1] as channel, ['REVIEW', 'NO_MATCH', 'REVIEW', 'FAST_REVIEW'][p_partkey // 2 % 4 + 1] as tier, 'P' || (p_partkey // 12) as product_code, case when p_partkey % 3 = 0 then 'O1' else 'O' || p_partkey end as option_code, case when p_partkey % 41 <> 0 then 'IP' || (p_partkey // 24) end as item_product, case when p_partkey % 43 <> 0 then 'I1' end as item,
    p_name as name, case p_partkey % 5 when 0 then upper(p_name) || '.' when 1 then '<' || p_name || '> plus' when 4 then p_type else replace(p_name, ' ', '_') end as item_name, case p_partkey % 7 when 0 then '[x] ' || p_brand || '=rest' when 1 then p_brand || '-모델착용' else p_brand end as option, case when p_partkey % 11 = 0 then p_type else lower(p_brand) || ' ' end as item_option,
    case when p_partkey % 17 = 0 then 'a SET of' when p_partkey % 19 = 0 then '세트' when p_partkey % 23 = 0 then 'abc sets' end as reason, case when p_partkey % 4 < 2 then '자동 승인하지 않음' when p_partkey % 13 <> 0 then 'ok' end as action, case when p_partkey % 29 = 0 then 2 when p_partkey % 2 = 0 then 1 end as duplicates, case when p_partkey % 31 = 0 then 'true' end as duplicate_risk,
    case when p_partkey % 37 = 0 then 'STOCK_DIFF' when p_partkey % 3 = 0 then 'STOCK_MATCH' end as stock, case when p_partkey % 6 = 5 then true when p_partkey % 6 = 4 then false end as tagged from part),
c as (select *, lower(concat_ws(' ', name, option, item_name, item_option, reason, action)) as b, lower(regexp_replace(name, '[\\s\\[\\](){}<>_\\-./|]+', '', 'g')) as n1, lower(regexp_replace(item_name, '[\\s\\[\\](){}<>_\\-./|]+', '', 'g')) as n2,
    lower(regexp_replace(replace(regexp_replace(regexp_replace(option, '\\[[^\\]]*\\]', '', 'g'), '=.*$', '', 'g'), '-모델착용', ''), '[\\s\\[\\](){}<>_\\-./|,*]+', '', 'g')) as o1, lower(regexp_replace(item_option, '[\\s\\[\\](){}<>_\\-./|,*]+', '', 'g')) as o2 from r),
s as (select *, n1 = n2 as exact, action = '자동 승인하지 않음' as held, tier in ('REVIEW', 'NO_MATCH') and item_product is not null and item is not null and coalesce(duplicates, 0) <= 1 and coalesce(duplicate_risk, '') <> 'true' and coalesce(stock, 'STOCK_MATCH') = 'STOCK_MATCH' and not contains(b, '세트') and not regexp_matches(b, '(^|[^a-z0-9가-힣])(ab|set)([^a-z0-9가-힣]|$)')
    and (contains(n1, n2) or contains(n2, n1)) and o1 = o2 and not coalesce(tagged, false) as strict from c),
u as (select channel, product_code, option_code from s where strict and held and exact and channel = 'two' group by all having count(distinct item_product || '|' || item) = 1)
select k as p_partkey, case when strict and not held and exact then 'P1A' when strict and not held then 'P1B' when strict and held and exact and s.channel = 'two' and u.channel is not null then 'P2' end as approval from s left join u using (channel, product_code, option_code)""")
def auto_approval(spark, sf):
    k, name, brand = F.col("p_partkey"), F.col("p_name"), F.col("p_brand")
    text = lambda letter, x: F.concat(F.lit(letter), F.floor(x).cast("string"))
    tiers = F.array(*(F.lit(x) for x in ("REVIEW", "NO_MATCH", "REVIEW", "FAST_REVIEW")))
    rows = t(spark, sf, "part").select(
        "p_partkey", F.when(k % 2 == 0, "one").otherwise("two").alias("channel"), F.get(tiers, (F.floor(k / 2) % 4).cast("int")).alias("tier"), text("P", k / 12).alias("product_code"), F.when(k % 3 == 0, "O1").otherwise(text("O", k)).alias("option_code"), F.when(k % 41 != 0, text("IP", k / 24)).alias("item_product"), F.when(k % 43 != 0, "I1").alias("item"),
        name.alias("name"), F.when(k % 5 == 0, F.concat(F.upper(name), F.lit("."))).when(k % 5 == 1, F.concat(F.lit("<"), name, F.lit("> plus"))).when(k % 5 == 4, F.col("p_type")).otherwise(F.replace(name, F.lit(" "), F.lit("_"))).alias("item_name"),
        F.when(k % 7 == 0, F.concat(F.lit("[x] "), brand, F.lit("=rest"))).when(k % 7 == 1, F.concat(brand, F.lit("-모델착용"))).otherwise(brand).alias("option"), F.when(k % 11 == 0, F.col("p_type")).otherwise(F.concat(F.lower(brand), F.lit(" "))).alias("item_option"),
        F.when(k % 17 == 0, "a SET of").when(k % 19 == 0, "세트").when(k % 23 == 0, "abc sets").alias("reason"), F.when(k % 4 < 2, review.HOLD_ACTION).when(k % 13 != 0, "ok").alias("action"), F.when(k % 29 == 0, 2).when(k % 2 == 0, 1).alias("duplicates"), F.when(k % 31 == 0, "true").alias("duplicate_risk"),
        F.when(k % 37 == 0, "STOCK_DIFF").when(k % 3 == 0, "STOCK_MATCH").alias("stock"), F.when(k % 6 == 5, True).when(k % 6 == 4, False).alias("tagged"),
    )
    return review.auto_approval(rows, "two").select("p_partkey", "approval")


@query("""with g as (select distinct 'p_brand' as scope, p_brand as key, 'brand' as t from part where p_size = 1 union select distinct 'p_type', p_type, x from part, (values ('typed'), ('brand')) v(x) where p_size = 50)
select p_partkey, coalesce((select string_agg(distinct t, ',' order by t) from g where (scope = 'p_brand' and key = p_brand) or (scope = 'p_type' and key = p_type)), '') as tag_names from part""")
def shared_tags(spark, sf):
    part = t(spark, sf, "part")
    tags = part.where("p_size = 1").select(F.lit("p_brand").alias("scope"), F.col("p_brand").alias("key"), F.lit("brand;").alias("tags")).union(part.where("p_size = 50").select(F.lit("p_type"), "p_type", F.lit(" typed,brand\n")))
    return review.shared_tags(part, tags, ["p_brand", "p_type"]).select("p_partkey", F.array_join("tag_names", ",").alias("tag_names"))


@query("""select p_brand, url as image, is_primary from (select 'Brand#' || (11 + page_id % 45) as p_brand, url, page_id % 4 = 0 as is_primary, row_number() over (partition by page_id % 45 order by page_id % 4 = 0 desc, page_id % 7, url) as r from pages) where r = 1""")
def image_pick(spark, sf):
    k = F.col("page_id")
    images = t(spark, sf, "pages").select(F.concat(F.lit("Brand#"), (11 + k % 45).cast("string")).alias("p_brand"), "url", (k % 4 == 0).alias("is_primary"), (k % 7).alias("sort_order"))
    return review.best_image(images, "p_brand").select("p_brand", F.col("url").alias("image"), "is_primary")


# ---- relational shapes ---------------------------------------------------------------------------------------------------


@query("""select 'total' as dimension, 'all' as value, count(*) as row_count from orders union all select 'o_orderstatus', o_orderstatus, count(*) from orders group by 2 union all select 'o_orderpriority', coalesce(nullif(o_orderpriority, '5-LOW'), '(blank)'), count(*) from orders group by 2""")
def dim_counts(spark, sf):
    return relational.dimension_counts(t(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))), ["o_orderstatus", "o_orderpriority"])


@query("""select 'rows' as metric, count(*) as value from lineitem union all select 'returned', count(*) filter (l_returnflag = 'R') from lineitem union all select 'parts', count(distinct l_partkey) from lineitem union all select 'tuples', count(distinct (l_returnflag, nullif(l_linestatus, 'F'))) from lineitem""")
def metric_unpivot(spark, sf):
    return relational.metric_rows(t(spark, sf, "lineitem"), {"rows": F.count("*"), "returned": A.count_when(F.col("l_returnflag") == "R"), "parts": F.count_distinct("l_partkey"), "tuples": A.pairs(F.col("l_returnflag"), F.nullif("l_linestatus", F.lit("F")))})


@query("""with g as (select l_orderkey, count(*) as n from lineitem group by 1) select case when n = 1 then 'unique' when n = 2 then '2' when n <= 5 then '3-5' else '6+' end as bucket, count(*) as n_groups, cast(sum(n) as bigint) as n_rows from g group by 1""")
def bucket_histogram(spark, sf):
    sizes = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    n = F.col("n")
    return sizes.groupBy(F.when(n == 1, "unique").when(n == 2, "2").when(n <= 5, "3-5").otherwise("6+").alias("bucket")).agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_rows"))


@query("""select count(*) as n_rows, count(distinct (l_orderkey, l_linenumber)) as n_keys, case when count(*) = count(distinct (l_orderkey, l_linenumber)) then 'OK_1to1' else 'DUPLICATES' end as verdict, cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as n_blank from lineitem""")
def one_to_one_verdict(spark, sf):
    keys = A.pairs(F.col("l_orderkey"), F.col("l_linenumber"))
    return t(spark, sf, "lineitem").agg(F.count("*").alias("n_rows"), keys.alias("n_keys"), F.when(F.count("*") == keys, "OK_1to1").otherwise("DUPLICATES").alias("verdict"), F.sum(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).alias("n_blank"))


@query("""with d as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2) select count(*) filter (n > 1) as dup_keys, cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as dup_rows, max(n) as most from d""")
def uniqueness_audit(spark, sf):
    d = t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return d.agg(A.count_when(F.col("n") > 1).alias("dup_keys"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup_rows"), F.max("n").alias("most"))


@query("select distinct on (o_custkey) o_custkey, o_orderkey, o_orderdate from orders order by o_custkey, o_orderdate desc, o_orderkey")
def distinct_on_latest(spark, sf):
    return relational.top_rows(t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")])


@query("select * from (select p_brand, p_partkey, p_retailprice, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as place from part) where place <= 3")
def top_n_per_group(spark, sf):
    return relational.top_rows(t(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.col("p_retailprice").desc_nulls_last(), F.col("p_partkey")], 3, "place")


@query("""with r as (select user_id, event_id, case when event_id % 3 = 0 then event_type end as kind from events) select user_id, event_id, last_value(kind ignore nulls) over (partition by user_id order by event_id rows unbounded preceding) as kind from r""")
def ffill(spark, sf):
    rows = t(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(" ").alias("kind"))
    return relational.forward_fill(rows, ["user_id"], [F.col("event_id")], ["kind"])


@query("select p_partkey, p_name from part where p_brand = 'Brand#13' and (p_name ilike '%a%' or p_type ilike '%a%') order by p_retailprice desc, p_partkey limit 25 offset 5")
def paged_list(spark, sf):
    hits = relational.search(t(spark, sf, "part"), "a", ["p_name", "p_type"], {"p_brand": "Brand#13", "p_size": None})
    return relational.page(hits, [F.col("p_retailprice").desc_nulls_last(), F.col("p_partkey")], 25, 5).select("p_partkey", "p_name")


@query("""select c_mktsegment, count(*) filter (exists (select 1 from orders where o_custkey = c_custkey)) as with_orders, count(*) filter (not exists (select 1 from orders where o_custkey = c_custkey)) as without_orders,
  count(*) filter (exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F') or exists (select 1 from supplier where s_nationkey = c_nationkey and s_acctbal < 0)) as either from customer group by 1""")
def semi_anti(spark, sf):
    orders = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.lit(True).alias("any_order"), F.bool_or(F.col("o_orderstatus") == "F").alias("done"))
    poor = t(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("c_nationkey")).distinct().withColumn("poor", F.lit(True))
    rows = t(spark, sf, "customer").join(orders, "c_custkey", "left").join(poor, "c_nationkey", "left").fillna(False, ["any_order", "done", "poor"])
    return rows.groupBy("c_mktsegment").agg(A.count_when(F.col("any_order")).alias("with_orders"), A.count_when(~F.col("any_order")).alias("without_orders"), A.count_when(F.col("done") | F.col("poor")).alias("either"))


@query("select n_name from nation where n_nationkey not in (select nullif(s_nationkey, -1) from supplier where s_acctbal > 9000)")
def not_in(spark, sf):
    t(spark, sf, "nation").createOrReplaceTempView("matchloom_nation")
    t(spark, sf, "supplier").createOrReplaceTempView("matchloom_supplier")
    return spark.sql("select n_name from matchloom_nation where n_nationkey not in (select nullif(s_nationkey, -1) from matchloom_supplier where s_acctbal > 9000)")


@query("""with a as (select nullif(c_nationkey, 3) as k, count(*) as n from customer where c_nationkey <> 5 group by 1), b as (select nullif(s_nationkey, 3) as k, count(*) as n from supplier where s_nationkey <> 7 group by 1)
select coalesce(a.k, b.k) as k, a.n as left_value, b.n as right_value, case when b.n is null then 'left_only' when a.n is null then 'right_only' when a.n = b.n then 'same' else 'differs' end as state from a full join b on a.k is not distinct from b.k""")
def full_parity(spark, sf):
    a = t(spark, sf, "customer").where("c_nationkey != 5").groupBy(F.nullif("c_nationkey", F.lit(3)).alias("k")).agg(F.count("*").alias("n"))
    b = t(spark, sf, "supplier").where("s_nationkey != 7").groupBy(F.nullif("s_nationkey", F.lit(3)).alias("k")).agg(F.count("*").alias("n"))
    return relational.parity(a, b, ["k"], "n")


@query("""select c_custkey, o.o_orderkey, o.o_totalprice from customer left join lateral (select * from orders where o_custkey = c_custkey order by o_totalprice desc, o_orderkey limit 1) o on true""")
def lateral_top1(spark, sf):
    best = relational.top_rows(t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"), ["c_custkey"], [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")])
    return t(spark, sf, "customer").select("c_custkey").join(best, "c_custkey", "left")


@query("""select s.seg as segment, r_name, count(c_custkey) as n from (select distinct c_mktsegment as seg from customer) s cross join region left join nation on n_regionkey = r_regionkey left join customer on c_mktsegment = s.seg and c_nationkey = n_nationkey group by 1, 2""")
def cross_dims(spark, sf):
    facts = t(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    facts = facts.join(F.broadcast(t(spark, sf, "nation")), "n_nationkey").groupBy("segment", F.col("n_regionkey").alias("r_regionkey")).agg(F.sum("n").alias("n"))
    dims = t(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment")).distinct().select("segment", F.explode(F.array(*(F.lit(k).cast("int") for k in range(5)))).alias("r_regionkey"))
    named = dims.join(F.broadcast(t(spark, sf, "region")), "r_regionkey")
    return named.join(facts, ["segment", "r_regionkey"], "left").select("segment", "r_name", F.coalesce("n", F.lit(0)).alias("n"))


@query("""select p_brand, count(*) filter (p_size > 25) as n_large, count(distinct p_type) filter (p_size > 25) as types_large, string_agg(distinct p_name, ', ' order by p_name) filter (p_size > 48) as names,
  case when count(distinct p_type) = 1 then min(p_type) end as single_type, bool_or(p_size = 50) as any_50, bool_and(p_retailprice > 900) as all_dear, cast(round(100.0 * count(*) filter (p_size > 25) / nullif(count(*), 0), 2) as double) as share from part group by 1""")
def agg_filter(spark, sf):
    large = F.col("p_size") > 25
    return t(spark, sf, "part").groupBy("p_brand").agg(
        A.count_when(large).alias("n_large"), A.distinct_when(large, F.col("p_type")).alias("types_large"), A.text_when(F.col("p_size") > 48, F.col("p_name")).alias("names"), A.single(F.col("p_type")).alias("single_type"),
        F.bool_or(F.col("p_size") == 50).alias("any_50"), F.bool_and(F.col("p_retailprice") > 900).alias("all_dear"), A.percent(A.count_when(large), F.count("*")).alias("share"),
    )


@query("""select o_orderstatus, o_orderpriority, count(*) as n, count(*) over () as n_groups, max(count(*)) over (partition by o_orderstatus) as most from orders group by 1, 2""")
def window_counts(spark, sf):
    g = t(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return g.withColumn("n_groups", F.count("*").over(Window.partitionBy(F.lit(1)))).withColumn("most", F.max("n").over(Window.partitionBy("o_orderstatus")))


@query("""select k as key, count(*) as n, min(cast(json_extract_string(props, '$.' || k) as bigint)) as least from events, unnest(json_keys(props)) as u(k) group by 1""")
def json_keys(spark, sf):
    rows = t(spark, sf, "events").select("props", F.explode(F.json_object_keys("props")).alias("key"))
    value = F.element_at(F.from_json("props", "map<string,string>"), F.col("key")).try_cast("long")
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.min(value).alias("least"))


# ---- apply protocol ------------------------------------------------------------------------------------------------------


def _orders(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("""select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderkey % 10 <> 0 union all select o_orderkey, 'X', 0.0, o_orderpriority from orders where o_orderkey % 10 = 0 union all select -o_orderkey - 1, 'X', 0.0, 'new' from orders where o_orderkey % 20 = 0""")
def upsert(spark, sf):
    table = _orders(spark, sf)
    changed = table.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"), F.lit("new").alias("o_orderpriority"))
    new = table.where("o_orderkey % 20 = 0").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), F.lit("X"), F.lit(0.0), F.lit("new"))
    return apply.upsert(table, changed.union(new), ["o_orderkey"], ["o_orderpriority"])


@query("""select o_orderkey, case when o_orderkey % 5 = 0 then 'U' else o_orderstatus end as o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderkey % 7 <> 0""")
def update_delete(spark, sf):
    table = _orders(spark, sf)
    changed = apply.update_from(table, table.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("U").alias("o_orderstatus")), ["o_orderkey"], ["o_orderstatus"])
    return apply.delete_using(changed, table.where("o_orderkey % 7 = 0").select("o_orderkey"), ["o_orderkey"])[0]


@query("select o_orderkey, o_orderstatus from orders union all select distinct o_orderkey + 10000000, 'N' from orders where o_orderkey % 50 = 0")
def insert_guarded(spark, sf):
    table = _orders(spark, sf).select("o_orderkey", "o_orderstatus")
    rows = table.where("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 10000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus")).union(table.where("o_orderkey % 3 = 0"))
    return apply.insert_new(table, rows, ["o_orderkey"])


@query("""select o_orderkey, o_orderstatus as before, case when o_orderkey % 100 = 0 then 'hold' else o_orderstatus end as after, case when o_orderkey % 3 = 0 then 2 else 1 end as n_events from orders""")
def audit_append(spark, sf):
    k = F.col("o_orderkey")
    first = apply.append_event(F.lit(None), "import", F.lit(None).cast("string"), F.col("o_orderstatus"), "loader", "2025-01-01T00:00:00Z")
    after = F.when(k % 100 == 0, "hold").otherwise(F.col("o_orderstatus"))
    rows = _orders(spark, sf).withColumn("events", F.when(k % 3 == 0, first)).withColumn("events", apply.append_event(F.col("events"), "decide", F.col("o_orderstatus"), after, "tester", "2026-01-01T00:00:00Z"))
    last = F.element_at("events", -1)
    return rows.select("o_orderkey", last.before.alias("before"), last.after.alias("after"), F.size("events").alias("n_events"))


@query("""select a.o_orderstatus as state_from, b.o_orderstatus as state_to, false as allowed from (select distinct o_orderstatus from orders) a cross join (select distinct o_orderstatus from orders) b union all select 'received', 'picking', true union all select 'shipped', 'picking', false""")
def order_moves(spark, sf):
    states = _orders(spark, sf).select("o_orderstatus").distinct()
    few = states.agg(F.array_sort(F.collect_set("o_orderstatus")).alias("s"))
    moves = few.select("s", F.explode("s").alias("state_from")).select("state_from", F.explode("s").alias("state_to"))
    more = spark.sql("select * from values ('received', 'picking'), ('shipped', 'picking') as v(state_from, state_to)")
    return apply.allowed_moves(moves.union(more))


# ---- read models ---------------------------------------------------------------------------------------------------------


@query("""select p_partkey, p_name, p_brand, 'code' as found_by from part where cast(p_partkey as varchar) = '77' union all select p_partkey, p_name, p_brand, 'brand' from part where p_brand = 'Brand#12' and p_partkey <> 77""")
def code_lookup(spark, sf):
    """An item's own code, else a shared one: the first kind of match of each item."""
    part = t(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    found = F.when(F.col("p_partkey") == 77, "code").when(F.col("p_brand") == "Brand#12", "brand")
    return part.withColumn("found_by", found).where("found_by is not null")


@query("""select kind, id, label from (select 'part' as kind, cast(p_partkey as varchar) as id, p_name as label from part where p_name ilike '%green%' union all select 'supplier', cast(s_suppkey as varchar), s_name from supplier where s_name ilike '%green%' or s_name ilike '%0001%'
  union all select 'customer', cast(c_custkey as varchar), c_name from customer where c_name ilike '%0001%')""")
def product_search(spark, sf):
    def kind(name, table, id_col, label, *texts):
        rows = t(spark, sf, table)
        hit = X.like_any(F.col(label), [f"%{x}%" for x in texts])
        return rows.where(hit).select(F.lit(name).alias("kind"), F.col(id_col).cast("string").alias("id"), F.col(label).alias("label"))

    return kind("part", "part", "p_partkey", "p_name", "green").union(kind("supplier", "supplier", "s_suppkey", "s_name", "green", "0001")).union(kind("customer", "customer", "c_custkey", "c_name", "0001"))


@query("""select count(*) as n_orders, count(*) filter (o_orderstatus = 'F') as n_done, count(distinct o_custkey) as n_customers, (select count(*) from lineitem l where not exists (select 1 from orders where o_orderkey = l_orderkey)) as n_orphans, (select count(*) from orders o where not exists (select 1 from lineitem where l_orderkey = o_orderkey)) as n_empty from orders""")
def migration_validation(spark, sf):
    orders, lines = t(spark, sf, "orders"), t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"))
    both = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "full")
    here = F.col("o_orderkey").isNotNull()
    return both.agg(
        A.count_when(here).alias("n_orders"), A.count_when(F.col("o_orderstatus") == "F").alias("n_done"), F.count_distinct("o_custkey").alias("n_customers"),
        F.coalesce(F.sum(F.when(~here, F.col("n_lines"))), F.lit(0)).alias("n_orphans"), A.count_when(F.col("l_orderkey").isNull()).alias("n_empty"),
    )


@query("""with c as (select o_orderstatus as k, count(*) as n, count(*) filter (o_totalprice > 200000) as dear from orders group by 1)
select '{' || string_agg('"' || k || '":{"n":' || n || ',"dear":' || dear || '}', ',' order by k) || '}' as summary from c""")
def summary_json(spark, sf):
    c = t(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), A.count_when(F.col("o_totalprice") > 200000).alias("dear"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("o_orderstatus").alias("k"), F.struct("n", "dear").alias("v"))))
    return c.agg(F.to_json(F.map_from_entries(pairs)).alias("summary"))


@query("""select p_partkey, case when p_size > 5 and p_name not ilike '%red%' and p_retailprice > 1000 then 'auto_confirm_ready' else 'manual' end as verdict,
  array_to_string(list_filter([case when not p_size > 5 then 'size' end, case when p_name ilike '%red%' then 'no_risk_word' end, case when not p_retailprice > 1000 then 'price' end], lambda x: x is not null), ',') as failed from part""")
def strict_evidence(spark, sf):
    tests = {"size": F.col("p_size") > 5, "no_risk_word": ~F.col("p_name").ilike("%red%"), "price": F.col("p_retailprice") > 1000}
    return t(spark, sf, "part").select("p_partkey", *(c.alias(k) for k, c in evidence.strict_evidence(tests).items()))


@query("""with i as (select page_id % 400 as p_partkey, 'u' || (page_id % 300) as url, page_id % 3 = 0 as is_primary from pages), u as (select url, count(distinct p_partkey) as n from i group by 1),
h as (select p_partkey, count(*) as n_images, count(*) filter (is_primary) as n_primary, max(n) as most from i join u using (url) group by 1)
select p_partkey, coalesce(n_images, 0) as n_images, coalesce(n_primary, 0) as n_primary, case when n_images is null then 'none' when n_primary = 0 then 'no_primary' when n_primary > 1 then 'duplicate_primary' when most > 1 then 'shared' else 'ok' end as state from part left join h using (p_partkey)""")
def image_coverage(spark, sf):
    k = F.col("page_id")
    images = t(spark, sf, "pages").select((k % 400).alias("p_partkey"), F.concat(F.lit("u"), (k % 300).cast("string")).alias("url"), (k % 3 == 0).alias("is_primary"))
    return evidence.image_coverage(t(spark, sf, "part"), images, "p_partkey")
