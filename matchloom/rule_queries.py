"""Queries of the longer rule sets, the queue, lookups, planned changes and export checks. Importing it adds them to the others.

Texts are made from the tables' keys, with the words that the rules look for, so that every rule decides some rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import evidence, lookup, queue, review, validation, weak
from matchloom.plans import changes, export_rules
from matchloom.queries import QUEUE, _queue, query, t
from matchloom.sources import inventory

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


# ---- evidence validation -------------------------------------------------------------------------------------------------

# Row texts by o_orderkey % 24 and item texts by p_partkey % 6.
ROW_OPTIONS = ["Rose Gold", "RG 16", "핑골 16", "골드(주문제작)", "Yellow  Gold", "원타입", "One Type", "5mm바", "14k 골드", "red", "크리스탈AB", "AB pearl", "xABy", "화이트골드 실버", "세트 2", "3 pcs", "[open", "plain", "", None, "rg-16", "925실버 red", "blue", "one  type"]
ITEM_OPTIONS = ["로즈골드", "rosegold16", "옐로우골드", "단일옵션", "5mm", "RED"]


def _literal(text: str | None) -> str:
    return "null" if text is None else "'" + text + "'"


def _choose(key, texts):
    return F.element_at(F.array(*(F.lit(x).cast("string") for x in texts)), (key % len(texts)).cast("int") + 1)


def _list(texts: list) -> str:
    return "[" + ", ".join(map(_literal, texts)) + "]"


def _key_sql(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for pattern, by in validation.OPTION_STEPS:
        out = f"regexp_replace({out}, '{pattern}', '{by.replace('$', chr(92))}', 'g')"
    return out


NAMES = "regexp_replace(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


@query(f"""with g as (select *, o_orderkey // 8 as g from orders),
e as (select o_orderkey as row, case when o_orderkey % 31 = 0 then ' ' else 'C' || g end as item_code, case when o_orderkey % 5 = 0 then 'W' || (g + case when g % 6 = 0 then 1 else 0 end) end as own_code,
    case when o_orderkey % 29 <> 0 then 'N' || (g + case when o_orderkey % 77 = 0 then 1 else 0 end) end as product_no, {_list(ROW_OPTIONS)}[o_orderkey % 24 + 1] as raw_option, case when o_orderkey % 17 = 0 then 'RED' end as plain_option,
    case when o_orderkey % 11 = 0 then 'Other' when o_orderkey % 2 = 0 then 'Item ' || g end as name, case when o_orderkey % 13 = 0 then 'Multiline rows' when o_orderkey % 19 = 0 then 'note' end as warning, case when o_orderkey % 3 = 0 then 'OK' when o_orderkey % 23 = 0 then 'failed' end as status from g),
al as (select value, count(distinct target) as n, case when count(distinct target) = 1 then min(target) end as target from (select 'C' || p_partkey as value, p_partkey as target from part union all select 'C' || (p_partkey + 1), p_partkey from part where p_partkey % 50 = 0) group by 1),
ow as (select value, count(distinct target) as n, case when count(distinct target) = 1 then min(target) end as target from (select 'W' || p_partkey as value, p_partkey as target from part union all select 'W' || (p_partkey + 1), p_partkey from part where p_partkey % 40 = 0) group by 1),
cat as (select p_partkey, case when p_partkey % 9 <> 0 then 'item-' || p_partkey end as item_name, {_list(ITEM_OPTIONS)}[p_partkey % 6 + 1] as item_option, case when p_partkey % 8 = 0 then ['N' || p_partkey, 'N1'] when p_partkey % 8 = 1 then ['N' || p_partkey] end as nos from part),
j as (select e.*, coalesce(al.n, 0) as n_items, al.target as item, coalesce(ow.n, 0) as n_own, ow.target as own_item, item_name, item_option, nos, {_key_sql("coalesce(plain_option, raw_option)")} as row_key, {_key_sql("item_option")} as item_key, nullif(trim(item_code), '') as code,
    coalesce(raw_option, '') as r, coalesce(plain_option, '') as p, coalesce(item_option, '') as d, coalesce(warning, '') as w, lower(coalesce(plain_option, raw_option, '')) as rt, lower(coalesce(item_option, '')) as it, {NAMES.format("e.name")} as nm, {NAMES.format("item_name")} as inm
  from e left join al on al.value = e.item_code left join ow on ow.value = e.own_code left join cat on cat.p_partkey = al.target),
bc as (select code, count(distinct product_no) as n_numbers from j where code is not null group by 1), bo as (select product_no, row_key, count(distinct code) as n_codes from j where product_no is not null and row_key <> '' group by 1, 2),
k as (select j.*, coalesce(n_numbers, 0) as n_numbers, coalesce(n_codes, 0) as n_codes from j left join bc using (code) left join bo using (product_no, row_key)),
f as (select *, array_to_string(list_filter([case when (r || '|' || p || '|' || d) like '%크리스탈AB%' then 'crystal' end,
    case when w ilike '%ab%' or regexp_matches(r, '(?i)(^|[^\\p{{L}}\\p{{N}}])ab([^\\p{{L}}\\p{{N}}]|$)') or regexp_matches(p, '(?i)(^|[^\\p{{L}}\\p{{N}}])ab([^\\p{{L}}\\p{{N}}]|$)') or regexp_matches(r, '(?i)[\\p{{L}}\\p{{N}}]ab[\\p{{L}}\\p{{N}}]') then 'ab_token' end,
    case when (r || '|' || p || '|' || d) like '%화이트골드%' and (r || '|' || p || '|' || d) like '%실버%' then 'white_gold' end, case when r like '%세트%' or r like '%한쌍%' or r like '%낱개%' or p like '%세트%' or p like '%한쌍%' or p like '%낱개%' or regexp_matches(r, '[0-9]+\\s*(개|pcs|ea|set)') then 'quantity' end,
    case when w ilike '%bracket%' or w like '%대괄호%' or (contains(r, '[') and not contains(r, ']')) then 'bracket' end, case when w ilike '%multiline%' or w ilike '%alignment%' or w like '%줄 수%' then 'line_alignment' end, case when n_items > 1 or n_numbers > 1 then 'duplicate_item' end, case when n_codes > 1 then 'duplicate_option' end,
    case when n_own > 1 or own_item <> item then 'own_code' end, case when product_no is not null and len(list_filter(nos, lambda x: x <> product_no)) > 0 then 'product_no' end, case when nm <> '' and inm <> '' and nm <> inm then 'name' end], lambda x: x is not null), ',') as blocked,
    row_key <> '' and row_key = item_key as option_match, row_key = item_key and rt <> it as absorbed, w <> '' or lower(coalesce(status, '')) not in ('', 'ok', 'parsed', 'clean') as parser_warning, product_no is not null and trim(coalesce(raw_option, plain_option, '')) <> '' as told,
    regexp_matches(rt, '골드|핑골|rose gold|yellow gold|(^|[^\\p{{L}}\\p{{N}}])[ry]g([^\\p{{L}}\\p{{N}}]|$)') or regexp_matches(rt || '|' || it, '주문제작|원타입|단일옵션|one type|[0-9]+mm바') as worded from k)
select row, item, blocked, nm <> '' and nm = inm as name_support, option_match, absorbed, parser_warning, case when blocked <> '' then 'blocked_risk' when parser_warning then 'parse_warning' when told and item is not null and option_match and n_items = 1 and n_own <= 1 and n_numbers = 1 and n_codes = 1 then 'high'
  when told and item is not null and (option_match or absorbed or worded) then 'medium' when told and code is not null then 'parse_good' else 'manual' end as tier from f""")
def evidence_validation(spark, sf):
    k, g = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 8)
    part, p = t(spark, sf, "part"), F.col("p_partkey")
    code = lambda letter, n: F.concat(F.lit(letter), n.cast("string"))
    one_if = lambda test: F.when(test, 1).otherwise(0)
    rows = t(spark, sf, "orders").select(
        k.alias("row"), F.when(k % 31 == 0, " ").otherwise(code("C", g)).alias("item_code"), F.when(k % 5 == 0, code("W", g + one_if(g % 6 == 0))).alias("own_code"),
        F.when(k % 29 != 0, code("N", g + one_if(k % 77 == 0))).alias("product_no"), _choose(k, ROW_OPTIONS).alias("raw_option"), F.when(k % 17 == 0, "RED").alias("plain_option"),
        F.when(k % 11 == 0, "Other").when(k % 2 == 0, code("Item ", g)).alias("name"), F.when(k % 13 == 0, "Multiline rows").when(k % 19 == 0, "note").alias("warning"), F.when(k % 3 == 0, "OK").when(k % 23 == 0, "failed").alias("status"),
    )
    alias = part.select(code("C", p).alias("value"), p.alias("target")).union(part.where("p_partkey % 50 = 0").select(code("C", p + 1), p))
    own = part.select(code("W", p).alias("value"), p.alias("target")).union(part.where("p_partkey % 40 = 0").select(code("W", p + 1), p))
    numbers = F.when(p % 8 == 0, F.array(code("N", p), F.lit("N1"))).when(p % 8 == 1, F.array(code("N", p)))
    catalog = part.select(p.alias("target"), F.when(p % 9 != 0, code("item-", p)).alias("item_name"), _choose(p, ITEM_OPTIONS).alias("item_option"), numbers.alias("product_nos"))
    return validation.evidence_validation(rows, alias, own, catalog)


REVIEW_TEXTS = ["크리스탈AB 16", "크리스탈 16", "AB 2", "CAB", "세트", "1+1", "실버", "plain", None]


@query(f"""with r as (select l_orderkey, l_linenumber, l_partkey, {_list(REVIEW_TEXTS)}[case when l_partkey % 3 = 0 then (l_partkey + l_suppkey) % 9 else l_partkey % 9 end + 1] as text from lineitem), d as (select distinct * from r),
m as (select l_partkey, bool_or(coalesce(regexp_matches(text, '크리스탈AB|크리AB'), false)) and bool_or(coalesce(contains(text, '크리스탈') and not regexp_matches(text, '크리스탈AB|크리AB'), false)) as mixed from d group by 1)
select l_orderkey, l_linenumber, d.l_partkey, text, array_to_string(list_filter([case when regexp_matches(text, '크리스탈AB|크리AB') then 'crystal_ab' end, case when regexp_matches(text, '(^|[^A-Za-z0-9가-힣])AB([^A-Za-z0-9가-힣]|$)') then 'standalone_ab' end, case when regexp_matches(text, '세트|SET|set|Set|수량') then 'set_or_quantity' end,
    case when contains(text, '1+1') then 'one_plus_one' end, case when mixed then 'variant_conflict' end], lambda x: x is not null), ',') as narrow, coalesce(regexp_matches(text, '실버|골드|크리스탈'), false) as broad_colour,
  not (coalesce(regexp_matches(text, '크리AB|크리스탈AB|세트|수량|[Ss]et|SET|1\\+1|(^|[^A-Za-z0-9가-힣])AB([^A-Za-z0-9가-힣]|$)'), false) or mixed) as clean from d join m using (l_partkey)""")
def narrow_risk(spark, sf):
    rows = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", _choose(F.col("l_partkey") + F.when(F.col("l_partkey") % 3 == 0, F.col("l_suppkey")).otherwise(0), REVIEW_TEXTS).alias("text")).distinct()
    return validation.narrow_risk(rows, "l_partkey", "text")


@query("""with r as (select n_name as channel, p_partkey as item, case when p_size % 9 <> 0 then 'P' || (p_partkey % 50) end as product_code, case when p_partkey % 10 <> 0 then 'O' || p_partkey end as option_code, case when p_size % 7 <> 0 then 'W' end as own_code,
    p_name as option, case p_partkey % 5 when 0 then upper(p_name) when 1 then split_part(p_name, ' ', 1) || '-item' when 2 then 'steel ' || p_name when 3 then null else 'blue-ab' end as channel_option from part join nation on n_nationkey = p_partkey % 25),
s as (select *, lower(regexp_replace(coalesce(option, ''), '[^\\p{L}\\p{N}]+', '', 'g')) as fa, lower(regexp_replace(coalesce(channel_option, ''), '[^\\p{L}\\p{N}]+', '', 'g')) as fb, ' ' || lower(regexp_replace(coalesce(channel_option, ''), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' as sb, ' ' || lower(regexp_replace(coalesce(option, ''), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' as sa from r),
x as (select *, case when contains(fa, 'plate') then 'plate' when contains(sa, ' steel ') then 'steel' when contains(fa, 'blue') then 'blue' when contains(sa, ' red ') then 'red' end as ta,
    case when contains(fb, 'plate') then 'plate' when contains(sb, ' steel ') then 'steel' when contains(fb, 'blue') then 'blue' when contains(sb, ' red ') then 'red' end as tb from s),
y as (select *, coalesce(ta, nullif(fa, '')) as na, coalesce(tb, nullif(fb, '')) as nb, coalesce(ta, tb, 'raw_text') as rule, fa <> '' and fa = fb as before from x),
z as (select *, coalesce(na = nb, false) as after, (contains(sa, ' ab ') or contains(sb, ' ab ')) and not contains(fa, 'blueab') and not contains(fb, 'blueab') or (contains(fa, 'blueab') and coalesce(tb = 'blue', false)) or (contains(fb, 'blueab') and coalesce(ta = 'blue', false)) as unsafe from y),
g as (select channel, product_code, nb, count(distinct item) as i, count(distinct option_code) as o from z where after and product_code is not null group by 1, 2, 3)
select z.channel, item, z.product_code, option_code, own_code, option, channel_option, rule, before, after, not before and after and rule <> 'raw_text' as candidate, after and (coalesce(i > 1, false) or coalesce(o > 1, false) or unsafe) as ambiguous, not after or z.product_code is null or option_code is null or own_code is null as manual
from z left join g on g.channel = z.channel and g.product_code = z.product_code and g.nb = z.nb""")
def option_match_before_after(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    nation = t(spark, sf, "nation").select((F.col("n_nationkey").cast("long")).alias("n"), F.col("n_name").alias("channel"))
    other = F.when(k % 5 == 0, F.upper("p_name")).when(k % 5 == 1, F.concat(F.substring_index("p_name", " ", 1), F.lit("-item"))).when(k % 5 == 2, F.concat(F.lit("steel "), "p_name")).when(k % 5 == 4, "blue-ab")
    rows = t(spark, sf, "part").withColumn("n", k % 25).join(nation, "n").select(
        "channel", k.alias("item"), F.when(size % 9 != 0, F.concat(F.lit("P"), (k % 50).cast("string"))).alias("product_code"), F.when(k % 10 != 0, F.concat(F.lit("O"), k.cast("string"))).alias("option_code"),
        F.when(size % 7 != 0, "W").alias("own_code"), F.col("p_name").alias("option"), other.alias("channel_option"),
    )
    terms = [("finish", "plate", "contains"), ("metal", "steel", "token"), ("colour", "blue", "contains"), ("colour", "red", "token")]
    return validation.option_impact(rows, terms, pinned="finish", mixed=("blueab", "blue", "ab"))


# ---- presence in channels ------------------------------------------------------------------------------------------------


@query("""with a as (select l_partkey as item, l_returnflag as channel, count(*) as n_alias, count(*) filter (l_quantity = 50 and l_linenumber = 1) as n_confirmed, count(*) filter (l_quantity = 49) as n_candidate, count(distinct case when l_quantity > 47 then l_suppkey end) as alias_products from lineitem group by 1, 2),
o as (select p_name, count(distinct p_partkey) as fan_out from part where p_partkey % 3 = 0 group by 1), u as (select p_partkey as item, c as channel, fan_out, case when p_size % 2 = 0 then 1 end as n_images from part left join o using (p_name), unnest(['A', 'N', 'R', 'X']) as t(c)),
s as (select u.channel, case when coalesce(n_confirmed, 0) > 0 then 'confirmed' when coalesce(alias_products, 0) > 1 or coalesce(fan_out, 0) > 60 then 'blocked' when coalesce(n_candidate, 0) > 0 then 'high' when coalesce(n_alias, 0) > 0 and alias_products > 0 then 'medium' when n_alias is null and n_images is null then 'absent' when n_alias is null then 'unknown' else 'manual' end as st from u left join a on a.item = u.item and a.channel = u.channel),
c as (select channel, count(*) as total, count(*) filter (st <> 'absent') as present, count(*) filter (st in ('confirmed', 'high', 'medium')) as matched, count(*) filter (st in ('manual', 'unknown')) as open_rows, count(*) filter (st = 'absent') as gone from s group by 1),
n as (select * from (values ('confirmed'), ('high'), ('medium'), ('blocked'), ('absent'), ('manual'), ('unknown')) as v(k))
select 'total_rows' as type, channel, total as row_count, cast(null as double) as rate, 'total' as denominator from c union all select 'present_rows', channel, present, null, 'present' from c
union all select k || '_rows', channel, (select count(*) from s where s.channel = c.channel and st = k), null, case when k = 'absent' then 'total' else 'present' end from c, n
union all select 'match_rate_of_total', channel, null, cast(round(100.0 * matched / nullif(total, 0), 2) as double), 'total' from c union all select 'match_rate_of_present', channel, null, cast(round(100.0 * matched / nullif(present, 0), 2) as double), 'present' from c
union all select 'manual_rate_of_present', channel, null, cast(round(100.0 * open_rows / nullif(present, 0), 2) as double), 'present' from c union all select 'absent_rate_of_total', channel, null, cast(round(100.0 * gone / nullif(total, 0), 2) as double), 'total' from c""")
def presence_rates(spark, sf):
    q = F.col("l_quantity")
    held = t(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("item"), F.col("l_returnflag").alias("channel")).agg(
        F.count("*").alias("n_alias"), F.count(F.when((q == 50) & (F.col("l_linenumber") == 1), 1)).alias("n_confirmed"), F.count(F.when(q == 49, 1)).alias("n_candidate"), F.count_distinct(F.when(q > 47, F.col("l_suppkey"))).alias("alias_products")
    )
    part = t(spark, sf, "part")
    fans = part.where("p_partkey % 3 = 0").groupBy("p_name").agg(F.count("*").alias("n")).select("p_name", F.when(F.col("n") > 60, 2).otherwise(1).alias("fan_out"))
    each = part.join(fans, "p_name", "left").select(F.col("p_partkey").alias("item"), "fan_out", F.when(F.col("p_size") % 2 == 0, 1).alias("n_images"), F.explode(F.array(*(F.lit(c) for c in "ANRX"))).alias("channel"))
    none = [F.lit(0).alias(c) for c in ("alias_options", "n_mapping", "n_identity", "mapping_products", "mapping_options", "mapping_owns")]
    counts = each.join(held, ["item", "channel"], "left").select("*", *none)
    return evidence.presence_rates(counts.withColumn("status", evidence.presence_from_counts(counts)), "channel", "status")


@query("""with i as (select p_partkey as item, case when p_size % 6 = 0 then '' when p_size % 5 = 0 then null else 'W' || p_partkey end as own, p_size % 4 as n_images from part),
m as (select distinct on (c, item) * from (select case l_returnflag when 'A' then 'one' when 'N' then 'two' else 'three' end as c, case when l_quantity < 5 or l_quantity > 45 then l_partkey else -1 - l_partkey end as item, l_quantity > 25 as is_primary, case when l_suppkey % 3 <> 0 then 'P' || l_suppkey end as pc, case when l_suppkey % 4 <> 0 then 'O' || l_linenumber end as oc, case when l_suppkey % 5 = 0 then 'c' || l_suppkey end as pk,
    case when l_suppkey % 7 = 0 then 'X' || l_suppkey end as mo from lineitem) order by c, item, is_primary desc, pc nulls last, oc nulls last, pk nulls last, mo nulls last),
j as (select ch as channel, i.item, coalesce(mo, own) as own_code, pc, oc, pk, n_images = 0 as image_missing, coalesce(mo, own, '') = '' as own_code_missing from i cross join unnest(['one', 'two', 'three']) as u(ch) left join m on m.c = ch and m.item = i.item)
select channel, item, case when image_missing then 'image_missing' when own_code_missing then 'own_code_missing' when channel = 'one' and pc is null and oc is null and pk is null then 'channel_code_missing' when channel <> 'one' and (pc is null or oc is null) then 'channel_code_missing' when channel = 'one' then 'candidate' else 'review_required' end as reason,
  own_code, pc as product_code, oc as option_code, pk as product_candidate, cast(null as varchar) as option_candidate, image_missing, own_code_missing from j
where image_missing or own_code_missing or (channel = 'one' and (pc is null or oc is null or pk is not null)) or (channel = 'two' and (pc is null or oc is null)) or (channel = 'three' and oc is null)""")
def review_queue(spark, sf):
    size, s = F.col("p_size"), F.col("l_suppkey")
    code = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    items = t(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.when(size % 6 == 0, "").when(size % 5 != 0, code("W", F.col("p_partkey"))).alias("own_code"), (size % 4).alias("n_images"))
    mapping = t(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "one").when(F.col("l_returnflag") == "N", "two").otherwise("three").alias("channel"), F.when(F.expr("l_quantity < 5 or l_quantity > 45"), F.col("l_partkey")).otherwise(-1 - F.col("l_partkey")).alias("item"), (F.col("l_quantity") > 25).alias("is_primary"),
        F.when(s % 3 != 0, code("P", s)).alias("product_code"), F.when(s % 4 != 0, code("O", F.col("l_linenumber"))).alias("option_code"), F.when(s % 5 == 0, code("c", s)).alias("product_candidate"), F.lit(None).cast("string").alias("option_candidate"),
        F.when(s % 7 == 0, code("X", s)).alias("own_code"),
    )
    policies = {
        "one": queue.QueuePolicy(unsettled=("product_candidate", "option_candidate"), missing=queue.CODES, missing_if="all", fallback="candidate"),
        "two": queue.QueuePolicy(),
        "three": queue.QueuePolicy(needed=("option_code",)),
    }
    return queue.review_queue(items, mapping, policies)


# ---- lookups -------------------------------------------------------------------------------------------------------------


@query("""with al as (select 'ITEM' as kind, cast(p_partkey as varchar) as target, 'S' || (p_partkey % 90) as value, p_partkey % 2 = 0 as is_primary from part union all select 'ITEM', cast(p_partkey as varchar), 'A' || p_partkey, p_partkey % 3 = 0 from part union all select 'PRODUCT', p_brand, 'S7', false from part where p_brand in ('Brand#12', 'Brand#31')),
f as (select item, min(by_) as found_by from (select target as item, 'item' as by_ from al where kind = 'ITEM' and value = 'S7' union all select cast(p_partkey as varchar), 'product' from part where p_brand in (select target from al where kind = 'PRODUCT' and value = 'S7')) group by 1),
b as (select distinct on (target) target, value from al where kind = 'ITEM' order by target, value = 'S7' desc, is_primary desc, value), i as (select distinct on (item) * from (select cast(page_id % 500 as varchar) as item, url, page_id % 2 = 0 as p, page_id % 5 as s from pages) order by item, p desc, s, url)
select f.item, p_brand as product, b.value as own_code, url, found_by from f join part on cast(p_partkey as varchar) = f.item left join b on b.target = f.item left join i on i.item = f.item""")
def code_items(spark, sf):
    part, pages = t(spark, sf, "part"), t(spark, sf, "pages")
    k, g = F.col("p_partkey"), F.col("page_id")
    text = k.cast("string")
    items = part.select(text.alias("item"), F.col("p_brand").alias("product"))
    names = ["kind", "target", "system", "value", "is_primary"]
    shared = part.select(F.lit("ITEM"), text, F.lit("own"), F.concat(F.lit("S"), (k % 90).cast("string")), k % 2 == 0).toDF(*names)
    single = part.select(F.lit("ITEM"), text, F.lit("own"), F.concat(F.lit("A"), text), k % 3 == 0).toDF(*names)
    product = part.where(F.col("p_brand").isin("Brand#12", "Brand#31")).select(F.lit("PRODUCT"), "p_brand", F.lit("own"), F.lit("S7"), F.lit(False)).toDF(*names)
    images = pages.select((g % 500).cast("string").alias("item"), "url", (g % 2 == 0).alias("is_primary"), (g % 5).alias("sort_order"))
    return lookup.code_lookup(items, shared.union(single).union(product), images, "own", "S7")


@query("""select distinct 'part' as kind, cast(p_partkey as varchar) as id, case when p_name ilike '%re%' then p_name else p_type end as matched from part where p_name ilike '%re%' or p_type ilike '%re%' union all select distinct 'nation', cast(n_nationkey as varchar), n_name from nation where n_name ilike '%re%'""")
def source_search(spark, sf):
    sources = [("part", t(spark, sf, "part"), "p_partkey", ["p_name", "p_type"]), ("nation", t(spark, sf, "nation"), "n_nationkey", ["n_name"]), ("customer", t(spark, sf, "customer"), "c_custkey", ["c_name"])]
    return lookup.text_search("re", sources, kinds={"part", "nation"})


@query(" union all ".join(f"select '{k}' as table_name, count(*) as n_rows, cast((select count(*) from information_schema.columns where table_name = '{k}') as bigint) as n_columns from {k}" for k in TABLES))
def table_inventory(spark, sf):
    return inventory.row_counts({k: t(spark, sf, k) for k in TABLES})


# ---- planned changes, export checks --------------------------------------------------------------------------------------

UUID_SQL = "lpad(cast({} as varchar), 8, '0') || '-0000-4000-8000-000000000000'"


@query(f"""with r as (select o_orderkey, case when o_orderkey % 37 = 0 then ' ' else 'K' || (case when o_orderkey % 10 = 0 then o_orderkey - 1 else o_orderkey end) end as code, case when o_orderkey % 41 = 0 then null when o_orderkey % 43 = 0 then 'x' else {UUID_SQL.format("o_custkey")} end as item, o_totalprice > 20000 as dear, case when o_orderkey % 3 <> 0 then o_orderstatus <> 'P' end as status_ok from orders),
x as (select 'K' || o_orderkey as code, {UUID_SQL.format("case when o_orderkey % 4 = 0 then o_custkey else o_custkey + 1 end")} as item from orders where o_orderkey % 6 = 0), h as (select code, count(distinct item) as n, min(item) as item from x group by 1),
m as (select distinct {UUID_SQL.format("c_custkey")} as item from customer where c_custkey % 9 <> 0), d as (select code from r where trim(code) <> '' group by 1 having count(*) > 1)
select o_orderkey, r.code, r.item, dear, status_ok, case when trim(coalesce(r.code, '')) = '' then 'null_code' when trim(coalesce(r.item, '')) = '' then 'blank_item' when r.item = 'x' then 'invalid_item' when m.item is null then 'missing_item' when d.code is not null then 'duplicate_source' when n = 1 and h.item = r.item then 'idempotent_existing' when n is not null then 'conflict_existing'
  when not dear then 'too_cheap' when not coalesce(status_ok, false) then 'status' else 'insert' end as apply_class from r left join d on d.code = r.code left join h on h.code = r.code left join m on m.item = r.item""")
def insert_classes(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    uuid = lambda n: F.concat(F.lpad(n.cast("string"), 8, "0"), F.lit("-0000-4000-8000-000000000000"))
    orders, code = t(spark, sf, "orders"), lambda n: F.concat(F.lit("K"), n.cast("string"))
    rows = orders.select(
        "o_orderkey", F.when(k % 37 == 0, " ").otherwise(code(F.when(k % 10 == 0, k - 1).otherwise(k))).alias("code"), F.when(k % 41 == 0, None).when(k % 43 == 0, "x").otherwise(uuid(c)).alias("item"),
        (F.col("o_totalprice") > 20000).alias("dear"), F.when(k % 3 != 0, F.col("o_orderstatus") != "P").alias("status_ok"),
    )
    existing = orders.where("o_orderkey % 6 = 0").select(code(k).alias("code"), uuid(F.when(k % 4 == 0, c).otherwise(c + 1)).alias("item"))
    master = t(spark, sf, "customer").where("c_custkey % 9 != 0").select(uuid(F.col("c_custkey")).alias("item"))
    return changes.insert_classes(rows, existing, master, {"too_cheap": F.col("dear"), "status": F.col("status_ok")})


@query("""with s as (select unnest(['draft', 'submitted', 'approved', 'applied', 'rejected', 'cancelled']) as state), a as (select unnest(['submit', 'approve', 'reject', 'cancel', 'apply']) as action),
ok as (select * from (values ('draft', 'submit', 'submitted'), ('draft', 'cancel', 'cancelled'), ('submitted', 'approve', 'approved'), ('submitted', 'reject', 'rejected'), ('submitted', 'cancel', 'cancelled'), ('approved', 'apply', 'applied')) as v(state, action, next_state))
select s.state, a.action, next_state, (select count(*) from orders) as n_rows from s cross join a left join ok using (state, action)""")
def change_moves(spark, sf):
    states, actions = ["draft", "submitted", "approved", "applied", "rejected", "cancelled"], ["submit", "approve", "reject", "cancel", "apply"]
    rows = t(spark, sf, "orders").select(F.explode(F.array(*(F.lit(s) for s in states))).alias("state")).withColumn("action", F.explode(F.array(*(F.lit(a) for a in actions))))
    return rows.groupBy("state", "action", changes.next_state(F.col("action"), F.col("state")).alias("next_state")).agg(F.count("*").alias("n_rows"))


@query("""with r as (select p_partkey, case when p_partkey % 12 <> 0 then 'S' || p_partkey end as code, case p_partkey % 8 when 0 then 'n/a' when 1 then '0' when 2 then ' ' else cast(p_size as varchar) end as price, case p_partkey % 9 when 0 then '-1' when 1 then '' else '5' end as stock, case p_partkey % 7 when 0 then 'http://a.b/c.jpg' when 1 then 'x.PNG' when 2 then 'not a file' end as image, p_size % 10 = 0 as open_policy from part),
f as (select p_partkey, concat_ws(',', case when trim(coalesce(code, '')) = '' then 'MISSING_OWN_SKU_CODE' end, case when p_partkey % 25 = 0 then 'MISSING_MAIN_CODE' end, case when trim(price) = '' then 'MISSING_REQUIRED_PRICE' end, case when trim(price) <> '' and coalesce(try_cast(price as double), 0) <= 0 then 'INVALID_PRICE' end, case when trim(stock) = '' then 'MISSING_STOCK' end,
    case when stock = '-1' then 'INVALID_STOCK' end, case when image is null then 'MISSING_REQUIRED_IMAGE' end, case when image = 'not a file' then 'INVALID_IMAGE_REFERENCE' end) as blockers, case when open_policy then 'STOCK_POLICY_UNCONFIRMED' else '' end as warnings from r)
select *, case when blockers <> '' then 'blocked' when warnings <> '' then 'warning' else 'ready' end as state from f""")
def export_check(spark, sf):
    k = F.col("p_partkey")
    rows = t(spark, sf, "part").select(
        "p_partkey", F.when(k % 12 != 0, F.concat(F.lit("S"), k.cast("string"))).alias("code"), F.when(k % 8 == 0, "n/a").when(k % 8 == 1, "0").when(k % 8 == 2, " ").otherwise(F.col("p_size").cast("string")).alias("price"),
        F.when(k % 9 == 0, "-1").when(k % 9 == 1, "").otherwise("5").alias("stock"), F.when(k % 7 == 0, "http://a.b/c.jpg").when(k % 7 == 1, "x.PNG").when(k % 7 == 2, "not a file").alias("image"), (F.col("p_size") % 10 == 0).alias("open_policy"),
    )
    gone = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rules = {
        "MISSING_OWN_SKU_CODE": gone("code"), "MISSING_MAIN_CODE": k % 25 == 0, "MISSING_REQUIRED_PRICE": gone("price"), "INVALID_PRICE": export_rules.bad_number(F.col("price"), 0, 1e9, above=True), "MISSING_STOCK": gone("stock"), "INVALID_STOCK": export_rules.bad_number(F.col("stock"), 0, 1e6),
        "MISSING_REQUIRED_IMAGE": gone("image"), "INVALID_IMAGE_REFERENCE": export_rules.bad_reference(F.col("image")), "STOCK_POLICY_UNCONFIRMED": F.col("open_policy"),
    }
    return export_rules.export_check(rows, rules, main_code="MISSING_MAIN_CODE").select("p_partkey", "blockers", "warnings", "state")


# ---- lines, weak candidates, review --------------------------------------------------------------------------------------


@query("""with d as (select doc_id, regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)+$', ''), '\\r\\n|\\r|\\n') as c from documents), dict as (select distinct trim(v) as code, true as known from (select unnest(c) as v from d where doc_id % 4 = 0)),
x as (select doc_id, c, case when doc_id % 3 = 0 then list_prepend('head', c) when doc_id % 3 = 1 then c else ['one', 'two'] end as o, case when doc_id % 2 = 0 then list_transform(c, lambda v: case when v = '' then '' else 'Y' end) else ['N'] end as s, case when doc_id % 7 <> 0 then 'shop' end as channel, case when doc_id % 11 = 0 then ' ' else 'P' end as product_code,
    ['판매중', '판매중', '판매중지', 'odd'][doc_id % 4 + 1] as sale from d),
e as (select *, len(o) = len(c) + 1 as more, unnest(range(1, len(c) + 1)) as line_no from x), a as (select *, case when len(s) <> len(c) then 'needs_review' when more then 'header' when len(o) = len(c) then 'direct' else 'needs_review' end as alignment, nullif(trim(c[line_no]), '') as code, nullif(trim(o[case when more then line_no + 1 else line_no end]), '') as option, case when len(s) = len(c) then nullif(trim(s[line_no]), '') end as status from e),
k as (select a.*, coalesce(known, false) as known from a left join dict on dict.code = a.code), z as (select *, case when sale = '판매중' then 'active' when sale = '판매중지' then 'inactive' else 'needs_review' end as sale_state, case status when 'Y' then 'active' when 'N' then 'inactive' else 'needs_review' end as option_state from k)
select doc_id, line_no, md5(code) as code, md5(option) as option, status, alignment, sale_state, option_state, sale_state = 'active' and option_state = 'active' and channel is not null and known and alignment <> 'needs_review' as active,
  concat_ws('; ', case when channel is null then 'unknown_channel' end, case when trim(product_code) = '' then 'no_product_code' end, case when code is null then 'no_code' end, case when option is null then 'no_option' end, case when alignment = 'needs_review' then 'line_count' end, case when not known then 'not_in_dictionary' end) as warning from z""")
def line_dictionary_check(spark, sf):
    k, text = F.col("doc_id"), F.col("text")
    docs = t(spark, sf, "documents").repartition(32, "doc_id")
    rows = docs.select(
        k.alias("row"), F.when(k % 7 != 0, "shop").alias("channel"), F.when(k % 11 == 0, " ").otherwise("P").alias("product_code"), text.alias("codes"), F.when(k % 3 == 0, F.concat(F.lit("head\n"), text)).when(k % 3 == 1, text).otherwise("one\ntwo").alias("options"),
        F.when(k % 2 == 0, F.regexp_replace(text, r"[^\r\n]+", "Y")).otherwise("N").alias("statuses"), _choose(k, ["판매중", "판매중", "판매중지", "odd"]).alias("sale_status"),
    )
    dictionary = docs.where("doc_id % 4 = 0").select(F.explode(F.split("text", r"\r\n|\r|\n")).alias("code")).select(F.trim("code").alias("code"))
    out = evidence.line_evidence(rows, dictionary)
    return out.select(F.col("row").alias("doc_id"), "line_no", F.md5("code").alias("code"), F.md5("option").alias("option"), "status", "alignment", "sale_state", "option_state", "active", "warning")


def _weak(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    text = lambda c: c.cast("string")
    rows = t(spark, sf, "part").select(
        F.when(size != 3, F.concat("p_brand", F.lit("-"), text(k % 40))).alias("product"), F.when(k % 13 == 0, "").when(k % 17 == 0, "D").otherwise(F.concat(F.lit("C"), text(k))).alias("code"), F.when(k % 19 != 0, text(k)).alias("item"),
        F.when(k % 23 == 0, "x").when(k % 10 == 0, text(k % 7 + 1)).otherwise(text(k % 7)).alias("option_id"), F.when(k % 14 != 0, F.concat(F.lit("AB-1-0"), text(k % 7), F.lit("|q"))).otherwise("CD-9, AB-2").alias("aliases"),
        F.concat("p_name", F.lit(" [x]")).alias("option"), F.when(k % 9 == 0, "zz").when(k % 2 == 0, F.upper("p_name")).otherwise(F.substring_index("p_name", " ", 1)).alias("item_option"), F.concat("p_name", F.lit(" 반지")).alias("name"),
        F.when(k % 2 == 0, F.col("p_name")).otherwise("반지").alias("item_name"), text(k % 40 + 65).alias("score"), F.when(k % 29 == 0, "n/a").otherwise(text(k % 4)).alias("n_candidates"), "p_partkey",
    )
    return weak.weak_candidates(rows)


WEAK = """r as (select *, case when p_size <> 3 then p_brand || '-' || (p_partkey % 40) end as product, case when p_partkey % 13 = 0 then '' when p_partkey % 17 = 0 then 'D' else 'C' || p_partkey end as code, case when p_partkey % 23 = 0 then 'x' when p_partkey % 10 = 0 then cast(p_partkey % 7 + 1 as varchar) else cast(p_partkey % 7 as varchar) end as option_id,
    case when p_partkey % 14 <> 0 then cast(p_partkey % 7 as varchar) else '9' end as primary_no from part), s as (select *, primary_no = option_id as same_no from r), c as (select code, count(*) as n_code from s group by 1), g as (select product, count(*) as n_group, count(*) filter (same_no) as n_same from s group by 1),
w as (select p_partkey, s.product, p_name || ' 반지' as name, option_id, primary_no, case when p_partkey % 2 = 0 then len(list_distinct(string_split(p_name, ' '))) else 0 end as overlap, array_to_string(list_filter([case when p_partkey % 40 + 65 < 70 then 'score' end, case when p_partkey % 29 = 0 then 'candidates' end, case when not same_no then 'option_no' end,
    case when p_partkey % 9 = 0 then 'option_text' end, case when s.code = '' then 'code_blank' end, case when p_partkey % 19 = 0 then 'item_blank' end, case when s.code = '' or n_code <> 1 then 'code_not_single' end], lambda x: x is not null), ',') as failed, n_group, round(n_same / n_group, 4) as group_ratio, n_group >= 2 and n_same >= 0.8 * n_group as group_consistent
  from s join c using (code) join g on g.product is not distinct from s.product)"""


@query(f"with {WEAK} select p_partkey, primary_no, cast(overlap as bigint) as overlap, failed, failed = '' as strong, n_group, group_ratio, group_consistent from w")
def weak_candidates(spark, sf):
    return _weak(spark, sf).select("p_partkey", "primary_no", "overlap", "failed", "strong", "n_group", "group_ratio", "group_consistent")


@query(f"""with {WEAK} select product, max(n_group) as n_group, count(*) filter (failed = '') as n_strong, max(group_ratio) as group_ratio, bool_or(group_consistent) as group_consistent, cast(min(coalesce(try_cast(option_id as int), 0)) as bigint) as least_option,
  cast(max(coalesce(try_cast(option_id as int), 0)) as bigint) as greatest_option, array_to_string(list_slice(list_sort(list_distinct(list(name))), 1, 5), ' | ') as names from w group by 1""")
def weak_groups(spark, sf):
    return weak.weak_groups(_weak(spark, sf))


@query(f"""with {QUEUE}, r as (select *, case when o_orderkey % 8 = 0 then 'Duplicate row' when o_orderkey % 15 = 0 then 'auto-approve' end as action, o_orderkey % 3 <> 0 as linked, o_orderkey % 50 = 0 as unlinked, o_orderkey % 33 = 0 as gone, case when o_orderkey % 4 <> 3 then o_orderkey % 12 = 1 end as required from q),
x as (select *, dup > 1 or coalesce(action ilike '%duplicate%', false) or o_orderkey % 13 = 0 as conflict, unlinked or not linked or tier = 'NO_MATCH' or (tier = 'REVIEW' and not regexp_matches(reason, '(?i)set($|[^a-z0-9_])') and o_orderkey % 21 = 2) as needs_linking, tier in ('AUTO_APPROVE_CANDIDATE', 'FAST_REVIEW') or coalesce(action = 'auto-approve', false) as auto, tier = 'FAST_REVIEW' or o_orderkey % 17 = 0 as fast from r)
select o_orderkey, conflict, needs_linking, auto, fast, not unlinked and not gone and (conflict or needs_linking or coalesce(required, false) or not auto) as pending from x""")
def review_predicates(spark, sf):
    rows, k = _queue(spark, sf), F.col("o_orderkey")
    tier, reason, dup = (F.col(c) for c in ("tier", "reason", "dup"))
    action = F.when(k % 8 == 0, "Duplicate row").when(k % 15 == 0, "auto-approve")
    policy, bucket = review.policy_tier(tier, dup, reason, "name", ("code",)), review.workflow_bucket(tier, [tier, action, reason], F.when(k % 21 == 2, "STOCK_SMARTSTORE_NOT_FOUND"))
    found = review.review_predicates(tier, policy, bucket, [reason, action], dup, k % 3 != 0, k % 50 == 0, k % 33 == 0, F.when(k % 4 != 3, k % 12 == 1), risk=F.when(k % 13 == 0, "중복 auto-approve"), label=F.when(k % 17 == 0, "빠른검토 conflict"))
    return rows.select("o_orderkey", *(c.alias(n) for n, c in found.items()))


@query("""with u as materialized (select s_suppkey as upload, case when s_suppkey % 5 = 0 then 'big, new;big' when s_suppkey % 5 = 1 then 'x' || chr(10) || ' y ' else 'one' end as tags, case s_suppkey % 6 when 0 then 'SKU' when 1 then '상품' end as scope, case when s_suppkey % 7 = 0 then 'Q-' || s_suppkey end as item, case when s_suppkey % 2 = 0 then ['F', 'O', 'P', 'Z'][s_suppkey // 2 % 4 + 1] end as channel,
    case when s_suppkey % 3 = 0 then ['1-URGENT', '2-HIGH'][s_suppkey % 2 + 1] end as channel_product, case when s_suppkey % 3 <> 1 then 'O' || s_suppkey end as channel_option from supplier),
q as materialized (select o_orderstatus as channel, o_orderpriority as channel_product, 'O' || (case when o_orderkey % 9 = 0 then -1 - o_orderkey else o_orderkey % 400 end) as channel_option, 'P' || (o_custkey % 3) as p, 'P' || (o_custkey % 3) || '-' || (o_orderkey % 2) as i from orders),
m as materialized (select upload, count(distinct (p, i)) as n, min(p) as p, min(i) as i from u join q on coalesce(u.channel = q.channel, true) and coalesce(u.channel_product = q.channel_product, true) and coalesce(u.channel_option = q.channel_option, true) where item is null group by 1),
r as materialized (select u.upload, tags, scope, case when item is not null then 'direct' when n is null then 'not_found' when n = 1 then 'seller_resolved' else 'multiple_targets' end as match, case when item is not null then 'Q' when n = 1 then p end as product, case when item is not null then item when n = 1 then i end as item from u left join m using (upload))
select distinct upload, case when scope = '상품' then 'product' when scope = 'SKU' or item is not null then 'option' else 'product' end as scope, product, item, match, tag from (select *, trim(unnest(regexp_split_to_array(tags, '[,;\\n\\r]+'))) as tag from r) where tag <> ''""")
def tag_targets(spark, sf):
    k, o, c = F.col("s_suppkey"), F.col("o_orderkey"), F.col("o_custkey")
    text = lambda letter, x: F.concat(F.lit(letter), x.cast("string"))
    uploads = t(spark, sf, "supplier").select(
        k.alias("upload"), F.when(k % 5 == 0, "big, new;big").when(k % 5 == 1, "x\n y ").otherwise("one").alias("tags"), F.when(k % 6 == 0, "SKU").when(k % 6 == 1, "상품").alias("scope"), F.lit(" ").alias("product"), F.when(k % 7 == 0, text("Q-", k)).alias("item"),
        F.when(k % 2 == 0, _choose(F.floor(k / 2), ["F", "O", "P", "Z"])).alias("channel"), F.when(k % 3 == 0, _choose(k, ["1-URGENT", "2-HIGH"])).alias("channel_product"), F.when(k % 3 != 1, text("O", k)).alias("channel_option"),
    )
    rows = t(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("channel"), F.col("o_orderpriority").alias("channel_product"), text("O", F.when(o % 9 == 0, -1 - o).otherwise(o % 400)).alias("channel_option"), F.when(o % 2 == 0, text("P", c % 3)).alias("product"), F.concat(text("P", c % 3), text("-", o % 2)).alias("item")
    )
    return review.tag_targets(uploads, rows)


@query(f"""with {QUEUE}, r as (select *, case when o_orderkey % 11 = 0 then 'STOCK_HOLD_REVIEW' when o_orderkey % 13 = 0 then 'STOCK_MATCH' end as stock, case when o_orderkey % 6 <> 5 then o_orderkey % 5 = 0 end as required from q)
select o_orderkey, case when tier = 'NO_MATCH' then 10 when coalesce(stock, '') = 'STOCK_HOLD_REVIEW' then 20 when tier = 'REVIEW' then 30 when tier = 'FAST_REVIEW' then 40 else 50 end::bigint as queue_priority, concat_ws(' ', code, stock, reason) as search_text from r
where coalesce(required, false) or tier <> 'AUTO_APPROVE_CANDIDATE' or coalesce(stock, '') = 'STOCK_HOLD_REVIEW'""")
def light_queue(spark, sf):
    k = F.col("o_orderkey")
    rows = _queue(spark, sf).withColumns({"stock": F.when(k % 11 == 0, "STOCK_HOLD_REVIEW").when(k % 13 == 0, "STOCK_MATCH"), "required": F.when(k % 6 != 5, k % 5 == 0)})
    return review.light_queue(rows, "tier", "stock", "required", ["code", "stock", "reason"]).select("o_orderkey", "queue_priority", "search_text")
