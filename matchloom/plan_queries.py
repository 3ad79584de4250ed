"""Queries of guarded writes, keyed and ordered tables and what they keep up. Importing it adds them to the others.

Each writes tables of its own, made of the given ones, to a new folder under spark.checkpoint.dir and returns what they hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import options
from matchloom.plans import apply, json_values, keyed, ordered, summary
from matchloom.queries import query, t
from matchloom.session import working_folder
from matchloom.sources import files

# ---- guards --------------------------------------------------------------------------------------------------------------


@query("""with n as (select count(*) as n, count(*) filter (o_totalprice > 100000) as m from orders) select 'counts hold' as step, 1 as version, n as n_rows, cast(null as varchar) as refused from n
union all select 'a count differs', 1, n, 'priced is ' || m || ', not ' || (m + 1) from n union all select 'read-only', 1, n, 'read_only is True, not False' from n
union all select 'counts hold again', 2, m, null from n""")
def guarded_count(spark, sf):
    """Four writes of a versioned table: what each is refused for, and the version and rows that are the table after it."""
    orders = t(spark, sf, "orders")
    table = apply.VersionedTable(spark, working_folder(spark, "guarded"))
    priced = F.count_if(F.col("o_totalprice") > 100000)
    n, m = orders.agg(F.count("*"), priced).first()
    told = []

    def step(name, write):
        refused = None
        try:
            write()
        except apply.GuardError as e:
            refused = str(e)
        told.append((name, table.versions()[-1], table.read().count(), refused))

    def barred():
        with apply.transaction(spark, read_only=True):
            table.write(orders)

    step("counts hold", lambda: table.write(orders, {"orders": (F.count("*"), n), "priced": (priced, m)}))
    step("a count differs", lambda: table.write(orders, {"orders": (F.count("*"), n), "priced": (priced, m + 1)}))
    step("read-only", barred)
    step("counts hold again", lambda: table.write(orders.where("o_totalprice > 100000"), {"orders": (F.count("*"), m)}))
    return spark.createDataFrame(told, "step string, version int, n_rows long, refused string")


# ---- keyed tables --------------------------------------------------------------------------------------------------------


@query("""with spent as (select o_custkey, sum(cast(o_totalprice as decimal(18, 2))) as s, count(*) as n from orders group by 1),
upserted as (select c_custkey, case when n is null then c_name else 'Buyer ' || n end as c_name, c_nationkey, case when n is null then cast(c_acctbal as decimal(18, 2)) else s end as c_acctbal, c_mktsegment from customer left join spent on o_custkey = c_custkey
  union all select -1 - s_suppkey, s_name, s_nationkey, cast(s_acctbal as decimal(18, 2)), 'SUPPLIER' from supplier)
select c_custkey, case when c_nationkey = 3 then 'moved' else c_name end as c_name, c_nationkey, c_acctbal, c_mktsegment from upserted where not (c_mktsegment = 'MACHINERY' and c_acctbal < 500000)""")
def keyed_changes(spark, sf):
    """Customers by key: those with orders replaced but for their segment, suppliers inserted, one nation renamed, poor ones of a segment deleted."""
    customer = t(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    table = keyed.KeyedTable(spark, working_folder(spark, "keyed"))
    table.create(customer, ["c_custkey"], buckets=8)
    spent = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("s"), F.count("*").alias("n"))
    rows = customer.join(spent, "c_custkey").select("c_custkey", F.concat(F.lit("Buyer "), F.col("n").cast("string")).alias("c_name"), "c_nationkey", F.col("s").alias("c_acctbal"), F.lit("none").alias("c_mktsegment"))
    table.upsert(rows, keep=("c_mktsegment",), expected=rows.count())
    supplier = t(spark, sf, "supplier")
    table.insert(supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").cast("decimal(18,2)").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment")), expected=supplier.count())
    table.update(table.read().where("c_nationkey = 3").select("c_custkey", F.lit("moved").alias("c_name")), ["c_name"])
    table.delete(table.read().where("c_mktsegment = 'MACHINERY' and c_acctbal < 500000"))
    return table.read()


@query("""select o_orderkey, case when o_orderstatus = 'O' and o_totalprice > 200000 then 'O' when o_totalprice > 150000 and o_orderpriority = '1-URGENT' then 'B' else o_orderstatus end as status,
  case when o_totalprice > 150000 and o_orderpriority = '1-URGENT' then 'DONE' else o_orderpriority end as priority, o_orderstatus = 'O' and o_totalprice > 200000 as restored from orders""")
def marked_restore(spark, sf):
    """Two marked changes of orders; the first is taken back row by row, the second stays."""
    orders = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice")
    table = keyed.KeyedTable(spark, working_folder(spark, "marked"))
    table.create(orders, ["o_orderkey"], buckets=8)
    one = orders.where("status = 'O' and o_totalprice > 200000").select("o_orderkey", F.lit("A").alias("status"))
    two = orders.where("o_totalprice > 150000 and priority = '1-URGENT'").select("o_orderkey", F.lit("B").alias("status"), F.lit("DONE").alias("priority"))
    n = one.count()
    table.apply_marked(one, ["status"], "one", n)
    table.apply_marked(two, ["status", "priority"], "two", two.count())
    table.restore("one", n)
    images = table.marked("one").select("o_orderkey", F.lit(True).alias("restored"))
    return table.read().join(images, "o_orderkey", "left").select("o_orderkey", "status", "priority", F.coalesce("restored", F.lit(False)).alias("restored"))


# ---- ordered tables ------------------------------------------------------------------------------------------------------

LINES = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("""select row_number() over (order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as row_no, l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem""")
def row_numbers(spark, sf):
    """All lines numbered by ship date."""
    return ordered.numbered(t(spark, sf, "lineitem"), LINES, working_folder(spark, "numbered")).select("row_no", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""with r as (select event_id, event_type, case when event_id % 5000 = 7 then event_type || event_id end as sheet, case when event_id % 3 = 0 then cast(user_id as varchar) when event_id % 3 = 1 then ' ' end as who from events)
select event_id, last_value(sheet ignore nulls) over w as sheet, last_value(nullif(trim(who), '') ignore nulls) over w as who from r window w as (partition by event_type order by event_id rows unbounded preceding)""")
def filled_down(spark, sf):
    """Events as sheets of one column group each, mostly blank, filled down over ranges of rows."""
    k = F.col("event_id")
    rows = t(spark, sf, "events").select("event_id", "event_type", F.when(k % 5000 == 7, F.concat("event_type", k.cast("string"))).alias("sheet"), F.when(k % 3 == 0, F.col("user_id").cast("string")).when(k % 3 == 1, " ").alias("who"))
    table = ordered.OrderedTable.write(rows, ["event_id"], working_folder(spark, "filled"))
    return table.forward_fill(["event_type"], ["sheet", "who"]).select("event_id", "sheet", "who")


@query("""select * from (select row_number() over (order by o_totalprice, o_orderkey) as row_no, o_orderkey, o_totalprice, 'page' as kind from orders) where row_no between 951 and 1000
union all select * from (select row_number() over (order by o_totalprice, o_orderkey) as row_no, o_orderkey, o_totalprice, 'after' from orders) where row_no between 1001 and 1050""")
def deep_pages(spark, sf):
    """The 20th page of 50 orders by price, and the page behind its last row, each read from the ranges that it lies in."""
    table = ordered.OrderedTable.write(t(spark, sf, "orders").select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"], working_folder(spark, "pages"))
    page = table.page(20, 50)
    last = page.orderBy(F.col("row_no").desc()).first()
    after = table.page_after([last.o_totalprice, last.o_orderkey], 50) if last else table.page_after(None, 50)
    numbered = table.numbered().select("o_orderkey", "row_no")
    return page.select("row_no", "o_orderkey", "o_totalprice", F.lit("page").alias("kind")).union(after.join(numbered, "o_orderkey").select("row_no", "o_orderkey", "o_totalprice", F.lit("after").alias("kind")))


# ---- what is kept up -----------------------------------------------------------------------------------------------------


@query("""with n as (select o_orderkey, case when o_totalprice > 400000 then 'HELD' when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'F' else o_orderstatus end as status, o_orderpriority as priority, o_totalprice from orders where not (o_orderpriority = '2-HIGH' and o_totalprice < 100000))
select status, priority, count(*) as n_rows, cast(sum(case when o_totalprice > 200000 then 1 else 0 end) as bigint) as dear, cast(sum(cast(o_totalprice as decimal(18, 2))) as decimal(28, 2)) as value, true as kept from n group by 1, 2""")
def kept_summary(spark, sf):
    """Orders by status and priority, counted once and then kept up over three changes; kept says that it is what a recount gives."""
    orders = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice")
    root = working_folder(spark, "summary")
    table = keyed.KeyedTable(spark, f"{root}/orders")
    table.create(orders, ["o_orderkey"], buckets=8)
    price = F.col("o_totalprice")
    held = summary.KeptSummary(table, apply.VersionedTable(spark, f"{root}/summary"), {"status": F.col("status"), "priority": F.col("priority")}, {"dear": (price > 200000).cast("long"), "value": price.cast("decimal(18,2)")})
    held.refresh()
    table.update(orders.where("status = 'P' and priority = '5-LOW'").select("o_orderkey", F.lit("F").alias("status")), ["status"])
    held.refresh()
    table.delete(orders.where("priority = '2-HIGH' and o_totalprice < 100000"))
    table.update(orders.where("o_totalprice > 400000").select("o_orderkey", F.lit("HELD").alias("status")), ["status"])
    held.refresh()
    whole = held.recount().select("status", "priority", F.struct("n_rows", "dear", "value").alias("_w"))
    both = held.read().join(whole, ["status", "priority"], "left").withColumn("kept", F.struct("n_rows", "dear", "value").eqNullSafe(F.col("_w")))
    return both.select("status", "priority", "n_rows", "dear", F.col("value").cast("decimal(28,2)").alias("value"), "kept")


@query("""with d as (select 'buyer' as category, lower(regexp_replace(c_name, '[^\\p{L}\\p{N}]+', '', 'g')) as term, 'contains' as mode from customer union select 'kind', lower(p_type), 'token' from part union select 'size', 'p' || p_size, 'token' from part union select 'word', lower(regexp_replace(p_name, '[^\\p{L}\\p{N}]+', '', 'g')), 'contains' from part),
r as (select o_orderkey, text, lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', '', 'g')) as f, ' ' || trim(lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g'))) || ' ' as s from (select o_orderkey, o_orderpriority || ' / ' || case when o_orderkey % 3 = 0 then 'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') when o_orderkey % 3 = 1 then 'Small-Ring (P' || (o_orderkey % 60) || ')' else 'economy p' || (o_orderkey % 99) end as text from orders)),
texts as (select distinct f, s from r), hits as (select f, s, category, term, row_number() over (partition by f, s order by category <> 'kind', length(term) desc, term, category) as o from texts join d on case when mode = 'token' then contains(s, ' ' || term || ' ') else contains(f, term) end)
select o_orderkey, category, term from r left join hits using (f, s) where coalesce(o, 1) = 1""")
def dict_large(spark, sf):
    """Order texts against a dictionary made of all customers, part types, sizes and names."""
    customer, part, k = t(spark, sf, "customer"), t(spark, sf, "part"), F.col("o_orderkey")
    flat = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))
    terms = customer.select(F.lit("buyer").alias("category"), flat("c_name").alias("term"), F.lit("contains").alias("mode"))
    for category, term, mode in (("kind", F.lower("p_type"), "token"), ("size", F.concat(F.lit("p"), F.col("p_size").cast("string")), "token"), ("word", flat("p_name"), "contains")):
        terms = terms.union(part.select(F.lit(category), term, F.lit(mode)))
    tail = F.when(k % 3 == 0, F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).when(k % 3 == 1, F.concat(F.lit("Small-Ring (P"), (k % 60).cast("string"), F.lit(")"))).otherwise(F.concat(F.lit("economy p"), (k % 99).cast("string")))
    rows = t(spark, sf, "orders").select("o_orderkey", F.concat("o_orderpriority", F.lit(" / "), tail).alias("text"))
    return options.dictionary_terms(rows, "text", terms, pinned="kind").select("o_orderkey", "category", "term")


# ---- files ---------------------------------------------------------------------------------------------------------------


@query("""select cast(doc_id as varchar) as doc_id, md5(text) as text_hash, length(text) as n_chars, coalesce(lang, '') as lang, 'utf-8-sig' as encoding from documents""")
def csv_round_trip(spark, sf):
    """All documents written as quoted CSV with their line breaks, and read back by byte ranges."""
    path = working_folder(spark, "csv")
    docs = t(spark, sf, "documents").select("doc_id", "text", "lang")
    docs.write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    rows, encoding = files.read_csv_any(spark, path)
    return rows.select("doc_id", F.md5("text").alias("text_hash"), F.length("text").cast("long").alias("n_chars"), "lang", F.lit(encoding).alias("encoding"))


# ---- nested JSON ---------------------------------------------------------------------------------------------------------


@query("""with r as (select *, o_orderkey % 3 as m, '{"after":{"review":false,"status":"AUTO"},"before":{"price":' || cast(o_orderkey % 7 as varchar) || ',"status":"' || o_orderstatus || '"},"event":"auto_approve"}' as e from orders)
select o_orderkey, case m when 0 then '{"events":[' || e || ']}' when 1 then '{"events":[{"event":"first","n":' || o_custkey || '},' || e || '],"rule":{"name":"new","old":null}}' else '{"events":[' || e || '],"rule":{"name":"new"}}' end as evidence,
  m = 1 as had_first, o_orderstatus = 'F' as from_f, m <> 0 as ruled from r""")
def evidence_events(spark, sf):
    """An event added to the list in each order's evidence, a nested key set where its object is there, and three tests of parts."""
    k, orders = F.col("o_orderkey"), t(spark, sf, "orders")
    old = F.when(k % 3 == 1, F.concat(F.lit('{"rule":{"old":null},"events":[{"event":"first","n":'), F.col("o_custkey").cast("string"), F.lit("}]}"))).when(k % 3 == 2, F.lit('{"rule":{"name":"r"}}'))
    event = F.struct(F.lit("auto_approve").alias("event"), F.struct(F.col("o_orderstatus").alias("status"), (k % 7).alias("price")).alias("before"), F.struct(F.lit("AUTO").alias("status"), F.lit(False).alias("review")).alias("after"))
    rows = orders.select("o_orderkey", json_values.append_path(json_values.parsed(old), ["events"], json_values.json_value(event)).alias("v"))
    rows = rows.select("o_orderkey", json_values.set_path(F.col("v"), ["rule", "name"], json_values.json_value(F.lit("new"))).alias("v"))
    tests = {"had_first": {"events": [{"event": "first"}]}, "from_f": {"events": [{"before": {"status": "F"}, "event": "auto_approve"}]}, "ruled": {"rule": {"name": "new"}}}
    return rows.select("o_orderkey", json_values.json_text(F.col("v")).alias("evidence"), *(json_values.contains(F.col("v"), part).alias(n) for n, part in tests.items()))


# ---- apply protocol ------------------------------------------------------------------------------------------------------


@query("""with n as (select count(*) as n, count(*) filter (o_orderstatus = 'P') as p from orders) select 'first' as step, 1 as version, n as n_rows, cast(0 as bigint) as done_rows from n union all select 'dry', 1, n, 0 from n union all select 'guarded', 1, n, 0 from n
union all select 'applied', 2, n, p from n union all select 'rolled back', 3, n, 0 from n union all select 'old version', 2, n, p from n""")
def apply_runs(spark, sf):
    """A change of all orders in one state: dry, stopped by a guard, applied, rolled back; and the version before that read again."""
    orders = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    table = apply.VersionedTable(spark, working_folder(spark, "runs"))
    table.write(orders)
    told = []

    def tell(step, version=None):
        rows = table.read(version).agg(F.count("*"), F.count_if(F.col("status") == "DONE")).first()
        told.append((step, version or table.versions()[-1], *rows))

    change = lambda df: df.withColumn("status", F.when(F.col("status") == "P", "DONE").otherwise(F.col("status")))
    allow = lambda a, b: apply.expect(b, {"rows": (F.count("*"), a.count())})
    tell("first")
    apply.run(table, change, allow)
    tell("dry")
    try:
        apply.run(table, change, lambda a, b: apply.expect(b, {"done": (F.count_if(F.col("status") == "DONE"), 0)}), dry=False)
    except apply.GuardError:
        tell("guarded")
    apply.run(table, change, allow, dry=False)
    tell("applied")
    table.rollback(1)
    tell("rolled back")
    tell("old version", 2)
    return spark.createDataFrame(told, "step string, version int, n_rows long, done_rows long")


@query("""select o_orderkey as queue_id, case o_orderkey when 1 then 'exclude_candidate' when 2 then 'discontinued' else o_orderstatus end as status, case o_orderkey when 3 then null when 2 then 'S9' else 'S' || o_custkey end as sku_code,
  cast(case o_orderkey when 1 then 2 when 2 then 2 when 3 then 1 else 0 end as bigint) as n_events, case o_orderkey when 1 then 'hold' when 2 then o_orderstatus when 3 then 'S' || o_custkey end as last_before from orders""")
def decision_log(spark, sf):
    """Reviewers' decisions on a queue of all orders, logged beside it and then written into it with an event for each."""
    kind = "array<struct<action:string,before:string,after:string,reviewer:string,at:string>>"
    queue = t(spark, sf, "orders").select(F.col("o_orderkey").alias("queue_id"), F.col("o_orderstatus").alias("status"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sku_code"), F.array().cast(kind).alias("events"))
    table = apply.VersionedTable(spark, working_folder(spark, "decisions"))
    table.write(queue)
    service = apply.DecisionService(table, {"ann"})
    service.decide(1, "hold", "ann", "t1")
    service.link(2, "S9", "ann", "t2")
    service.decide(1, "exclude", " ann", "t3")
    service.unlink(3, "ann", "t4")
    service.discontinue(2, "ann", "t5")
    service.compact()
    return table.read().select("queue_id", "status", "sku_code", F.size("events").cast("long").alias("n_events"), F.try_element_at("events", F.lit(-1)).getField("before").alias("last_before"))
