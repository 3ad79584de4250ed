"""Planned inserts with a class for every source row, and change requests that only a writer applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.text import nonblank

from .apply import GuardError, VersionedTable, append_event

UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def insert_classes(rows: DataFrame, existing: DataFrame, master: DataFrame, checks: dict[str, Column], item_pattern: str = UUID) -> DataFrame:
    """Adds apply_class to rows: what keeps a row from being inserted, or insert.

    rows: code, item (texts) and what the checks need; existing: code, item; master: item. In order: null_code, blank_item, invalid_item, missing_item,
    duplicate_source (the code stands twice in rows), idempotent_existing (the code has this item alone), conflict_existing, then the checks by name
    (a check that is false or null fails). Each key is reduced to a row before it is joined, so rows keep their number."""
    twice = rows.where(nonblank(F.col("code"))).groupBy("code").agg((F.count("*") > 1).alias("_twice"))
    held = existing.groupBy("code").agg(F.count_distinct("item").alias("_n_held"), F.min("item").alias("_held"))
    known = master.select("item").distinct().withColumn("_known", F.lit(True))
    out = rows.join(twice, "code", "left").join(held, "code", "left").join(known, "item", "left")
    found = (
        F.when(~nonblank(F.col("code")), "null_code")
        .when(~nonblank(F.col("item")), "blank_item")
        .when(~F.col("item").rlike(item_pattern), "invalid_item")
        .when(F.col("_known").isNull(), "missing_item")
        .when(F.col("_twice"), "duplicate_source")
        .when((F.col("_n_held") == 1) & (F.col("_held") == F.col("item")), "idempotent_existing")
        .when(F.col("_n_held").isNotNull(), "conflict_existing")
    )
    for name, p in checks.items():
        found = found.when(~F.coalesce(p, F.lit(False)), name)
    return out.select(*rows.columns, found.otherwise("insert").alias("apply_class"))


def insert_by_plan(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows as the table's columns: those that both have, cast to the table's types, the others null. Bad casts give null; extra columns of rows are left out."""
    plan = [(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in table.schema]
    return table.unionByName(rows.select(*plan))


# Kinds of change requests and the moves between their states. What is applied, rejected or cancelled stays so.
REQUEST_KINDS = ("alias_add", "alias_update", "sku_update", "product_update", "channel_mapping_update", "unmatched_resolution", "merge_candidate")
REQUEST_MOVES = {"submit": ("draft", "submitted"), "approve": ("submitted", "approved"), "reject": ("submitted", "rejected"), "apply": ("approved", "applied")}
CANCEL_FROM = ("draft", "submitted")


def next_state(action: Column, state: Column) -> Column:
    """The state after an action; null if the action isn't allowed there."""
    out = F.when((action == "cancel") & state.isin(*CANCEL_FROM), "cancelled")
    for name, (before, after) in REQUEST_MOVES.items():
        out = out.when((action == name) & (state == before), after)
    return out


class ChangeRequests:
    """Requests (request_id, kind, target_key, field, value, state, events) in a versioned table; apply changes the target table. One writer at a time.

    Many requests move in one call and give one version: either all of them may move, or GuardError is raised and nothing is written."""

    SCHEMA = "request_id string, kind string, target_key string, field string, value string, state string, events array<struct<action:string,before:string,after:string,reviewer:string,at:string>>"

    def __init__(self, table: VersionedTable):
        self.table = table

    def draft(self, rows: DataFrame, reviewer: str, at: str) -> int:
        """rows: request_id, kind, target_key, field, value. Ids must be new and stand once, kinds known."""
        if self.table.versions():
            old = self.table.read()
        else:
            old = self.table.spark.createDataFrame([], self.SCHEMA)
        bad = rows.where(~F.col("kind").isin(*REQUEST_KINDS) | F.col("kind").isNull()).select("request_id")
        twice = rows.select("request_id").union(old.select("request_id")).groupBy("request_id").count().where("count > 1").select("request_id").join(rows, "request_id", "left_semi")
        wrong = bad.union(twice).limit(3).collect()
        if wrong:
            raise GuardError(f"requests of an unknown kind or with a used id, such as {[r.request_id for r in wrong]}")
        events = append_event(F.lit(None), "draft", F.lit(None).cast("string"), F.lit("draft"), reviewer, at)
        return self.table.write(old.unionByName(rows.select("request_id", "kind", "target_key", "field", "value", F.lit("draft").alias("state"), events.alias("events"))))

    def move(self, ids: DataFrame, action: str, reviewer: str, at: str) -> int:
        """ids: request_id. Every id must be known and its state allow the action."""
        asked = ids.select("request_id").distinct().withColumn("_asked", F.lit(True))
        both = self.table.read().join(asked, "request_id", "full").withColumn("_after", F.when(F.col("_asked"), next_state(F.lit(action), F.col("state"))))
        wrong = both.where("_asked and _after is null").select("request_id").limit(3).collect()
        if wrong:
            raise GuardError(f"{action} is not allowed for requests such as {[r.request_id for r in wrong]}")
        event = append_event(F.col("events"), action, F.col("state"), F.col("_after"), reviewer, at)
        moved = both.withColumns({"events": F.when(F.col("_asked"), event).otherwise(F.col("events")), "state": F.coalesce("_after", "state")})
        return self.table.write(moved.drop("_asked", "_after"))

    def apply(self, target: VersionedTable, key: str, fields: tuple[str, ...], reviewer: str, at: str) -> tuple[int, int]:
        """Sets the approved fields in the target and marks the requests applied; returns both versions.

        The target is written first. If the second write is lost, the requests stay approved, and applying them again sets the same values.
        Of several approved requests for a cell the greatest request_id wins; fields outside the list and keys that the target lacks raise GuardError."""
        approved, rows = self.table.read().where("state = 'approved'"), target.read()
        if bad := approved.where(~F.col("field").isin(*fields)).select("field").distinct().limit(3).collect():
            raise GuardError(f"fields that may not be changed: {[r.field for r in bad]}")
        if bad := approved.join(rows.select(F.col(key).cast("string").alias("target_key")), "target_key", "left_anti").select("target_key").limit(3).collect():
            raise GuardError(f"unknown targets such as {[r.target_key for r in bad]}")
        last = approved.groupBy(F.col("target_key").alias("_key")).agg(*(F.max(F.when(F.col("field") == f, F.struct("request_id", "value"))).alias(f"_{f}") for f in fields))
        joined = rows.join(last, F.col(key).cast("string") == F.col("_key"), "left")
        kinds = dict(rows.dtypes)
        new = joined.select(*(F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.value").cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns))
        return target.write(new), self.move(approved, "apply", reviewer, at)
