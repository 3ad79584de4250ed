"""The apply protocol: guards, dry runs, versioned tables, upsert, update, delete, audit events, rollback.

A table is a folder of numbered snapshots, and the latest number is the table. A writer makes a whole snapshot and only then does its number
count, as its success marker is written last; so there must be one writer at a time. Changes return new DataFrames and write nothing.
Every write asks the session whether it may (see transaction), and counts that a write must have are taken in the very job that writes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


class GuardError(RuntimeError):
    """A count isn't what it must be; nothing has been written."""


def expect(df: DataFrame, metrics: dict[str, tuple[Column, int]]) -> None:
    """All counts in one pass; raises with every one that differs."""
    got = df.agg(*(c.cast("long").alias(k) for k, (c, _) in metrics.items())).first()
    wrong = {k: (got[k], n) for k, (_, n) in metrics.items() if got[k] != n}
    if wrong:
        raise GuardError(", ".join(f"{k} is {a}, not {b}" for k, (a, b) in wrong.items()))


#: The session setting that says whether library writes are barred.
READ_ONLY = "matchloom.readOnly"


@contextmanager
def transaction(spark: SparkSession, read_only: bool) -> Iterator["RunContext"]:
    """Within it the session may write, or may not; at its end what held before holds again. Nested ones may bar writing, but not allow what an outer one bars."""
    before = spark.conf.get(READ_ONLY, None)
    if before == "true" and not read_only:
        raise GuardError("the session is read-only")
    spark.conf.set(READ_ONLY, str(read_only).lower())
    try:
        yield RunContext.of(spark)
    finally:
        spark.conf.unset(READ_ONLY) if before is None else spark.conf.set(READ_ONLY, before)


def observed_write(df: DataFrame, path: str, metrics: dict[str, tuple[Column, int]] | None = None, drop: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> dict[str, int]:
    """Writes Parquet without a success marker and returns the counts that were taken on the rows as they were written.

    metrics: name -> (aggregate, the count it must be, or None to take it only). If any differs the files go and GuardError names all that differ. drop: columns that only
    the counts need. The counts sit in the last stage, in which each partition's attempt counts once."""
    held = {k: c.cast("long").alias(k) for k, (c, _) in (metrics or {}).items()} | {"rows_written": F.count("*").alias("rows_written")}
    seen = Observation()
    writer = df.observe(seen, *held.values()).drop(*drop).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    got = {k: int(v or 0) for k, v in seen.get.items()}
    wrong = {k: (got[k], n) for k, (_, n) in (metrics or {}).items() if n is not None and got[k] != n}
    if wrong:
        fs, at = files_at(df.sparkSession, path)
        fs.delete(at, True)
        raise GuardError(", ".join(f"{k} is {a}, not {b}" for k, (a, b) in wrong.items()))
    return got


def files_at(spark: SparkSession, path: str):
    """The file system and path of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@dataclass
class VersionedTable:
    spark: SparkSession
    root: str

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._fs()
        if not fs.exists(path):
            return []
        names = [s.getPath() for s in fs.listStatus(path)]
        done = [p for p in names if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()[1:]) for p in done if p.getName().startswith("v"))

    def read(self, version: int | None = None) -> DataFrame:
        at = version if version is not None else self.versions()[-1]
        return self.spark.read.parquet(f"{self.root}/v{at}")

    def write(self, df: DataFrame, metrics: dict[str, tuple[Column, int]] | None = None) -> int:
        """Writes a version and makes it the table, if the session may write and all counts hold that are taken while it is written (name -> (aggregate, count))."""
        RunContext.of(self.spark).require(read_only=False)
        at = max(self.versions(), default=0) + 1
        observed_write(df, f"{self.root}/v{at}", metrics)
        fs, path = self._fs()
        fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/v{at}/_SUCCESS"), False).close()
        return at

    def rollback(self, version: int) -> int:
        """The old snapshot becomes the newest; no snapshot is ever lost."""
        return self.write(self.read(version))


def insert_new(table: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds rows whose key the table hasn't; of rows with one key the least."""
    least = rows.groupBy(*by).agg(F.min(F.struct(*rows.columns)).alias("r")).select("r.*")
    return table.unionByName(least.join(table, by, "left_anti"))


def single_rows(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows, each key checked to stand once; the job fails at the first key that repeats, before anything is written. One grouping of the changes."""
    held = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min(F.struct(*rows.columns)).alias("_r"))
    twice = F.raise_error(F.concat(F.lit("a key stands more than once: "), F.concat_ws(", ", *(F.col(k).cast("string") for k in by)))).cast("boolean")
    return held.where(F.when(F.col("_n") == 1, True).otherwise(twice)).select("_r.*")


def upsert(table: DataFrame, rows: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """Rows replace those of their key, but the columns in keep stay as they were; new keys are added. A key that stands twice in rows fails the job."""
    rows = single_rows(rows.select(*table.columns), by)
    old = table.select(*by, *(F.col(c).alias(f"_old_{c}") for c in keep))
    new = rows.join(old, by, "left").select(*(F.coalesce(f"_old_{c}", c).alias(c) if c in keep else F.col(c) for c in table.columns))
    return table.join(rows, by, "left_anti").unionByName(new)


def update_from(table: DataFrame, changes: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Sets columns where changes have the key; a null in changes sets null. A key that stands twice in changes fails the job."""
    new = single_rows(changes.select(*by, *columns), by).select(*by, F.struct(*columns).alias("_new"))
    return table.join(new, by, "left").select(*(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns))


def delete_using(table: DataFrame, keys: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """What stays, and what went."""
    return table.join(keys, by, "left_anti"), table.join(keys, by, "left_semi")


def append_event(events: Column, action: str, before: Column, after: Column, reviewer: str, at: str) -> Column:
    """Audit events are an array of structs; the time is a parameter, so a run can be repeated."""
    event = F.struct(F.lit(action).alias("action"), before.alias("before"), after.alias("after"), F.lit(reviewer).alias("reviewer"), F.lit(at).alias("at"))
    return F.concat(F.coalesce(events, F.array().cast("array<struct<action:string,before:string,after:string,reviewer:string,at:string>>")), F.array(event))


def run(table: VersionedTable, change: Callable[[DataFrame], DataFrame], guards: Callable[[DataFrame, DataFrame], None], dry: bool = True, metrics: dict[str, tuple[Column, int]] | None = None) -> tuple[DataFrame, int | None]:
    """Works out the change and its guards; writes a new version only if it isn't a dry run. metrics are counts of the new version, taken while it is written."""
    before = table.read()
    after = change(before)
    guards(before, after)
    return after, None if dry else table.write(after, metrics)


#: Decisions: the actions of reviewers and the states they lead to.
DECISIONS = {"approve": "approve_match", "hold": "hold", "exclude": "exclude_candidate", "inactive": "inactive_reviewed", "fix": "needs_source_fix"}
EDITABLE = ("channel_product_code", "channel_option_code", "channel_product_name", "channel_option_name", "product_code", "sku_code", "product_name", "option_name", "recommended_action", "match_reason")
LOG = "queue_id long, field string, value string, action string, reviewer string, at string, place long"


class DecisionService:
    """Reviewers' changes to a queue with the columns queue_id, status and EDITABLE, as a log beside it that is merged on reading.

    A decision appends one small file to the log and leaves the queue's files alone. current() takes each cell's last entry; compact() writes the merged queue as a new version
    with the log's entries as events, after which the log starts anew. One writer at a time."""

    def __init__(self, table: VersionedTable, writers: set[str] | None):
        self.table, self.writers = table, writers

    def status(self, reviewer: str) -> dict[str, object]:
        """Who asks, and whether they may write."""
        known = bool(reviewer.strip())
        return {"reviewer": reviewer.strip(), "known": known, "can_write": known and (self.writers is None or reviewer.strip() in self.writers)}

    def _log_path(self) -> str:
        return f"{self.table.root}/log_v{self.table.versions()[-1]}"

    def log(self) -> DataFrame:
        """The decisions since the last version, in the order of place."""
        spark, path = self.table.spark, self.table.spark._jvm.org.apache.hadoop.fs.Path(self._log_path())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return spark.read.schema(LOG).parquet(self._log_path()) if fs.exists(path) else spark.createDataFrame([], LOG)

    def current(self) -> DataFrame:
        """The queue with every cell's last decision."""
        rows = self.table.read()
        cells = [c for c in rows.columns if c in (*EDITABLE, "status")]
        last = self.log().groupBy(F.col("queue_id").alias("_id")).agg(*(F.max(F.when(F.col("field") == c, F.struct("place", "value"))).alias(f"_{c}") for c in cells))
        both = rows.join(last, F.col("queue_id") == F.col("_id"), "left")
        return both.select(*(F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.value")).otherwise(F.col(c)).alias(c) if c in cells else F.col(c) for c in rows.columns))

    def _change(self, queue_id: int, reviewer: str, at: str, action: str, column: str, value: str | None) -> int:
        if not self.status(reviewer)["can_write"]:
            raise PermissionError(f"{reviewer!r} may not write")
        RunContext.of(self.table.spark).require(read_only=False)
        expect(self.table.read().where(F.col("queue_id") == queue_id), {"rows": (F.count("*"), 1)})
        place = (self.log().agg(F.max("place")).first()[0] or 0) + 1
        self.table.spark.createDataFrame([(queue_id, column, value, action, reviewer.strip(), at, place)], LOG).coalesce(1).write.mode("append").parquet(self._log_path())
        return place

    def compact(self) -> int:
        """Writes current() as a new version; events, if the queue has them, get one entry for each decision."""
        now, log, columns = self.current(), self.log(), self.table.read().columns
        if "events" in columns:
            cells = {c for c in columns if c in (*EDITABLE, "status")}
            before = self.table.read().select(F.col("queue_id").alias("_q"), *(F.col(c).cast("string").alias(f"_b_{c}") for c in cells))
            first = Window.partitionBy("queue_id", "field").orderBy("place")
            old = F.coalesce(*(F.when(F.col("field") == c, F.col(f"_b_{c}")) for c in cells)) if cells else F.lit(None).cast("string")
            told = log.join(before, F.col("queue_id") == F.col("_q")).withColumn("before", F.when(F.row_number().over(first) == 1, old).otherwise(F.lag("value").over(first)))
            entry = F.struct("place", F.struct("action", "before", F.col("value").alias("after"), "reviewer", "at").alias("e"))
            new = told.groupBy(F.col("queue_id").alias("_q")).agg(F.array_sort(F.collect_list(entry)).alias("_new"))
            merged = F.concat(F.coalesce("events", F.array().cast("array<struct<action:string,before:string,after:string,reviewer:string,at:string>>")), F.transform("_new", lambda x: x.e))
            now = now.join(new, F.col("queue_id") == F.col("_q"), "left").withColumn("events", F.when(F.col("_new").isNull(), F.col("events")).otherwise(merged)).select(*columns)
        return self.table.write(now)

    def decide(self, queue_id: int, action: str, reviewer: str, at: str) -> int:
        return self._change(queue_id, reviewer, at, action, "status", DECISIONS[action])

    def discontinue(self, queue_id: int, reviewer: str, at: str) -> int:
        return self._change(queue_id, reviewer, at, "discontinue", "status", "discontinued")

    def link(self, queue_id: int, sku_code: str, reviewer: str, at: str) -> int:
        return self._change(queue_id, reviewer, at, "link", "sku_code", sku_code)

    def unlink(self, queue_id: int, reviewer: str, at: str) -> int:
        return self._change(queue_id, reviewer, at, "unlink", "sku_code", None)

    def edit(self, queue_id: int, column: str, value: str, reviewer: str, at: str) -> int:
        column = column.strip().lower()
        if column not in EDITABLE:
            raise ValueError(f"{column} is not editable")
        return self._change(queue_id, reviewer, at, "edit", column, value)


@dataclass(frozen=True)
class RunContext:
    """Where a job runs: catalog and database of the session, the user, and whether writes are barred (see transaction). Every write of the library asks it."""

    catalog: str
    database: str
    user: str
    read_only: bool

    @classmethod
    def of(cls, spark: SparkSession) -> "RunContext":
        row = spark.sql("select current_catalog() as c, current_database() as d, current_user() as u").first()
        return cls(row.c, row.d, row.u, spark.conf.get(READ_ONLY, "false") == "true")

    def require(self, **wanted: object) -> None:
        """Raises GuardError with everything that differs: require(database="test", read_only=True)."""
        wrong = [f"{k} is {getattr(self, k)!r}, not {v!r}" for k, v in wanted.items() if getattr(self, k) != v]
        if wrong:
            raise GuardError("; ".join(wrong))


def refresh_summary(cache: VersionedTable, summary: DataFrame, at: str) -> int:
    """Replaces the one row of a summary cache; the summary must have exactly one."""
    return cache.write(summary.withColumns({"singleton": F.lit(True), "refreshed_at": F.lit(at)}), {"rows": (F.count("*"), 1)})


def merge_json(base: Column, more: dict[str, Column], strip_nulls: bool = True) -> Column:
    """A flat JSON object of texts with some keys set; strip_nulls leaves out keys whose value is null. Keys come out in order."""
    old = F.coalesce(F.from_json(base, "map<string,string>"), F.create_map().cast("map<string,string>"))
    names = F.array(*(F.lit(k) for k in more))
    new = F.map_from_arrays(names, F.array(*(v.cast("string") for v in more.values())))
    both = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(names, k)), new)
    both = F.map_filter(both, lambda k, v: v.isNotNull()) if strip_nulls else both
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(both))), {"ignoreNullFields": "false"})


def json_contains(whole: Column, part: dict[str, str]) -> Column:
    """Whether a flat JSON object has all these keys with these values."""
    held = F.from_json(whole, "map<string,string>")
    out = F.lit(True)
    for k, v in part.items():
        out = out & F.coalesce(F.element_at(held, k) == v, F.lit(False))
    return out


#: Order states and the moves between them.
ORDER_MOVES = [("received", "picking"), ("picking", "shortage"), ("picking", "inspection"), ("shortage", "picking"), ("inspection", "hold"), ("hold", "inspection"), ("inspection", "shipped"), ("received", "cancelled"), ("picking", "cancelled"), ("hold", "cancelled")]


def allowed_moves(moves: DataFrame, state_from: str = "state_from", state_to: str = "state_to") -> DataFrame:
    """Adds allowed to rows with a state before and after."""
    pair = F.array(*(F.lit(f"{a}>{b}") for a, b in ORDER_MOVES))
    return moves.withColumn("allowed", F.coalesce(F.array_contains(pair, F.concat(state_from, F.lit(">"), state_to)), F.lit(False)))
