"""A table kept by key in buckets, so that a change rewrites only the buckets it touches, with before-images and a restore by row.

A version is a manifest, one small file: for each bucket the folder that holds its rows. A change reads the buckets of its keys, writes those anew in a folder of its own and then
creates the next manifest; buckets that it doesn't touch are the same files in both versions. Creating a manifest that exists fails, so of two writers with
one base the later one fails and changes nothing. Old manifests stay readable.

Rows are dealt to buckets by a hash of their key. The number of buckets is fixed when the table is made: choose it so that one bucket is a few tasks' work. A key must stand once.
Null keys are a key like others. The driver holds manifests and the numbers of touched buckets, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .apply import GuardError, RunContext, files_at, observed_write, single_rows

BUCKET, CHANGED = "_bucket", "_changed"


def same_key(left: str, right: str, by: list[str]) -> Column:
    """Equality of all key columns under two aliases, nulls equal."""
    out = None
    for k in by:
        one = F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        out = one if out is None else out & one
    return out


@dataclass
class KeyedTable:
    spark: SparkSession
    root: str

    # ---- manifests ----

    def versions(self) -> list[int]:
        fs, at = files_at(self.spark, f"{self.root}/manifests")
        return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(at)) if fs.exists(at) else []

    def manifest(self, version: int | None = None) -> dict:
        at = version if version is not None else self.versions()[-1]
        rows = self.spark.read.text(f"{self.root}/manifests/{at}.json", wholetext=True)
        return json.loads(rows.first().value)

    def _publish(self, version: int, manifest: dict) -> int:
        fs, at = files_at(self.spark, f"{self.root}/manifests/{version}.json")
        if fs.exists(at):
            raise GuardError(f"version {version} exists: another writer was first")
        out = fs.create(at, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        return version

    # ---- reading ----

    def _bucket(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(*manifest["by"]), F.lit(manifest["buckets"])).cast("int")

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All rows of a version, or those of some buckets."""
        return self._rows(self.manifest(version), buckets)

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        paths = [f"{self.root}/data/{folder}/{BUCKET}={b}" for b, folder in manifest["folders"].items() if buckets is None or int(b) in set(buckets)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows with these keys; only their buckets are read."""
        manifest = self.manifest(version)
        keys = keys.select(*manifest["by"]).distinct()
        old = self._rows(manifest, self._touched(manifest, keys))
        return old.alias("o").join(keys.alias("k"), same_key("o", "k", manifest["by"]), "left_semi")

    def _touched(self, manifest: dict, keys: DataFrame) -> list[int]:
        return sorted(r[0] for r in keys.select(self._bucket(manifest)).distinct().collect())  # at most one number for each bucket

    def differing(self, old: int, new: int) -> tuple[DataFrame, DataFrame]:
        """The rows of the buckets that differ between two versions, as they are in the old one and in the new one. Rows of other buckets are the same files."""
        a, b = self.manifest(old), self.manifest(new)
        moved = [int(k) for k in sorted({*a["folders"], *b["folders"]}) if a["folders"].get(k) != b["folders"].get(k)]
        return self._rows(a, moved), self._rows(b, moved)

    # ---- writing ----

    def create(self, rows: DataFrame, by: list[str], buckets: int = 64, files: int = 1, metrics: dict[str, tuple[Column, int]] | None = None) -> int:
        """The first version. files: into so many files a bucket is written, each by one task."""
        RunContext.of(self.spark).require(read_only=False)
        if self.versions():
            raise GuardError("the table exists")
        manifest = {"by": by, "buckets": buckets, "files": files, "schema": rows.schema.jsonValue(), "folders": {}, "markers": {}, "restored": []}
        return self._write(manifest, 0, single_rows(rows, by).withColumn(CHANGED, F.lit(True)), list(range(buckets)), metrics)

    def _write(self, manifest: dict, base: int, rows: DataFrame, touched: list[int], metrics: dict[str, tuple[Column, int]] | None) -> int:
        """Writes the touched buckets' rows, counted as they are written, and then the manifest of the version after base."""
        folder, columns = f"{base + 1}-{uuid.uuid4().hex}", [f["name"] for f in manifest["schema"]["fields"]]
        rows = rows.select(*columns, CHANGED, self._bucket(manifest).alias(BUCKET))
        deal = F.pmod(F.xxhash64(*manifest["by"], F.lit(1)), F.lit(manifest["files"]))
        dealt = rows.repartition(len(touched) * manifest["files"], BUCKET, deal)
        at = f"{self.root}/data/{folder}"
        observed_write(dealt, at, metrics, (CHANGED,), (BUCKET,))
        fs, path = files_at(self.spark, at)
        full = {s.getPath().getName().split("=")[1] for s in fs.listStatus(path) if "=" in s.getPath().getName()}
        folders = {b: f for b, f in manifest["folders"].items() if int(b) not in set(touched)} | {b: folder for b in full}
        return self._publish(base + 1, manifest | {"folders": folders})

    def change(self, keys: DataFrame, rewrite: Callable[[DataFrame], DataFrame], metrics: dict[str, tuple[Column, int]] | None = None, manifest: dict | None = None, base: int | None = None) -> int:
        """Rewrites the buckets of the keys. rewrite: their rows -> their new rows, with a boolean column _changed that counts may use; rows must stay in their buckets."""
        RunContext.of(self.spark).require(read_only=False)
        base = self.versions()[-1] if base is None else base
        manifest = manifest or self.manifest(base)
        touched = self._touched(manifest, keys)
        if not touched:
            if wrong := {k: n for k, (_, n) in (metrics or {}).items() if n}:
                raise GuardError(", ".join(f"{k} is 0, not {n}" for k, n in wrong.items()))
            return self._publish(base + 1, manifest)
        return self._write(manifest, base, rewrite(self._rows(manifest, touched)), touched, metrics)

    def insert(self, rows: DataFrame, expected: int | None = None) -> int:
        """Adds rows whose key the table hasn't; others do nothing. expected: the number of rows that are added."""
        by = self.manifest()["by"]
        new = single_rows(rows, by)

        def rewrite(old: DataFrame) -> DataFrame:
            added = new.alias("n").join(old.alias("o"), same_key("n", "o", by), "left_anti").withColumn(CHANGED, F.lit(True))
            return old.withColumn(CHANGED, F.lit(False)).unionByName(added)

        return self.change(new, rewrite, self._counted(expected))

    def upsert(self, rows: DataFrame, keep: tuple[str, ...] = (), expected: int | None = None) -> int:
        """Rows replace those of their key, but for the columns in keep; new keys are added. expected: the number of rows that are replaced or added."""
        by = self.manifest()["by"]
        new = single_rows(rows, by)

        def rewrite(old: DataFrame) -> DataFrame:
            both = old.withColumn("_old", F.lit(True)).alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), same_key("o", "n", by), "full")
            pick = lambda c: F.when(F.col("_new").isNull() | (F.col("_old").isNotNull() if c in keep else F.lit(False)), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
            return both.select(*(pick(c).alias(c) for c in old.columns), F.col("_new").isNotNull().alias(CHANGED))

        return self.change(new, rewrite, self._counted(expected))

    def update(self, changes: DataFrame, columns: list[str], expected: int | None = None) -> int:
        """Sets columns where changes have the key; a null sets null. expected: the number of rows that are set."""
        return self._update(changes, columns, self._counted(expected), self.manifest(), self.versions()[-1])

    def _update(self, changes: DataFrame, columns: list[str], metrics: dict | None, manifest: dict, base: int) -> int:
        by = manifest["by"]
        new = single_rows(changes.select(*by, *columns), by)

        def rewrite(old: DataFrame) -> DataFrame:
            both = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), same_key("o", "n", by), "left")
            hit = F.col("_new").isNotNull()
            return both.select(*(F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in columns else F.col(f"o.{c}") for c in old.columns), hit.alias(CHANGED))

        return self.change(new, rewrite, metrics, manifest, base)

    def delete(self, keys: DataFrame, expected: int | None = None) -> int:
        """Takes out the rows of these keys. expected: the number of rows that the touched buckets keep less by."""
        manifest = self.manifest()
        by = manifest["by"]
        gone = keys.select(*by).distinct()
        metrics = None
        if expected is not None:  # of the touched buckets so many rows must stay
            metrics = {"rows_kept": (F.count("*"), self._rows(manifest, self._touched(manifest, gone)).count() - expected)}
        return self.change(gone, lambda old: old.alias("o").join(gone.alias("k"), same_key("o", "k", by), "left_anti").withColumn(CHANGED, F.lit(True)), metrics)

    @staticmethod
    def _counted(expected: int | None) -> dict[str, tuple[Column, int]] | None:
        return None if expected is None else {"changed_rows": (F.count_if(CHANGED), expected)}

    # ---- marked changes ----

    def apply_marked(self, changes: DataFrame, columns: list[str], marker: str, expected: int) -> int:
        """update() under a marker: the rows' values before and after are written first, and count from the same manifest on as the change itself.

        The marker must be new, and changes, before-images and rows set must each be `expected` in number; else nothing changes."""
        RunContext.of(self.spark).require(read_only=False)
        base = self.versions()[-1]
        manifest = self.manifest(base)
        by = manifest["by"]
        if marker in manifest["markers"]:
            raise GuardError(f"the marker {marker} exists")
        new = single_rows(changes.select(*by, *columns), by)
        old = self._rows(manifest, self._touched(manifest, new))
        both = old.alias("o").join(new.alias("n"), same_key("o", "n", by))
        held = both.select(*(F.col(f"o.{k}") for k in by), F.struct(*(F.col(f"o.{c}") for c in columns)).alias("before"), F.struct(*(F.col(f"n.{c}") for c in columns)).alias("after"))
        folder = f"{base + 1}-{uuid.uuid4().hex}"
        image = held.withColumn("marker", F.lit(marker)).repartition(max(1, min(manifest["buckets"], 64)), *by)
        observed_write(image, f"{self.root}/changes/{folder}", {"before_images": (F.count("*"), expected)})
        markers = manifest["markers"] | {marker: {"folder": folder, "columns": columns, "rows": expected, "schema": image.schema.jsonValue()}}
        return self._update(new, columns, self._counted(expected), manifest | {"markers": markers}, base)

    def marked(self, marker: str) -> DataFrame:
        """Key, before, after and marker of the rows that a marked change set."""
        held = self.manifest()["markers"][marker]
        return self.spark.read.schema(StructType.fromJson(held["schema"])).parquet(f"{self.root}/changes/{held['folder']}")

    def restore(self, marker: str, expected: int) -> int:
        """Sets the rows of a marked change, and no others, back to what they were before it. Changes made since to other rows, and to other columns of these, stay."""
        base = self.versions()[-1]
        manifest = self.manifest(base)
        if marker not in manifest["markers"] or marker in manifest["restored"]:
            raise GuardError(f"there is no change {marker} to restore")
        held = manifest["markers"][marker]
        if held["rows"] != expected:
            raise GuardError(f"before-images is {held['rows']}, not {expected}")
        rows = self.marked(marker).select(*manifest["by"], *(F.col(f"before.{c}").alias(c) for c in held["columns"]))
        return self._update(rows, held["columns"], self._counted(expected), manifest | {"restored": [*manifest["restored"], marker]}, base)

    def restored_counts(self, marker: str) -> DataFrame:
        """For each column of a marked change, how many of its rows hold the value from before it, and how many rows there are."""
        manifest = self.manifest()
        held = manifest["markers"][marker]
        images = self.marked(marker)
        both = self._rows(manifest, self._touched(manifest, images)).alias("o").join(images.alias("i"), same_key("o", "i", manifest["by"]))
        counts = both.agg(F.count("*").alias("n"), *(F.count_if(F.col(f"o.{c}").eqNullSafe(F.col(f"i.before.{c}"))).alias(f"_{c}") for c in held["columns"]))
        cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("restored_rows"), F.col("n").alias("marked_rows")) for c in held["columns"]))
        return counts.select(F.explode(cells).alias("c")).select("c.*")
