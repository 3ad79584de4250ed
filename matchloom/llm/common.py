"""What the corpus operators share: tables in the cluster's shared folder, column names, Arrow text."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a new local one if the session runs on this machine alone; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="matchloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables of one run, written as Parquet to the shared folder: they cut lineage and outlive executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Removes a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or that with underscores before it, so that no column of df has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most_bytes: int = 2_000_000):
    """Row ranges of about so many bytes each; a longer row is a range of its own."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        yield at, min(to, rows)
        at = to


def exact_binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())
