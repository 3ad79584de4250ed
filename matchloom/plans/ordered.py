"""A table in a total order over many files: global row numbers, pages at any depth and filling down, none of them through one task.

write() deals the rows to ranges of the order (Spark samples the bounds), sorts each range and writes it as a folder of its own; beside them lies a small table with a row for each range:
its number of rows, how many stand before it, and its first key. A row's number is its place in its range and what stands before the range. A page opens only the
ranges that it lies in. Rows that are equal in the order have an arbitrary, fixed sequence; give an order without ties for a repeatable one. Many equal rows are one range, which
one task sorts: end the order with columns that tell them apart.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .apply import files_at

PART, PLACE = "_part", "_place"


@dataclass
class OrderedTable:
    spark: SparkSession
    root: str
    order: list[str]

    @classmethod
    def write(cls, df: DataFrame, order: list[str], root: str, ranges: int | None = None) -> "OrderedTable":
        """order: column names, each ascending with nulls first. ranges: into how many the rows are dealt; by default as many as Spark's shuffles have."""
        keys = [F.col(c).asc_nulls_first() for c in order]
        dealt = (df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
        placed = dealt.select("*", F.spark_partition_id().alias(PART), F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias(PLACE))
        placed.write.partitionBy(PART).parquet(f"{root}/rows")
        fs, at = files_at(df.sparkSession, f"{root}/schema.json")
        held = fs.create(at, False)
        held.write(placed.schema.json().encode())
        held.close()
        out = cls(df.sparkSession, root, order)
        rows = out._rows()
        first = rows.groupBy(PART).agg(F.count("*").alias("n"), F.min_by(F.struct(*order), PLACE).alias("first"))
        # one row for each range
        before = F.coalesce(F.sum("n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        first.withColumn("before", before).coalesce(1).write.parquet(f"{root}/ranges")
        return out

    def _rows(self, parts: list | None = None) -> DataFrame:
        """All rows, or those of some ranges: only their folders are listed."""
        schema = StructType.fromJson(json.loads(self.spark.read.text(f"{self.root}/schema.json", wholetext=True).first().value))
        paths = [f"{self.root}/rows"] if parts is None else [f"{self.root}/rows/{PART}={r[PART]}" for r in parts]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/rows").parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.select(*schema.names)

    def ranges(self) -> DataFrame:
        """_part, n, first and before: a row for each range."""
        return self.spark.read.parquet(f"{self.root}/ranges")

    def numbered(self, name: str = "row_no") -> DataFrame:
        """All rows with their number in the order, from 1. The ranges' table has a row for each written range and is joined as Spark sees fit."""
        before = self.ranges().select(PART, "before")
        return self._rows().join(before, PART).withColumn(name, F.col("before") + F.col(PLACE) + 1).drop(PART, PLACE, "before")

    def page(self, number: int, size: int) -> DataFrame:
        """The rows of a page, in order, numbered from 1 in row_no. Reads the ranges that the page lies in, whatever its number."""
        low, high = (max(number, 1) - 1) * size, max(number, 1) * size
        parts = self.ranges().where((F.col("before") < high) & (F.col("before") + F.col("n") > low)).collect()  # as many as a page can lie in
        rows = None
        for r in parts:
            own = self._rows([r]).where((F.col(PLACE) >= low - r.before) & (F.col(PLACE) < high - r.before)).withColumn("row_no", F.col(PLACE) + 1 + r.before)
            rows = own if rows is None else rows.union(own)
        rows = rows if rows is not None else self._rows([]).withColumn("row_no", F.col(PLACE) + 1)
        return rows.drop(PART, PLACE).orderBy("row_no")

    def page_after(self, key: list | None, size: int) -> DataFrame:
        """The first rows behind a key, the values of the order's columns in the last row of the page before; None is the first page. No null may stand in key."""
        if key is None:
            return self.page(1, size)
        behind = F.lit(False)
        for i, c in reversed(list(enumerate(self.order))):
            here = F.col(c) > F.lit(key[i])
            behind = here | (F.col(c).eqNullSafe(F.lit(key[i])) & behind)
        given = F.struct(*(F.lit(v).alias(c) for c, v in zip(self.order, key, strict=True))).cast(self.ranges().schema["first"].dataType)
        start = self.ranges().agg(F.max(F.when(F.col("first") <= given, F.col(PART)))).first()[0]
        # the range that holds the key, and those after it until there are enough rows
        later = self.ranges().where(F.col(PART) >= (start or 0)).withColumn("ahead", F.coalesce(F.sum(F.when(F.col(PART) > (start or 0), F.col("n"))).over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        parts = later.where((F.col("ahead") < size)).select(PART).collect()
        return self._rows(parts).where(F.coalesce(behind, F.lit(False))).drop(PART, PLACE).orderBy(*self.order).limit(size)

    def forward_fill(self, by: list[str], columns: list[str]) -> DataFrame:
        """Blank cells take the last value above them, within the key (a file, a sheet), however many ranges that spans.

        Filled within each range first; the last value of each key in each range, a small table, is then handed to the ranges after it."""
        rows = self._rows()
        value = {c: F.nullif(F.trim(c), F.lit("")) for c in columns}
        last = rows.groupBy(*by, PART).agg(*(F.max_by(value[c], F.when(value[c].isNotNull(), F.col(PLACE))).alias(f"_last_{c}") for c in columns))
        earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        carried = last.select(*(F.col(k).alias(f"_k_{k}") for k in by), F.col(PART).alias("_k_part"), *(F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns))
        own = Window.partitionBy(*by, PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
        filled = rows.withColumns({f"_own_{c}": F.last(value[c], ignorenulls=True).over(own) for c in columns})
        on = F.col(PART) == F.col("_k_part")
        for k in by:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        names = [c for c in rows.columns if c not in (PART, PLACE)]
        both = filled.join(carried, on, "left")
        return both.select(*(F.coalesce(f"_own_{c}", f"_carry_{c}").alias(c) if c in columns else F.col(c) for c in names))


def numbered(df: DataFrame, order: list[str], root: str, name: str = "row_no", ranges: int | None = None) -> DataFrame:
    """The rows with their number in the order, as row_number() over the whole table gives it, by ranges instead of in one task."""
    return OrderedTable.write(df, order, root, ranges).numbered(name)
