"""What tables there are: columns and types from their schemas, exact row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, place, column_name, type, nullable) from the schemas alone; nothing is read."""
    rows = [(k, i + 1, f.name, f.dataType.simpleString(), f.nullable) for k, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, place long, column_name string, type string, nullable boolean")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns): exact counts of all tables in one job. Parquet counts come from the footers."""
    each = (df.agg(F.count("*").alias("n_rows")).select(F.lit(k).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns")) for k, df in tables.items())
    return reduce(DataFrame.unionByName, each)


def missing(tables: dict[str, DataFrame], wanted: dict[str, list[str]]) -> list[str]:
    """Tables and table.columns that are wanted and aren't there."""
    out = []
    for k, names in wanted.items():
        out += [k] if k not in tables else [f"{k}.{c}" for c in names if c not in tables[k].columns]
    return out
