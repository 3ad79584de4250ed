"""Files: all-string CSV, sheets of XLSX and SpreadsheetML-2003, header aliases, a registry of hashes, row hashes, CSV export."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators.relational import metric_rows, top_rows

from .split_csv import read_csv_split

ROWS = "path string, sheet string, row_no long, cells array<string>"


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """All columns are strings; an empty cell is null, a quoted empty one is ''. Rows of blank cells alone are dropped; a byte order mark is not part of the first name."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", encoding).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    return df.where(F.trim(F.concat_ws("", *(f"`{c}`" for c in df.columns))) != "")


ENCODINGS = ("utf-8-sig", "cp949", "utf-8")


def read_csv_any(spark: SparkSession, path: str, encodings: tuple[str, ...] = ENCODINGS) -> tuple[DataFrame, str]:
    """All-string columns of the files by the first encoding in which every one of them decodes, with its name. For encodings that Spark's own reader doesn't take.

    Large files are read by ranges, see split_csv. All must have the same header. An empty cell is '', a missing one null; rows of blank cells alone are dropped."""
    return read_csv_split(spark, path, encodings)


# The columns of the integrity report.
INTEGRITY = ("product_uid", "sto_id", "sto_code", "opt_value", "opt_values")


def csv_integrity(rows: DataFrame, bracket: str) -> DataFrame:
    """(metric, value): counts of rows, blanks, bracketed codes, resolvable rows and keys that repeat, for a sheet with the columns INTEGRITY.

    A row resolves by its own code, else by a bracketed code of either text. Two passes over keys and one over rows; nulls are blank."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    count = lambda p: F.count(F.when(p, 1))
    code = {c: F.nullif(F.regexp_extract(F.coalesce(F.col(c), F.lit("")), bracket, 1), F.lit("")) for c in ("opt_value", "opt_values")}
    solved = (text("sto_code") != "") | code["opt_value"].isNotNull() | code["opt_values"].isNotNull()
    metrics = {"row_count": F.count("*"), "product_uid_distinct": F.count_distinct(F.nullif(text("product_uid"), F.lit("")))}
    metrics |= {f"{c}_blank_rows": count(text(c) == "") for c in INTEGRITY}
    for c, x in code.items():
        metrics |= {f"{c}_bracket_hits": count(x.isNotNull()), f"{c}_bracket_unique_codes": F.count_distinct(x)}
    metrics |= {"own_sku_candidate_resolvable": count(solved), "own_sku_candidate_unresolvable": count(~solved)}
    out = metric_rows(rows, metrics)
    for name, keys in (("sto_id", ["sto_id"]), ("product_sto", ["product_uid", "sto_id"])):
        each = rows.select(*(text(k).alias(k) for k in keys)).where(" and ".join(f"{k} != ''" for k in keys)).groupBy(*keys).agg(F.count("*").alias("n"))
        out = out.unionByName(metric_rows(each, {f"{name}_duplicate_keys": count(F.col("n") > 1), f"{name}_duplicate_rows": F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))}))
    return out


def keyed_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """An apply map: of the rows with all keys (trimmed, not blank) the last of each key by the order, with apply_key, the keys joined by |."""
    trimmed = rows.withColumns({k: F.trim(F.col(k).cast("string")) for k in keys}).where(" and ".join(f"`{k}` != ''" for k in keys))
    return top_rows(trimmed, keys, [F.col(order).desc_nulls_last()]).withColumn("apply_key", F.concat_ws("|", *keys))


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of JSON files of the form {"rows": [...]}, with row_no, the place in the list; files that have none give none."""
    return spark.read.schema(f"rows array<struct<{schema}>>").option("multiLine", True).json(path).select(F.posexplode("rows").alias("row_no", "r")).select("row_no", "r.*")


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _placed(cells: list[tuple[int, str]]) -> list[str]:
    out = [""] * (max((i for i, _ in cells), default=-1) + 1)
    for i, v in cells:
        out[i] = v
    return out


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


def xlsx_sheets(content: bytes):
    """(sheet, its XML, the workbook's shared strings as XML or None) of each sheet of a workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = z.read("xl/sharedStrings.xml") if "xl/sharedStrings.xml" in z.namelist() else None
        sheets = [e.get("name") for e in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _tag(e) == "sheet"]
        for n, sheet in enumerate(sheets, 1):
            yield sheet, z.read(f"xl/worksheets/sheet{n}.xml"), shared


def xlsx_sheet_rows(xml: bytes, shared: bytes | None):
    """(row number, cells) of one sheet; every cell is text, missing ones are ''."""
    texts = ["".join(t.text or "" for t in s.iter() if _tag(t) == "t") for s in ElementTree.fromstring(shared) if _tag(s) == "si"] if shared else []
    for _, row in ElementTree.iterparse(io.BytesIO(xml)):
        if _tag(row) != "row":
            continue
        cells = []
        for c in row:
            text = "".join(v.text or "" for v in c.iter() if _tag(v) in ("v", "t"))
            cells.append((_column(c.get("r")), texts[int(text)] if c.get("t") == "s" else text))
        yield int(row.get("r")), _placed(cells)
        row.clear()


def spreadsheetml_sheets(content: bytes):
    """(sheet, its XML, None) of each sheet of a SpreadsheetML-2003 file: the sheet's bytes within the file's own root element."""
    root = re.search(rb"<(\w+:)?Workbook\b[^>]*>", content)
    for found in re.finditer(rb"<((?:\w+:)?)Worksheet\b.*?</\1Worksheet>", content, re.S):
        name = re.match(rb"<[^>]*\bName\s*=\s*(\"[^\"]*\"|'[^']*')", found.group())
        label = ElementTree.fromstring(b"<x n=" + name.group(1) + b"/>").get("n") if name else None
        yield label, root.group() + found.group() + b"</" + (root.group(1) or b"") + b"Workbook>", None


def spreadsheetml_sheet_rows(xml: bytes, shared: bytes | None = None):
    """(row number, cells) of one sheet; a cell's Index leaves a gap, rows without text are skipped but counted."""
    get = lambda e, k: next((v for a, v in e.attrib.items() if a.rpartition("}")[2] == k), None)
    at = 0
    for _, e in ElementTree.iterparse(io.BytesIO(xml)):
        if _tag(e) == "Row":
            at = int(get(e, "Index") or at + 1)
            cells, i = [], -1
            for c in e:
                if _tag(c) == "Cell":
                    i = int(get(c, "Index")) - 1 if get(c, "Index") else i + 1
                    cells.append((i, "".join(c.itertext())))
            if any(v.strip() for _, v in cells):
                yield at, _placed(cells)
            e.clear()


SHEETS = {"xlsx": (xlsx_sheets, xlsx_sheet_rows), "spreadsheetml": (spreadsheetml_sheets, spreadsheetml_sheet_rows)}


def xlsx_rows(content: bytes):
    """(sheet, row number, cells) of a whole workbook."""
    return ((sheet, *row) for sheet, xml, shared in xlsx_sheets(content) for row in xlsx_sheet_rows(xml, shared))


def spreadsheetml_rows(content: bytes):
    """(sheet, row number, cells) of a whole SpreadsheetML-2003 file."""
    return ((sheet, *row) for sheet, xml, _ in spreadsheetml_sheets(content) for row in spreadsheetml_sheet_rows(xml))


def read_sheets(spark: SparkSession, path: str, kind: str = "xlsx", only: tuple[int, ...] | None = None, tasks: int | None = None) -> DataFrame:
    """path, sheet, row_no and cells of every workbook under path; row numbers give the order. only: places (from 0) of the cells that are wanted, the others are ''.

    A workbook is taken apart where it is read, and its sheets, compressed, are dealt out by name, so that sheets of one workbook are parsed by different tasks. Files come through
    Spark's own reader, so they may be in any store that it opens; a data source in Python would have to open them by itself."""
    apart, parse = SHEETS[kind]

    def sheets(batches):
        import zlib

        import pandas as pd

        for batch in batches:
            for p, content in zip(batch.path, batch.content, strict=True):
                for sheet, xml, shared in apart(bytes(content)):
                    yield pd.DataFrame([(p, sheet, zlib.compress(xml, 1), zlib.compress(shared, 1) if shared else None)], columns=["path", "sheet", "xml", "shared"])

    def rows(batches):
        import zlib

        import pandas as pd

        for batch in batches:
            for p, sheet, xml, shared in zip(batch.path, batch.sheet, batch.xml, batch.shared, strict=True):
                out = [(p, sheet, n, [v if only is None or i in only else "" for i, v in enumerate(cells)]) for n, cells in parse(zlib.decompress(xml), zlib.decompress(shared) if shared is not None else None)]
                if out:
                    yield pd.DataFrame(out, columns=["path", "sheet", "row_no", "cells"])

    found = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(sheets, "path string, sheet string, xml binary, shared binary")
    dealt = found.repartition(tasks, "path", "sheet") if tasks else found.repartition("path", "sheet")
    return dealt.mapInPandas(rows, ROWS)


def with_header(rows: DataFrame, wanted: dict[str, list[str]], header_row: int = 1, fixed: dict[str, int] | None = None) -> DataFrame:
    """Named columns from cells: a fixed place (from 0) if the row is that wide, else the first of the name's aliases in the header (white space and case
    ignored), else null. Below the header only."""
    plain = lambda c: F.regexp_replace(F.lower(c), r"\s+", "")
    head = rows.where(F.col("row_no") == header_row).select("path", "sheet", F.transform("cells", plain).alias("_head"))
    both = rows.where(F.col("row_no") > header_row).join(head, ["path", "sheet"])
    at = lambda names: F.coalesce(*(F.nullif(F.array_position("_head", re.sub(r"\s+", "", n.lower())), F.lit(0)) for n in names))
    found = {k: F.get("cells", (at(names) - 1).cast("int")) for k, names in wanted.items()}
    found |= {k: F.when(F.size("_head") > i, F.get("cells", F.lit(i))).otherwise(found.get(k, F.lit(None).cast("string"))) for k, i in (fixed or {}).items()}
    return both.select("path", "sheet", "row_no", *(c.alias(k) for k, c in found.items()))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def file_registry(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """path, sha256 and bytes of every file, without those whose hash is known already."""
    found = spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    return found.join(known.select("sha256"), "sha256", "left_anti") if known is not None else found


def table_facts(rows: DataFrame) -> DataFrame:
    """Per path of sheet rows (path, sheet, row_no, cells): row_count, column_count (the widest row) and sheet_count, to stand beside file_registry."""
    return rows.groupBy("path").agg(F.count("*").alias("row_count"), F.max(F.size("cells")).cast("long").alias("column_count"), F.count_distinct("sheet").alias("sheet_count"))


def row_hash(columns: list[str]) -> Column:
    """sha256 of the row as compact JSON with sorted keys, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def export_csv(df: DataFrame, path: str, parts: int | None = None) -> None:
    """A header in each file; parts=1 only for reports that are small by nature."""
    (df.coalesce(parts) if parts else df).write.option("header", True).option("emptyValue", '""').csv(path)
