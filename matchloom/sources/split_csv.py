"""CSV in any encoding that keeps ASCII bytes as they are, large files read by many tasks.

Spark's text reader cuts files into byte ranges at line feeds. Whether a line starts inside a quoted cell depends on all bytes before it, so it is found in two passes:

1. For each range the state at its end is worked out for both states at its start, outside and inside quotes (a line without a quote leaves the state as it is), with which of the
   encodings its bytes decode. The ranges of a file, a row each, are then chained from the first to the last, which gives each range its true state at the start.
2. Each range parses the records that lie in it. What stands before its first record and an open record at its end are pieces; the pieces of a record, one for each range that
   it reaches into, meet by the range where it starts and are parsed together.

Cells are as Python's csv reads them: quotes double within quotes, a quote inside an unquoted cell is a sign like others. Only line feeds (with or without a carriage return) end records.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "file string, block long"
#: Possessive throughout: a quote is what its place makes it. From outside quotes: whole cells, then one whose quotes don't end on the line. From inside: up to the end of the quotes first.
_CELL = rb'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|)'
_OPENS = re.compile(rb"(?:" + _CELL + rb',)*+"(?:[^"]|"")*+\Z')
_STAYS = re.compile(rb'(?:[^"]|"")*+\Z')
_CLOSES = re.compile(rb'(?:[^"]|"")*+"[^,]*+')


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line ends within quotes, given whether it starts within them."""
    if b'"' not in line:
        return inside
    if not inside:
        return _OPENS.match(line) is not None
    if _STAYS.match(line):
        return True
    rest = line[_CLOSES.match(line).end() :]
    return rest.startswith(b",") and _OPENS.match(rest[1:]) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (the first byte of the range) and line, in the files' order within each range."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _decodes(line: bytes, encoding: str) -> bool:
    try:
        line.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _transitions(batches: Iterator[pd.DataFrame], encodings: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """A row for each range: file, block, its end from outside and from inside, whether a record ends in it if it starts inside, and the encodings in which all its lines decode."""
    names = ["file", "block", "from_outside", "from_inside", "breaks", "fits"]
    key, state, breaks, fits = None, None, None, None
    for batch in batches:
        done = []
        for file, block, line in zip(batch.file, batch.block, batch.line, strict=True):
            if (file, block) != key:
                if key:
                    done.append((*key, *state, breaks, fits))
                key, state, breaks, fits = (file, block), [False, True], False, list(encodings)
            line = bytes(line)
            if b'"' in line:
                state = [ends_inside(line, s) for s in state]
            breaks = breaks or not state[1]
            if not line.isascii():
                fits = [e for e in fits if _decodes(line, e)]
        if done:
            yield pd.DataFrame(done, columns=names)
    if key:
        yield pd.DataFrame([(*key, *state, breaks, fits)], columns=names)


def _chained(ranges: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file in order: whether each starts inside quotes, and the range in which the record that is open there started."""
    inside, opened, out = False, None, []
    for r in ranges.sort_values("block").itertuples():
        out.append((r.file, r.block, inside, opened))
        after = r.from_inside if inside else r.from_outside
        if after and (not inside or r.breaks):
            opened = r.block
        inside = after
    return pd.DataFrame(out, columns=["file", "block", "inside", "origin"]).astype({"origin": "Int64"})


def _cells(record: bytes, encoding: str, first: bool) -> list[str] | None:
    """The cells of one record, None for a blank line. A byte order mark counts at a file's start only."""
    plain = {"utf-8-sig": "utf-8"}.get(encoding.lower(), encoding)
    text = record.decode(encoding if first else plain)
    return next(csv.reader(io.StringIO(text, newline="")), None) or None


PIECE = "file string, origin long, block long, place long, cells array<string>, piece binary, ends boolean"


def _records(batches: Iterator[pd.DataFrame], encoding: str) -> Iterator[pd.DataFrame]:
    """Rows with cells: the records that lie in one range. Rows with a piece: what stands in a range of a record that reaches over its ends; ends says that it is the last one."""
    names = [c.split()[0] for c in PIECE.split(", ")]
    key, inside, origin, held, place = None, False, None, [], 0

    def left():  # the range is over with a record open
        return [(key[0], origin, key[1], place, None, b"\n".join(held), False)] if held else []

    for batch in batches:
        out = []
        for file, block, line, starts_inside, started in zip(batch.file, batch.block, batch.line, batch.inside, batch.origin, strict=True):
            if (file, block) != key:
                out += left()
                key, inside, held, place = (file, block), bool(starts_inside), [], 0
                origin = int(started) if inside else block
                carried = inside
            line = bytes(line)
            held.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                record = b"\n".join(held)
                if carried:
                    out.append((file, origin, block, place, None, record, True))
                else:
                    cells = _cells(record, encoding, block == 0 and place == 0)
                    if cells:
                        out.append((file, block, block, place, cells, None, True))
                held, carried, origin, place = [], False, block, place + 1
        if out:
            yield pd.DataFrame(out, columns=names)
    if out := left():
        yield pd.DataFrame(out, columns=names)


def _stitched(pieces: pd.DataFrame, encoding: str) -> pd.DataFrame:
    """One record from its pieces in order."""
    own = pieces.sort_values("block")
    first = own.iloc[0]
    cells = _cells(b"\n".join(bytes(x) for x in own.piece), encoding, first.block == 0 and first.place == 0)
    rows = [(first.file, first.block, first.place, cells)] if cells else []
    return pd.DataFrame(rows, columns=["file", "block", "place", "cells"])


def csv_records(spark: SparkSession, path: str, encodings: tuple[str, ...]) -> tuple[DataFrame, str]:
    """(file, block, place, cells) of every record that isn't a blank line, by the first encoding in which all files decode, with its name. block and place give the order in a file.

    A file whose last quotes don't end gives what stands there as its last record. Each
    range is read for its states, once to choose the encoding and once with the rest of the plan, and then for its records."""
    lines = _lines(spark, path)
    found = lines.mapInPandas(partial(_transitions, encodings=encodings), f"{KEY}, from_outside boolean, from_inside boolean, breaks boolean, fits array<string>")
    ranges = found.cache()  # a row for each range
    try:
        encoding = next((e for e in encodings if ranges.where(~F.array_contains("fits", e)).isEmpty()), None)
        if encoding is None:
            raise ValueError(f"no encoding of {', '.join(encodings)} fits all files of {path}")
    finally:
        ranges.unpersist()
    states = found.groupBy("file").applyInPandas(_chained, f"{KEY}, inside boolean, origin long")
    return _parsed(lines, states, encoding), encoding


def _parsed(lines: DataFrame, states: DataFrame, encoding: str) -> DataFrame:
    parts = lines.join(F.broadcast(states), ["file", "block"]).mapInPandas(partial(_records, encoding=encoding), PIECE)
    whole = parts.where("cells is not null").select("file", "block", "place", "cells")
    pieces = parts.where("piece is not null").groupBy("file", "origin").applyInPandas(lambda x: _stitched(x, encoding), "file string, block long, place long, cells array<string>")
    return whole.union(pieces)


def read_csv_split(spark: SparkSession, path: str, encodings: tuple[str, ...], with_place: bool = False) -> tuple[DataFrame, str]:
    """All-string columns of the files and the encoding used. All must have the same header. An empty cell is '', a missing one null; rows of blank cells alone are dropped.

    with_place adds _file, _block and _place, whose order is the files'."""
    records, encoding = csv_records(spark, path, encodings)
    heads = records.where("block = 0 and place = 0").select("cells").distinct().limit(2).collect()
    if len(heads) != 1:
        raise ValueError(f"the files of {path} have {'no header' if not heads else 'several headers'}")
    names = [c.strip() for c in heads[0].cells]
    order = [F.col(c).alias(f"_{c}") for c in ("file", "block", "place")] if with_place else []
    named = records.where("not (block = 0 and place = 0)").select(*(F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(names)), *order)
    return named.where(F.trim(F.concat_ws("", *(f"`{c}`" for c in names))) != ""), encoding
