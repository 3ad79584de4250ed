"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A text's lines are hashed; after a line, a rolling hash over it and the WINDOW - 1 lines before decides whether a chunk ends
(one time in DIVISOR), so an inserted line moves no boundary further on. Chunks of at least two lines that are not blank are
grouped over all documents by hash and bytes. Of equal chunks that of the least doc_id and then the least line stays, all
others are removed, in the same document too; the rest of a text keeps its order. Two different chunks that share a 64-bit hash are told apart by
the SHA-256 of their bytes, which travels with the hash.

The texts of chunks are shuffled once, combined before the shuffle, so that a chunk in a third of all documents is one row per
task; after it only hashes and line numbers travel. Ties (rows of one doc_id with the same chunk at the same line) all stay.
A null id counts as the largest. A null text stays null and has no lines, an empty one has one; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

WINDOW = 2
DIVISOR = 3


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def with_chunks(df: DataFrame, text: str) -> DataFrame:
    """Adds the columns _lines and _bounds: the text's lines, and the line numbers where its chunks start, with their number at the end."""
    df = df.withColumn("_lines", F.split(F.col(text), "\n", -1))
    df = df.withColumn("_hashes", F.transform("_lines", line_hash))

    def rolling(i: Column) -> Column:
        return sum(F.when(i >= j, F.get(F.col("_hashes"), (i - j).cast("int"))).otherwise(0) * (31**j) for j in range(WINDOW))

    inner = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: (rolling(i) % DIVISOR == 0) & (i < F.size("_lines") - 1))
    ends = F.transform(inner, lambda i: i + 1)
    return df.withColumn("_bounds", F.concat(F.array(F.lit(0)), ends, F.array(F.size("_lines")))).drop("_hashes")


def _removals(docs: DataFrame) -> DataFrame:
    """(_id, _hash, _gone, _cut): for a document, the line numbers that go and the number of its chunks that go. docs: _id, _hash, _text."""
    cut = with_chunks(docs.where("_text is not null"), "_text")
    span = F.transform(
        F.sequence(F.lit(0), F.size("_bounds") - 2),
        lambda k: F.struct(F.get("_bounds", k).alias("start"), (F.get("_bounds", k + 1) - F.get("_bounds", k)).alias("size")),
    )
    span = F.filter(span, lambda s: s.size >= 2)
    each = cut.select("_id", "_hash", "_lines", F.explode(span).alias("s")).select("_id", "_hash", F.slice("_lines", F.col("s.start") + 1, F.col("s.size")).alias("part"), "s.start", "s.size")
    each = each.where(F.size(F.filter("part", lambda x: F.trim(x) != "")) >= 2).withColumn("chunk", F.array_join("part", "\n"))
    place = F.coalesce(F.col("_id").cast("decimal(38,0)"), F.lit("9223372036854775808").cast("decimal(38,0)")) * F.lit(2**32).cast("decimal(10,0)") + F.col("start")
    each = each.select("_id", "_hash", "start", "size", F.xxhash64("chunk").alias("h"), place.cast("decimal(38,0)").alias("place"), "chunk")
    each = each.withColumn("digest", F.unhex(F.sha2(F.encode("chunk", "UTF-8"), 256)))
    same_bytes = each.groupBy("h", "chunk").agg(F.count("*").alias("n"), F.min("place").alias("first"), F.min("digest").alias("digest"))
    repeated = same_bytes.where("n > 1").select("h", "digest", "first")
    gone = each.drop("chunk").join(repeated, ["h", "digest"]).where("place > first")
    return gone.groupBy("_id", "_hash").agg(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1))).alias("_gone"), F.count_distinct("start").alias("_cut"))


def without_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: bool = False) -> DataFrame:
    """The documents with all their columns and the text without repeated chunks; report adds n_lines, removed_lines and removed_chunks."""
    own_id, own_hash = fresh(docs, "own_id"), fresh(docs, "own_hash")
    keyed = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_hash, F.xxhash64(F.col(text_col).cast("string")))
    gone = _removals(keyed.select(F.col(own_id).alias("_id"), F.col(own_hash).alias("_hash"), F.col(text_col).cast("string").alias("_text")))
    names = {c: fresh(docs, c) for c in ("gone_id", "gone_hash", "gone_lines", "gone_chunks")}
    gone = gone.toDF(*names.values())
    both = keyed.join(gone, F.col(own_id).eqNullSafe(F.col(names["gone_id"])) & (F.col(own_hash) == F.col(names["gone_hash"])), "left")
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(names["gone_lines"]))
    text = F.when(F.col(names["gone_lines"]).isNull(), F.col(text_col).cast("string")).otherwise(F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n"))
    columns = [text.alias(c) if c.lower() == text_col.lower() else F.col(c) for c in docs.columns]
    if report:
        columns += [F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"), F.coalesce(F.size(names["gone_lines"]), F.lit(0)).cast("long").alias("removed_lines"), F.coalesce(names["gone_chunks"], F.lit(0)).cast("long").alias("removed_chunks")]
    return both.select(*columns)
