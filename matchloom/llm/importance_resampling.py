"""Importance resampling: documents drawn by the ratio of two hashed n-gram models, by Gumbel top-k.

A word's and a word pair's hash (see shingles) falls in one of 2**BUCKET_BITS buckets. Counts of buckets, with `smoothing` added to
each, are the generative models of the target texts and of all raw texts; both count every document. A document's log weight is
the sum over its words and pairs of the log ratio of the models. Standard Gumbel noise from a hash of id and text is added,
and the `fraction` with the highest keys is drawn, which is sampling without replacement in proportion to the weights.

Counts leave a task as one vector of fixed size and are added up by bucket. The last key that is drawn is found exactly, by
histograms of at most CELLS cells, each within one cell of the last. Rows with exactly that key are all drawn, so copies of a row
stay together. Null and empty texts have weight 1 (log 0); ids may repeat or be null; a target without words
leaves every weight 1; extra columns are kept by `resampled`.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, slices, utf8
from .shingles import shingle_hashes, word_hashes

BUCKET_BITS = 14
CELLS = 4096
SMOOTHING = 1.0
FRACTION = 0.5
SEED = 11


def _features(column: pa.Array):
    """For row ranges: the first row, the bucket of each word and pair, and the row's number within the range."""
    data, offsets = utf8(column)
    shift = np.uint64(64 - BUCKET_BITS)
    for a, b in slices(offsets):
        words, _, _, first = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        rows = np.repeat(np.arange(b - a), np.diff(first))
        pairs = shingle_hashes(words, 2)
        inside = rows[1:] == rows[:-1]
        yield a, b, np.concatenate([words, pairs[inside] if len(pairs) else pairs]) >> shift, np.concatenate([rows, rows[1:][inside]])


def _counts(batches):
    """(bucket, n) for all texts of the task."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        for *_, buckets, _ in _features(batch.column(0)):
            total += np.bincount(buckets.astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])


def model(texts: DataFrame, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log probabilities of the buckets, from every row of a table with one text column."""
    counts = np.full(1 << BUCKET_BITS, smoothing)
    for row in texts.mapInArrow(_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] += row.n
    return np.log(counts / counts.sum())


def _weights(batches, ratio):
    table = ratio.value
    for batch in batches:
        out = np.zeros(batch.num_rows)
        size = np.zeros(batch.num_rows, np.int64)
        for a, b, buckets, rows in _features(batch.column(1)):
            out[a:b] = np.bincount(rows, table[buckets.astype(np.int64)], b - a)
            size[a:b] = np.bincount(rows, minlength=b - a)
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array(size), pa.array(out)], names=["doc_id", "text_hash", "n_features", "log_weight"])


def weighted(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash, n_features, log_weight, key for every document. targets: the target texts, in a column of the same name."""
    raw = docs.select(F.col(text_col).cast("string").alias("text"))
    target, all_texts = model(targets.select(F.col(text_col).cast("string").alias("text")), smoothing), model(raw, smoothing)
    known = target.max() > target.min()
    ratio = docs.sparkSession.sparkContext.broadcast(target - all_texts if known else np.zeros(len(target)))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    out = read.mapInArrow(partial(_weights, ratio=ratio), "doc_id long, text_hash long, n_features long, log_weight double")
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return out.withColumn("key", F.col("log_weight") - F.log(-F.log(unit)))


def nth_highest(keys: DataFrame, n: int) -> float:
    """The n-th highest value of the column key, exactly; keys is read once for each round, of six at most."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    above = 0
    while low < high:
        cell = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit((high - low) / CELLS)), F.lit(CELLS - 1))
        cells = keys.where(F.col("key").between(low, high)).groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for one in sorted(cells, key=lambda r: -r.cell):
            if above + one.n >= n:
                low, high = one.low, one.high
                break
            above += one.n
    return low


def drawn(docs: DataFrame, targets: DataFrame, fraction: float = FRACTION, id_col: str = "doc_id", text_col: str = "text", smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """The drawn documents: doc_id, text_hash, n_features, log_weight, key."""
    keys = Scratch(docs.sparkSession, "resampling").table(weighted(docs, targets, id_col, text_col, smoothing, seed), "keys")
    most = -(-keys.count() * fraction // 1)
    return keys.where(F.col("key") >= nth_highest(keys, int(most))) if most else keys.where("false")


def resampled(docs: DataFrame, targets: DataFrame, fraction: float = FRACTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn documents with all their columns."""
    own_id, own_hash = fresh(docs, "drawn_id"), fresh(docs, "drawn_hash")
    keep = drawn(docs, targets, fraction, id_col, text_col).select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).distinct()
    return docs.join(keep, F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(own_hash)), "left_semi")
