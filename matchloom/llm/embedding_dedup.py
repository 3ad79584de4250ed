"""Near duplicates among vectors: binary codes by iterative quantisation, several Hamming tables, exact cosine of what they find.

1. Equal vectors are one vector with a count. The rest works on distinct vectors; links to copies are counted by their numbers.
2. Codes. On a sample of the distinct vectors (`sample`, those of the least hashes, whatever the input's size) principal axes and rotations are learned: each
   rotation starts at random and is fitted in turn with the signs that it gives, so that the signs lose least (iterative quantisation). A bit
   is the side of the sample's median, so that codes are balanced. Of near duplicates in the sample only one counts: a third of all rows in one group would draw
   every median into it, and cut it in two in every bit. Several rotations give as many bits as the tables need.
3. Tables. The bits are cut into tables of b bits; vectors meet that have all bits of a table in common (a pair that differs in fewer bits than
   there are tables always meets). b is log2 of the number of distinct vectors, and `slack` more; the number of tables follows from the recall that is asked for
   at exactly the threshold, where one bit agrees with probability 1 - angle / pi. Every vector is in every table. Buckets of one vector go before any vector is shuffled.
4. Rerank. Within a bucket all pairs are compared by their cosine in double precision, in blocks of at most `block` vectors: a larger bucket becomes several blocks
   and each pair of blocks a group of its own, so no bucket is one task's and none is capped. A pair is counted in the first table in which it meets. A
   group returns a row for each vector: its number of links there, and the root of its links in the group; pairs are never rows.
5. The roots are the links of the components.

Many distinct vectors within the threshold of each other (g of them) cost g * g / block rows in each table where they share a bucket: the number of links of each asks for
all their cosines. Copies cost nothing.

Rows: a vector that is null, empty or zero, or has a null or a component that is not finite, links with nothing, not with its copies either. Vectors of different
lengths link with nothing of the other length. Rows of one id with one vector each count as another vector; rows of one id with other
vectors are separate. A null id is the largest, kept where its component has no other id. -0.0 equals 0.0. An empty table gives no rows; a column vec_id
or embedding may have another name; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from .common import Scratch
from .graph import components

COSINE, RECALL, SAMPLE, SLACK, BLOCK = 0.95, 0.95, 10_000, 4, 4096
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Shape:
    """Tables and the bits of each."""

    tables: int
    bits: int


def shape(n: int, cosine: float = COSINE, recall: float = RECALL, slack: int = SLACK) -> Shape:
    """So many tables that a pair at the threshold is in a bucket of one of them with the probability `recall`."""
    bits = max(1, math.ceil(math.log2(max(2, n)))) + slack
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return Shape(max(1, math.ceil(math.log(1 - recall) / math.log1p(-meet))), bits)


def _rotation(v: np.ndarray, rng: np.random.Generator, rounds: int) -> np.ndarray:
    """Iterative quantisation: signs for the rotation, then the rotation nearest to the signs, and again."""
    r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return r


def fit(sample: np.ndarray, bits: int, seed: int = 7, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, projection to so many bits (rotations side by side) and the bits' medians, of unit vectors."""
    rng, mean = np.random.default_rng(seed), sample.mean(0)
    centred = sample - mean
    axes = np.linalg.eigh(centred.T @ centred)[1]
    turns = [axes @ _rotation(centred @ axes, rng, rounds) for _ in range(math.ceil(bits / sample.shape[1]))]
    projection = np.hstack(turns)[:, :bits]
    return mean, projection, np.median(centred @ projection, axis=0)


def thinned(x: np.ndarray, cosine: float, rows_at_once: int = 1000) -> np.ndarray:
    """The vectors without those that are near an earlier one."""
    small, keep = x.astype(np.float32), np.ones(len(x), bool)
    for k in range(0, len(x), rows_at_once):
        near = small[k : k + rows_at_once] @ small[: k + rows_at_once].T >= cosine
        keep[k : k + rows_at_once] = ~np.tril(near, k - 1).any(1)
    return x[keep]


def _unit(rows: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors, for each length that the rows have."""
    sizes = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = flat[first[at][:, None] + np.arange(size)]
        x = x / np.abs(x).max(1, keepdims=True)  # neither tiny nor huge components leave the range of doubles when squared
        yield at, x / np.sqrt((x * x).sum(1, keepdims=True))


def table_keys(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray], form: Shape) -> np.ndarray:
    """For each vector and table a 64-bit key of the table's bits and its length."""
    mean, projection, middle = model
    on = ((x - mean) @ projection > middle).reshape(len(x), form.tables, form.bits)
    keys = np.full((len(x), form.tables), x.shape[1], np.uint64)
    for j in range(form.bits):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + on[:, :, j].astype(np.uint64) + np.uint64(1)
        keys ^= keys >> np.uint64(29)
    return (keys * np.uint64(0xBF58476D1CE4E5B9) ^ np.arange(form.tables, dtype=np.uint64)).view(np.int64)


def _coded(batches: Iterator[pa.RecordBatch], models: dict[int, tuple], form: Shape) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.zeros((len(batch), form.tables), np.int64)
        for at, x in _unit(batch.column("embedding")):
            size = x.shape[1]
            if size not in models:  # a length that the sample hasn't: the plain axes of random rotations
                models[size] = fit(np.vstack([np.eye(size), -np.eye(size)]), form.tables * form.bits)
            keys[at] = table_keys(x, models[size], form)
        lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, form.tables, dtype=np.int32), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "keys"])


def learned(kinds: DataFrame, form: Shape, sample: int = SAMPLE, cosine: float = COSINE) -> dict[int, tuple]:
    """A model for each length of vector in a sample of the distinct vectors: those of the least hashes, without near duplicates."""
    rows = kinds.select("embedding").orderBy(F.xxhash64("embedding")).limit(sample).toArrow().column("embedding").combine_chunks()
    rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
    return {x.shape[1]: fit(thinned(x, cosine), form.tables * form.bits) for _, x in _unit(rows)}


def _roots(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> None:
    """Joins the ends of the links a-b in root, where each place holds the least place known to be linked with it."""
    while True:
        x, y = root[a], root[b]
        low = np.minimum(x, y)
        if (x == y).all():
            return
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (root != root[root]).any():
            root[:] = root[root]


def _matrix(keys: pa.ChunkedArray) -> np.ndarray:
    return keys.combine_chunks().flatten().to_numpy().reshape(len(keys), -1)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    one = column.combine_chunks()
    return one.chunk(0) if isinstance(one, pa.ChunkedArray) else one


def _told(rows: pa.Table, at: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.Table:
    nodes = _whole(rows.column("node"))
    return pa.table({"node": nodes.take(pa.array(at)), "links": links, "root": nodes.take(pa.array(root))})


def _links(group: pa.Table, cosine: float, rows_at_once: int = 256) -> pa.Table:
    """One pair of blocks of a bucket: for each vector the copies that it links with, counted in the first table only, and its root in the group."""
    table, i = group.column("t")[0].as_py(), group.column("i")[0].as_py()
    same, place = i == group.column("j")[0].as_py(), np.arange(len(group))
    keys, copies, block = _matrix(group.column("keys")), group.column("copies").to_numpy(), group.column("b").to_numpy()
    found, root = np.zeros(len(group), np.int64), place.copy()
    for at, vectors in _unit(_whole(group.column("embedding"))):  # one length, unless keys of two collide
        row = np.zeros(len(group), np.int64)
        row[at] = np.arange(len(at))
        left, right = (at, at) if same else (at[block[at] == i], at[block[at] != i])
        for k in range(0, len(left), rows_at_once):
            a = left[k : k + rows_at_once]
            near = vectors[row[a]] @ vectors[row[right]].T >= cosine
            if same:
                near &= a[:, None] < right[None, :]
            if not near.any():
                continue
            for u in range(table):  # a pair that met in an earlier table is counted there
                near &= keys[a, u][:, None] != keys[right, u][None, :]
            x, y = np.nonzero(near)
            x, y = a[x], right[y]
            np.add.at(found, x, copies[y])
            np.add.at(found, y, copies[x])
            _roots(x, y, root)
    on = np.flatnonzero(found)
    return _told(group, on, found[on], root[on])


def _pairs(rows: pa.Table, first: np.ndarray, cosine: float) -> pa.Table:
    """As _links, for all buckets of two vectors at once, which most are: the vectors at the places `first` and behind them."""
    keys, copies, table = _matrix(rows.column("keys")), rows.column("copies").to_numpy(), rows.column("t").to_numpy()
    a, linked = first, np.zeros(len(first), bool)
    for at, vectors in _unit(_whole(rows.column("embedding"))):
        row = np.full(len(rows), -1)
        row[at] = np.arange(len(at))
        own = np.flatnonzero((row[a] >= 0) & (row[a + 1] >= 0))
        linked[own] = np.einsum("ij,ij->i", vectors[row[a[own]]], vectors[row[a[own] + 1]]) >= cosine
    a = a[linked]
    a = a[~((keys[a] == keys[a + 1]) & (np.arange(keys.shape[1]) < table[a][:, None])).any(1)]
    return _told(rows, np.concatenate([a, a + 1]), np.concatenate([copies[a + 1], copies[a]]), np.concatenate([a, a]))


GROUP = ["t", "key", "i", "j"]


def _buckets(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and pair of blocks, group by group; a task holds one group, of two blocks at most, and a batch."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        new = np.zeros(max(len(held) - 1, 0), bool)
        for c in GROUP:
            v = held.column(c).to_numpy()
            new |= v[1:] != v[:-1]
        starts = np.flatnonzero(new) + 1
        if len(starts):
            yield from _compared(held.slice(0, starts[-1]), np.concatenate([[0], starts[:-1]]), cosine)
            held = held.slice(starts[-1])
    if held is not None and len(held):
        yield from _compared(held, np.array([0]), cosine)


def _compared(rows: pa.Table, starts: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    sizes = np.diff(np.append(starts, len(rows)))
    two = (sizes == 2) & (rows.column("i").to_numpy()[starts] == rows.column("j").to_numpy()[starts])
    if two.any():
        yield from _pairs(rows, starts[two], cosine).to_batches()
    for start, size in zip(starts[~two].tolist(), sizes[~two].tolist(), strict=True):
        if size > 1:
            yield from _links(rows.slice(start, size), cosine).to_batches()


def valid(vector: str = "embedding"):
    return (
        F.coalesce(F.size(vector) > 0, F.lit(False))
        & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(vector, lambda v: v != 0)
    )


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, sample: int = SAMPLE, slack: int = SLACK, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id (the least id that can be reached) and kept, for each row."""
    scratch = Scratch(vectors.sparkSession, "embeddings")
    kind = vectors.schema[vector_col].dataType
    plain = F.col(vector_col) if isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType)) else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), plain.alias("embedding"))
    fit_rows = rows.where(valid())
    # a node is ordered by the least id of its copies, so that a component's root names the component without another join
    node = F.struct(F.coalesce(F.min("vec_id"), F.lit(NO_ID)).alias("id"), F.xxhash64("embedding").alias("tie"))
    kinds = scratch.table(fit_rows.groupBy("embedding").agg(node.alias("node"), F.count("*").alias("copies")), "kinds")
    form = shape(kinds.count(), cosine, recall, slack)
    node_type = kinds.schema["node"].dataType.simpleString()
    keys = scratch.table(kinds.select("node", "embedding").mapInArrow(partial(_coded, models=learned(kinds, form, sample, cosine), form=form), f"node {node_type}, keys array<long>"), "keys")
    entries = keys.select("node", F.posexplode("keys").alias("t", "key"))
    full = entries.groupBy("t", "key").agg(F.count("*").alias("size")).where("size > 1")
    # places in buckets of two or more, with the pairs of blocks that a vector's own block is part of
    many = F.ceil(F.col("size") / F.lit(block)).cast("int")
    places = entries.join(full, ["t", "key"]).withColumn("many", many).withColumn("b", F.pmod(F.xxhash64("node"), F.col("many")).cast("int"))
    paired = places.select("node", "t", "key", "b", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("o"))
    paired = paired.select("node", "t", "key", "b", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"))
    whole = paired.join(keys, "node").join(kinds, "node")
    sorted_ = whole.repartition(*GROUP).sortWithinPartitions(*GROUP)
    parts = scratch.table(sorted_.mapInArrow(partial(_buckets, cosine=cosine), f"node {node_type}, links long, root {node_type}"), "links")
    linked = parts.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    facts = kinds.join(linked, "node", "left").join(reach, "node", "left")
    facts = facts.select("embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node")["id"].alias("least"))
    found = rows.withColumn("sound", valid()).join(facts.withColumn("sound", F.lit(True)), ["embedding", "sound"], "left")
    least = F.when(F.col("least").isNull(), F.col("vec_id")).when(F.col("least") == NO_ID, None).otherwise(F.col("least"))
    out = found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), least.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("vec_id", id_col)
