"""N-gram Jaccard join with set-relation skipping.

Exact: two documents link when 100 * |intersection| >= percent * |union| of their distinct word n-gram sets. Steps:

1. One pass over all texts yields each document's set size and a 128-bit key of its set, and a count sketch of fixed size
   (2**SKETCH_BITS cells) of all shingles. The sketch only orders shingles, rarer cells first, so any count is correct.
2. A second pass posts each set's prefix: in that order, sets that link share one of their first n - ceil(p n) + 1 shingles.
3. Index lists, one per shingle, are read as a stream, sorted by position. Lists of up to SHORT sets yield candidate pairs: sets of a size class
   stand in blocks by position, and two blocks are skipped whole if even their least positions leave too little in common.
   Of longer lists the first HUBS sets are hubs, and each other set is paired with the hubs that the bound allows.
4. A third pass brings the texts of candidates only, once for each set, which travel smaller than their sets; the join is a merge join at any
   size, so that what is shuffled follows the input. Pairs are verified hub by hub, in units of bounded size. Links so far give components.
   A long list whose sets are all in one component is done: that is what near copies of one text come to, in work that grows with their number.
   The sets of the other long lists make clusters, cut into size classes and blocks of bounded size; blocks that hold sets of one
   component only don't meet each other. A task holds two blocks and derives a set's overlaps with all others from those of a highly
   similar set: it adds the index lists of the shingles that it has and the other hasn't, and takes off those it lacks.
   Only links that join two groups of a task are returned, so the rows out grow with the sets, not with their pairs.
5. Components by alternating stars; copies (equal sets) meet again by key.

Nothing is capped: a long list or a large cluster makes more tasks of the same size. Nulls and texts without words have an
empty set and link with nothing; repeated rows have equal keys; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, exact_binary, fresh, slices, utf8
from .graph import components
from .shingles import shingle_sets

SKETCH_BITS = 20
SKETCH_PARTS = 64
SHORT, SKIP, HUBS, PART = 48, 16, 4, 256
BLOCK_SETS = 512
BLOCK_SHINGLES = 1_000_000
BITMAP_BITS = 24
SALTS = 16
SLICE = 1_000_000  # bytes of texts that are hashed at once


def _key(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def _sizes(batches, n: int):
    """Rows (doc_id, text_hash, n_shingles, key), and at the end of a task the pieces of its sketch as rows with a part."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    shift = np.uint64(64 - SKETCH_BITS)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("part", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in slices(offsets, SLICE):
            sizes, keys, held = [], [], []
            for one in shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n):
                sizes.append(len(one))
                keys.append(_key(one))
                held.append(one)
            counts += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=len(counts))
            rows = b - a
            yield pa.record_batch([batch.column(0).slice(a, rows), batch.column(2).slice(a, rows), pa.array(sizes, pa.int64()), exact_binary(keys), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], schema=schema)
    if counts.any():
        pieces = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SKETCH_PARTS)]
        none = pa.nulls(SKETCH_PARTS, pa.int64())
        yield pa.record_batch([none, none, none, pa.nulls(SKETCH_PARTS, pa.binary()), pa.array(range(SKETCH_PARTS), pa.int32()), exact_binary(pieces)], schema=schema)


def _add_up(batches):
    """Adds the pieces of the sketch that this task holds, one row out for each part."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one = np.frombuffer(zlib.decompress(piece), np.int64)
            total[part] = total[part] + one if part in total else one
    yield pa.record_batch([pa.array(list(total), pa.int32()), exact_binary([zlib.compress(x.tobytes(), 1) for x in total.values()])], names=["part", "counts"])


def _sketch(pieces: DataFrame) -> np.ndarray:
    """The whole sketch: its size is fixed, whatever the input. Pieces of a part are first added within tasks, then across them."""
    schema = "part int, counts binary"
    summed = pieces.mapInArrow(_add_up, schema).repartition(SKETCH_PARTS, "part").mapInArrow(_add_up, schema)
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for row in summed.collect():
        out[row.part] = np.frombuffer(zlib.decompress(bytes(row.counts)), np.int64)
    return out.ravel()


def _prefix(one: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, rarer cells first, ties by hash: any set that links with it shares one of its own first."""
    size = len(one)
    keep = size - -(-percent * size // 100) + 1
    by = rank[(one >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    if keep * 4 < size:
        least = np.partition(by, keep - 1)[keep - 1]
        at = np.flatnonzero(by <= least)
        return one[at[np.argsort(by[at], kind="stable")[:keep]]]
    return one[np.argsort(by, kind="stable")[:keep]]


def _postings(batches, n: int, percent: int, sketch):
    rank = np.minimum(sketch.value, np.iinfo(np.int32).max).astype(np.int32)
    seen: set[bytes] = set()
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for a, b in slices(offsets, SLICE):
            tokens, keys, sizes, lengths = [], [], [], []
            for one in shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n):
                if not len(one) or (key := _key(one)) in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(key)
                first = _prefix(one, rank, percent)
                tokens.append(first)
                keys.append(key)
                sizes.append(len(one))
                lengths.append(len(first))
            if tokens:
                count = np.array(lengths)
                at = np.repeat(np.arange(len(keys)), count)
                position = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                yield pa.record_batch([pa.array(np.concatenate(tokens).view(np.int64)), exact_binary(keys).take(pa.array(at)), pa.array(np.array(sizes, np.int32)[at]), pa.array(position.astype(np.int32))], names=["token", "key", "size", "position"])


def _enough(overlap, n, m, percent: int):
    """Whether sets of n and m shingles can link with at most this overlap."""
    return 100 * overlap >= percent * (n + m - overlap)


def _list_pairs(keys: list, sizes: np.ndarray, positions: np.ndarray, percent: int, counts: list | None = None):
    """Pairs of one index list that may link. counts: [pairs of sets in the list, those that were skipped with their blocks] is added to.

    Shared shingles from two sets' positions on are at most as many as either has left. Blocks of SKIP sets hold one size class in the order of
    positions, so their first position and their sizes bound all that stand in them."""
    kind = np.floor(np.log(sizes) / np.log(100 / (percent - 1))).astype(np.int64)
    order = np.lexsort((positions, kind))
    n, left = sizes[order], (sizes - positions)[order]
    cut = np.r_[0, np.flatnonzero(np.diff(kind[order])) + 1, len(order)]
    begin = np.concatenate([np.arange(x, y, SKIP) for x, y in zip(cut[:-1], cut[1:], strict=True)])
    end = np.r_[begin[1:], len(order)]
    low, most = np.minimum.reduceat(n, begin), np.maximum.reduceat(left, begin)
    for x in range(len(begin)):
        for y in np.flatnonzero(_enough(np.minimum(most[x], most[x:]), low[x], low[x:], percent)) + x:
            a, b = slice(begin[x], end[x]), slice(begin[y], end[y])
            ok = _enough(np.minimum(left[a][:, None], left[b][None, :]), n[a][:, None], n[b][None, :], percent)
            if counts is not None:
                counts[1] -= (end[x] - begin[x]) * (end[y] - begin[y]) if x != y else (end[x] - begin[x]) * (end[x] - begin[x] - 1) // 2
            for i, j in zip(*np.nonzero(np.triu(ok, 1) if x == y else ok), strict=True):
                p, q = keys[order[begin[x] + i]], keys[order[begin[y] + j]]
                if p != q:
                    yield (p, q) if p < q else (q, p)
    if counts is not None:
        total = len(order) * (len(order) - 1) // 2
        counts[0] += total
        counts[1] += total


PAIR, HUB, LIST = 0, 1, 2


def _candidates(batches, percent: int):
    """From postings sorted by (token, position): (a, b, PAIR, 0) of short lists; of long ones (hub, member, HUB, part) and (first, member, LIST, 0)."""
    seen: set[tuple] = set()
    out: list[tuple] = []
    token, keys, sizes, positions, member = None, [], [], [], 0

    def flush():
        if 1 < len(keys) and not member:
            for pair in _list_pairs(keys, np.array(sizes, np.int64), np.array(positions, np.int64), percent):
                put(*pair, PAIR, 0)

    def put(a, b, kind, part):
        if (a, b, kind) not in seen:
            if len(seen) >= 200_000:
                seen.clear()
            seen.add((a, b, kind))
            out.append((a, b, kind, part))

    def put_member(key, size, position):
        put(keys[0], key, LIST, 0)
        for hub, n, at in zip(keys[:HUBS], sizes, positions, strict=False):
            if hub != key and _enough(min(n - at, size - position), n, size, percent):
                put(hub, key, HUB, member // PART)

    def rows():
        batch = pa.record_batch([exact_binary([x[0] for x in out]), exact_binary([x[1] for x in out]), pa.array([x[2] for x in out], pa.int32()), pa.array([x[3] for x in out], pa.int32())], names=["a", "b", "kind", "part"])
        out.clear()
        return batch

    for batch in batches:
        tokens = batch.column(0).to_numpy()
        same = np.flatnonzero(tokens[1:] == tokens[:-1])
        last = len(tokens) - 1
        wanted = np.zeros(len(tokens), bool)
        wanted[same] = wanted[same + 1] = True
        wanted[[0, last]] = True  # these may go on in other batches
        at = np.flatnonzero(wanted)
        part = batch.take(pa.array(at))
        for t, key, size, position in zip(tokens[at].tolist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
            if t != token:
                flush()
                token, keys, sizes, positions, member = t, [], [], [], 0
            if member:
                member += 1
                put_member(key, size, position)
            elif key not in keys:
                keys.append(key)
                sizes.append(size)
                positions.append(position)
                if len(keys) > SHORT:
                    for member, one in enumerate(zip(keys[1:], sizes[1:], positions[1:], strict=True), 1):
                        put_member(*one)
                    del keys[HUBS:], sizes[HUBS:], positions[HUBS:]
            if len(out) >= 50_000:
                yield rows()
        if out:
            yield rows()
    flush()
    if out:
        yield rows()


def _marks(key: bytes) -> int:
    return int.from_bytes(key[:8], "little") >> (64 - BITMAP_BITS)


def _marked(batches):
    """The cells of the fixed-size bitmap that this task's keys fall in, as (word, bits)."""
    cells = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for batch in batches:
        for key in batch.column(0).to_pylist():
            at = _marks(key)
            cells[at >> 3] |= 1 << (at & 7)
    words = cells.view(np.int64)
    at = np.flatnonzero(words)
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(words[at])], names=["word", "bits"])


def _wanted_texts(batches, n: int, bitmap):
    cells, seen = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little"), set()
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for a, b in slices(offsets, SLICE):
            keys, rows = [], []
            for row, one in enumerate(shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n), a):
                if len(one) and cells[_marks(key := _key(one))] and key not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    rows.append(row)
            if keys:
                yield pa.record_batch([exact_binary(keys), batch.column(0).take(pa.array(rows))], names=["key", "text"])


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of several ranges, one after another."""
    count = ends - starts
    return np.repeat(starts - np.cumsum(count) + count, count) + np.arange(count.sum())


class _Groups:
    """Union by smaller number."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def block_links(sets: list[np.ndarray], percent: int):
    """Links (i, j) that join groups of these sets. A set's overlaps with all are derived from those of the last set if that is similar."""
    size = np.array([len(x) for x in sets])
    tokens, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(ids, kind="stable")
    lists = owner[order]
    ends = np.searchsorted(ids[order], np.arange(len(tokens)), side="right")
    starts = np.r_[0, ends[:-1]]
    own = np.split(ids, np.cumsum(size)[:-1])
    groups = _Groups(len(sets))

    def tally(which):
        return np.bincount(lists[_ranges(starts[which], ends[which])], minlength=len(sets))

    overlaps, before = None, None
    mark = np.zeros(len(tokens), bool)
    for i, mine in enumerate(own):
        if before is not None and 2 * overlaps[i] > len(mine):
            mark[own[before]] = True
            plus = mine[~mark[mine]]
            mark[own[before]] = False
            mark[mine] = True
            minus = own[before][~mark[own[before]]]
            mark[mine] = False
            overlaps = overlaps + tally(plus) - tally(minus)
        else:
            overlaps = tally(mine)
        before = i
        for j in np.flatnonzero(100 * overlaps >= percent * (size + len(mine) - overlaps)).tolist():
            if groups.join(i, j):
                yield i, j


def _unit_links(batches, n: int, percent: int):
    """From (unit, role, key, text) sorted by unit and role, a unit's links. Role 0 holds every role 1 against itself; roles 2 form a block."""
    unit, hub, keys, sets = None, None, [], []
    out: list[tuple] = []

    def flush():
        if len(keys) > 1:
            for i, j in block_links(sets, percent):
                if keys[i] != keys[j]:
                    out.append((keys[i], keys[j]))

    for batch in batches:
        data, offsets = utf8(batch.column(3))
        made = (one for a, b in slices(offsets, SLICE) for one in shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n))
        for u, role, key, one in zip(*(batch.column(k).to_pylist() for k in range(3)), made, strict=True):
            if u != unit:
                flush()
                unit, hub, keys, sets = u, [], [], []
            if role == 0:
                hub.append((key, one))
            elif role == 1:
                for other, its in hub:
                    at = np.searchsorted(its, one)
                    overlap = int((its[np.minimum(at, len(its) - 1)] == one).sum())
                    if key != other and 100 * overlap >= percent * (len(its) + len(one) - overlap):
                        out.append((other, key))
            elif key not in keys[-1:]:
                keys.append(key)
                sets.append(one)
        if out:
            yield pa.record_batch([exact_binary([x[0] for x in out]), exact_binary([x[1] for x in out])], names=["a", "b"])
            out.clear()
    flush()
    if out:
        yield pa.record_batch([exact_binary([x[0] for x in out]), exact_binary([x[1] for x in out])], names=["a", "b"])


def _cluster_units(clusters: DataFrame, percent: int) -> DataFrame:
    """(unit, role, key): sets of a cluster by size class and block. clusters: key, cluster, component, size.

    Sets that link are at most one class apart. A component that fills a block of a class has blocks of its own, which meet neither each other nor themselves: they
    are linked already. All other sets share mixed blocks."""
    width = float(np.log(100 / (percent - 1)))
    own = clusters.withColumn("class", F.floor(F.log("size") / F.lit(width)))
    large = own.groupBy("cluster", "class", "component").agg(F.count("*").alias("n")).where(F.col("n") >= BLOCK_SETS).select("cluster", "class", "component", F.col("component").alias("pure"))
    own = own.join(large, ["cluster", "class", "component"], "left").withColumn("pure", F.coalesce("pure", F.lit(b"")))
    many = own.groupBy("cluster", "class", "pure").agg(F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("size") / F.lit(BLOCK_SHINGLES))).cast("long").alias("blocks"))
    other = many.toDF("cluster", "class2", "pure2", "blocks2")
    near = many.join(other, "cluster").where("abs(class - class2) <= 1 and (pure != pure2 or pure = X'')")
    own = own.join(near.select("cluster", "class", "pure", "blocks", "class2", "pure2", "blocks2"), ["cluster", "class", "pure"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    mine = F.struct(F.col("class").alias("c"), F.col("pure").alias("p"), F.col("block").alias("b"))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks2") - 1), lambda j: F.struct(F.col("class2").alias("c"), F.col("pure2").alias("p"), j.alias("b")))
    unit = F.transform(every, lambda x: F.xxhash64("cluster", F.least(mine, x), F.greatest(mine, x)))
    return own.select(F.explode(unit).alias("unit"), F.lit(2).alias("role"), "key").distinct()


def _verified(units: DataFrame, text: DataFrame, n: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Links (a, b) among the units' sets, whose texts come from one more pass over all; each set's text once."""
    spark = units.sparkSession
    units = scratch.table(units, f"{name}-units")
    cells = np.zeros((1 << BITMAP_BITS) // 64, np.int64)
    for row in units.select("key").mapInArrow(_marked, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        cells[row.word] = row.bits
    bitmap = spark.sparkContext.broadcast(cells.tobytes())
    texts = text.mapInArrow(partial(_wanted_texts, n=n, bitmap=bitmap), "key binary, text string").groupBy("key").agg(F.first("text").alias("text"))
    ready = units.join(texts.hint("merge"), "key").select("unit", "role", "key", "text").repartition("unit").sortWithinPartitions("unit", "role", "key")
    return scratch.table(ready.mapInArrow(partial(_unit_links, n=n, percent=percent), "a binary, b binary"), name)


def _whole(roots: DataFrame) -> DataFrame:
    """(key, component) of all that are linked, the roots too."""
    return roots.select(F.col("node").alias("key"), F.col("root").alias("component")).union(roots.select("root", "root").distinct())


def linked_documents(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash (of the text as it is), n_shingles, key (of the set), root (least key of its component)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    text = docs.select(F.col(text_col).cast("string").alias("text"))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = scratch.table(
        read.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(partial(_sizes, n=n), "doc_id long, text_hash long, n_shingles long, key binary, part int, counts binary"),
        "sizes",
    )
    sketch = spark.sparkContext.broadcast(_sketch(first.where("part is not null").select("part", "counts")))
    members = first.where("part is null").select("doc_id", "text_hash", "n_shingles", "key")
    lists = text.mapInArrow(partial(_postings, n=n, percent=percent, sketch=sketch), "token long, key binary, size int, position int")
    schema = "a binary, b binary, kind int, part int"
    found = scratch.table(lists.repartition("token").sortWithinPartitions("token", "position", "key").mapInArrow(partial(_candidates, percent=percent), schema), "candidates")
    pairs = found.where(F.col("kind") != LIST).groupBy("a", "b").agg(F.min("part").alias("part"))
    hub = F.xxhash64("a", "part")
    starred = pairs.select(hub.alias("unit"), F.lit(1).alias("role"), F.col("b").alias("key")).union(pairs.select(hub, F.lit(0), "a").distinct())
    links = _verified(starred, text, n, percent, scratch, "links")
    held = _whole(components(links, scratch, "stars"))
    # long lists whose sets aren't all linked yet
    lists = found.where(F.col("kind") == LIST).select("a", "b").distinct()
    of = lambda side, name: held.select(F.col("key").alias(side), F.col("component").alias(name)).hint("merge")  # noqa: E731 - the same plan at any size
    lists = lists.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    left = lists.groupBy("a").agg(F.bool_or(F.col("ca") != F.col("cb")).alias("several")).where("several").select("a")
    left = scratch.table(lists.join(left.hint("merge"), "a", "left_semi"), "lists")
    if not left.isEmpty():
        clusters = _whole(components(left.select("a", "b"), scratch, "clusters")).withColumnRenamed("component", "cluster")
        ends = left.select(F.col("a").alias("key"), F.col("ca").alias("component")).union(left.select("b", "cb")).groupBy("key").agg(F.min("component").alias("component"))
        sizes = members.where("n_shingles > 0").groupBy("key").agg(F.min("n_shingles").alias("size"))
        more = _verified(_cluster_units(clusters.join(ends, "key").join(sizes, "key"), percent), text, n, percent, scratch, "more")
        held = _whole(components(links.union(more), scratch, "groups"))
    return scratch.table(members.join(held.withColumnRenamed("component", "root").hint("merge"), "key", "left").withColumn("root", F.coalesce("root", "key")), "linked")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links reach (its own where the set is empty)."""
    rows = linked_documents(docs, n, percent, id_col, text_col)
    full = rows.where("n_shingles > 0")
    # one row for each set before sets of a root meet, and roots in SALTS copies, so that a large component is no single key
    sets = full.groupBy("key", "root").agg(F.min("doc_id").alias("least"))
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    several = least.where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select("root", "salt", "component_id")
    named = sets.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(several, ["root", "salt"], "left").select("key", F.coalesce("component_id", "least").alias("component_id"))
    out = full.join(named, "key").select("doc_id", "n_shingles", "component_id")
    return out.union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the rows' first by (id, text hash) stays, whole; rows without words all stay. A null id counts as the largest.

    Rows with words that are equal in id and text are one document repeated: the least of them by its other columns stays, if the document does."""
    rows = linked_documents(docs, n, percent, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    keep = rows.where("n_shingles > 0").groupBy("root").agg(F.min(order).alias("o")).select("o.doc_id", "o.text_hash")
    # one shuffle of the texts, with repeated rows combined before it: they are grouped by the very columns that the join asks for
    by = late, number, mine = [fresh(docs, c) for c in ("own_late", "own_number", "own_hash")]
    keep = keep.select(F.col("doc_id").isNull().alias(late), F.coalesce("doc_id", F.lit(0)).alias(number), F.col("text_hash").alias(mine))
    text, own_id = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    empty = ~F.coalesce(text, F.lit("")).rlike(r"[^ \t\n\x0b\f\r]")
    own = docs.where(~empty).withColumns({late: own_id.isNull(), number: F.coalesce(own_id, F.lit(0)), mine: F.xxhash64(text)})
    kept = own.groupBy(*by).agg(F.min(F.struct(*docs.columns)).alias(row := fresh(docs, "own_row"))).join(keep, by, "left_semi").select(f"{row}.*")
    return kept.unionByName(docs.where(empty))
