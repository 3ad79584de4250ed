"""Benchmark decontamination by greedy string tiling.

Words (see shingles) of every document are held against those of every benchmark item. A Karp-Rabin hash of each `least`
words in a row finds shared seeds; seeds on one diagonal make maximal matches; the longest match whose words are free on
both sides is marked as a tile, again and again, until none of `least` words is left (ties: the earlier place in the item,
then in the document). A tile's words are compared byte for byte, and a match is split where they differ. Coverage is the share of the item's words under tiles, so
a passage counts in whatever order its parts come. Items of fewer words than `least` count as one seed of their own length.

Seeds are held as postings, those of the text by place and those of the item by hash, and are paired for one text and item at a time, in ranges of
diagonals of about PAIRS pairs; a pair of texts is looked into only if its seeds could cover enough of the item. So memory follows the text and the item,
not the number of equal places: a text of one word over and over costs time, not memory.

The benchmark is gathered in blocks of a fixed number of bytes and each block meets all documents in one pass without a
shuffle; a larger benchmark makes more blocks. Nulls and empty texts match nothing, nor do items without words; repeated
rows give repeated results; extra columns are kept by `clean_documents` and not read by `leaks`.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8
from .shingles import LOWER, shingle_hashes, word_hashes

LEAST_WORDS = 5
COVERAGE_PERCENT = 50
BLOCK_BYTES = 32_000_000
FILTER_BITS = 22
PAIRS = 1_000_000


class Items:
    """One block of the benchmark: ids, words, numbers of words, and seeds by their length."""

    def __init__(self, ids: list, texts: list, least: int):
        self.ids, self.words, seeds = ids, [], {}
        column = pa.array([x or "" for x in texts], pa.string())
        data, offsets = utf8(column)
        hashes, starts, ends, first = word_hashes(data, offsets)
        raw = LOWER[data].tobytes()
        for item in range(len(ids)):
            a, b = int(first[item]), int(first[item + 1])
            self.words.append([raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])
            if b > a:
                length = min(least, b - a)
                found = shingle_hashes(hashes[a:b], length)
                seeds.setdefault(length, []).append((found, np.full(len(found), item), np.arange(len(found))))
        self.sizes = np.array([len(w) for w in self.words])
        self.seeds = {length: Seeds(*(np.concatenate(x) for x in zip(*parts, strict=True))) for length, parts in seeds.items()}


class Seeds:
    """Postings of seeds of one length: distinct hashes, for each the items that have it with their number of places, and each item's places by hash."""

    def __init__(self, found: np.ndarray, item: np.ndarray, place: np.ndarray):
        order = np.lexsort((place, item, found))
        found, item = found[order], item[order]
        new = np.r_[True, (found[1:] != found[:-1]) | (item[1:] != item[:-1])]
        at = np.flatnonzero(new)
        self.items, self.counts = item[at], np.diff(np.r_[at, len(found)])
        self.hashes, first = np.unique(found[at], return_index=True)
        self.begin = np.r_[first, len(at)]
        cells = np.zeros(1 << FILTER_BITS, bool)
        cells[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.cells = np.packbits(cells, bitorder="little")
        # by item: its hashes' numbers, where the places of each begin, the places
        number = np.searchsorted(self.hashes, found)
        by_item = np.lexsort((place[order], number, item))
        self.by_item, self.number, self.place = item[by_item], number[by_item], place[order][by_item]

    def of(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """The item's seeds as (number of the hash, place), sorted."""
        a, b = np.searchsorted(self.by_item, [item, item + 1])
        return self.number[a:b], self.place[a:b]


def _runs(at: np.ndarray, number: np.ndarray, of_item: tuple[np.ndarray, np.ndarray]):
    """Maximal runs of seeds on one diagonal, as arrays (doc word, item word, seeds): at and number are the text's seeds by place."""
    numbers, places = of_item
    first, last = np.searchsorted(numbers, number), np.searchsorted(numbers, number, side="right")
    has = last > first
    at, first = at[has], first[has]
    if not len(at):
        return
    low, high = int(at[0] - places.max()), int(at[-1] - places.min()) + 1
    ranges = [(low, high)]
    # places are sorted within a hash, so those of a range of diagonals are a slice of each seed's places
    wide = int(places.max()) + 2
    order, own = numbers * wide + places, numbers[first]
    while ranges:
        low, high = ranges.pop()
        a = np.searchsorted(order, own * wide + np.clip(at - high + 1, 0, wide - 1))
        b = np.searchsorted(order, own * wide + np.clip(at - low + 1, 0, wide - 1))
        count = b - a
        if (n := int(count.sum())) > PAIRS and high - low > 1:
            middle = (low + high) // 2
            ranges += [(middle, high), (low, middle)]
            continue
        if not n:
            continue
        where = places[np.repeat(a - np.cumsum(count) + count, count) + np.arange(n)]
        doc = np.repeat(at, count)
        diagonal = doc - where
        by = np.lexsort((doc, diagonal))
        d, i = diagonal[by], doc[by]
        cut = np.flatnonzero((d[1:] != d[:-1]) | (i[1:] != i[:-1] + 1)) + 1
        begin, end = np.r_[0, cut], np.r_[cut, n]
        yield np.stack([i[begin], i[begin] - d[begin], end - begin]).astype(np.int32)


def _free(used: np.ndarray, length: int) -> bool:
    """Whether so many words in a row are still free."""
    edge = np.flatnonzero(np.diff(np.r_[True, used, True].view(np.int8)))
    return len(edge) > 0 and int((edge[1::2] - edge[::2]).max()) >= length


def _tiles(runs, first: int, size: int, length: int, words: list[bytes], word) -> list[tuple[int, int, int]]:
    """Greedy tiles (document word, item word, words) from runs of seeds; the document's words are first to first + size. Runs are taken by length from
    a sorted array, what is left of a run that was split comes from a heap."""
    parts = list(runs)
    if not parts:
        return []
    at, place, count = np.concatenate(parts, axis=1)
    order = np.lexsort((at, place, -count))
    used, taken, tiles, heap, next_run = np.zeros(len(words), bool), np.zeros(size, bool), [], [], 0
    while next_run < len(order) or heap:
        run = (1, 0, 0)
        if next_run < len(order):
            x = order[next_run]
            run = (-int(count[x]) - length + 1, int(place[x]), int(at[x]))
        if heap and heap[0] < run:
            n, j, i = heapq.heappop(heap)
        else:
            n, j, i = run
            next_run += 1
        n, own = -n, i - first
        bad = used[j : j + n] | taken[own : own + n]
        if not bad.any():
            bad = np.array([word(i + k) != words[j + k] for k in range(n)])
            if not bad.any():
                used[j : j + n] = taken[own : own + n] = True
                tiles.append((i, j, n))
                if not _free(used, length):
                    break
                continue
        edge = np.flatnonzero(np.diff(np.r_[True, bad, True].view(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= length:
                heapq.heappush(heap, (a - b, j + a, i + a))
    return tiles


def _matches(column: pa.Array, items: Items, percent: int):
    """For each document and item with enough coverage: (row, item, words covered, tiles)."""
    data, offsets = utf8(column)
    for a, b in slices(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        hashes, starts, ends, first = word_hashes(part, own)

        def word(k, part=part, starts=starts, ends=ends):
            return LOWER[part[starts[k] : ends[k]]].tobytes()

        for length, seeds in items.seeds.items():
            found = shingle_hashes(hashes, length)
            cell = (found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            at = np.flatnonzero((seeds.cells[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
            k = np.minimum(np.searchsorted(seeds.hashes, found[at]), len(seeds.hashes) - 1)
            right = seeds.hashes[k] == found[at]
            at, k = at[right], k[right]
            row = np.searchsorted(first, at, side="right") - 1
            inside = at + length <= first[row + 1]
            at, k, row = at[inside], k[inside], row[inside]
            if not len(at):
                continue
            cuts = np.flatnonzero(np.diff(row)) + 1
            for begin, end in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(at)].tolist(), strict=True):
                here, numbers, r = at[begin:end], k[begin:end], int(row[begin])
                each = np.unique(numbers)
                count = seeds.begin[each + 1] - seeds.begin[each]
                which = np.repeat(seeds.begin[each] - np.cumsum(count) + count, count) + np.arange(count.sum())
                places = np.bincount(seeds.items[which], seeds.counts[which], len(items.ids))
                for item in np.flatnonzero(100 * np.minimum(items.sizes, length * places) >= percent * items.sizes).tolist():
                    if not places[item]:
                        continue
                    lo, hi = int(first[r]), int(first[r + 1])
                    tiles = _tiles(_runs(here, numbers, seeds.of(item)), lo, hi - lo, length, items.words[item], word)
                    covered = sum(t[2] for t in tiles)
                    if tiles and 100 * covered >= percent * len(items.words[item]):
                        yield a + r, item, covered, [(i - lo, j, n) for i, j, n in tiles]


def _pairs(batches, items, percent: int):
    for batch in batches:
        rows, out = [], []
        for row, item, covered, tiles in _matches(batch.column(1), items.value, percent):
            rows.append(row)
            size = len(items.value.words[item])
            out.append((items.value.ids[item], size, covered, covered / size, len(tiles), ",".join(f"{i}:{j}:{n}" for i, j, n in sorted(tiles))))
        if rows:
            cols = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.string()]
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["doc_id", "item_id", "item_words", "covered_words", "coverage", "n_tiles", "tiles"])


def _keep(batches, at: int, items, percent: int):
    for batch in batches:
        hit = np.ones(batch.num_rows, bool)
        for row, *_ in _matches(batch.column(at), items.value, percent):
            hit[row] = False
        yield batch.filter(pa.array(hit))


def _blocks(benchmark: DataFrame, least: int):
    """The benchmark's items in blocks of bounded bytes, each gathered and broadcast on its own."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, -(-int((size[0] or 0) + 16 * size[1]) // (BLOCK_BYTES // 2)))
    for k in range(blocks):
        held = (rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)).collect()
        held.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        yield spark.sparkContext.broadcast(Items([r.item_id for r in held], [r.text for r in held], least))


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, percent: int = COVERAGE_PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and item of which it covers `percent` or more; tiles as document word:item word:words, by document word."""
    schema = "doc_id long, item_id long, item_words long, covered_words long, coverage double, n_tiles long, tiles string"
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for items in _blocks(benchmark, least):
        found = read.mapInArrow(partial(_pairs, items=items, percent=percent), schema)
        out = found if out is None else out.union(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, percent: int = COVERAGE_PERCENT, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that cover no item to `percent`."""
    for items in _blocks(benchmark, least):
        docs = docs.mapInArrow(partial(_keep, at=docs.columns.index(text_col), items=items, percent=percent), docs.schema)
    return docs
