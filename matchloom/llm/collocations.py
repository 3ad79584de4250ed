"""Phrases whose words stand together more often than apart, mined from vertical positional lists.

1. Index. Texts of one language are laid one after the other in blocks, a word's position being its place in the block, with a gap between
   pieces, so that words of two pieces are never adjacent. A block's row holds each of its words with the list of its positions. A block ends
   between pieces; a longer piece is a block of its own. The index is written as a table.
2. Extension. The occurrence list of a phrase of k words is merge-joined, by position, with the postings of the words one place behind it;
   the positions that meet are the lists of the phrases of k + 1 words, and the length of a list is the phrase's exact count in the block. From
   two words on, only phrases whose first k and last k words are frequent in the whole table are extended.
3. Pruning. Which phrases of a block are frequent is found by 64-bit hashes: blocks send (hash, block, length of the list), a window sums
   over blocks, and frequent hashes go back to the blocks that hold them. Two phrases under one hash can only be kept too long. What
   is returned is counted again by the phrases' own texts, so results are exact.
4. Scores use decimals of 38 digits.

A phrase that stands in every text is one row for each block in the shuffles, whatever its count. No table is broadcast by name.

Rows: null and empty texts have no pieces, a null lang is 'und', repeated rows count each, ties in the ranking are broken down to the phrase, of which there is
one in each lang. An empty table gives no rows. Other columns are never read. Very long texts are cut into blocks between pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .shingles import LOWER, STEP, mix

SEPARATES = np.zeros(256, bool)
SEPARATES[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANK = SEPARATES.copy()
BLANK[list(b" \t")] = True
INDEX = "block long, lang string, occurrences long, words string, lengths binary, positions binary"
INDEX_ARROW = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("occurrences", pa.int64()), ("words", pa.string()), ("lengths", pa.binary()), ("positions", pa.binary())])


def _streams(texts: pa.Array, most_bytes: int) -> Iterator[np.ndarray]:
    """The bytes of all texts, a line feed behind each, in runs of about so many bytes that end behind a separator."""
    data = np.frombuffer(b"\n".join(x.as_py().encode() for x in texts) + b"\n", np.uint8)
    ends, at = np.flatnonzero(SEPARATES[data]) + 1, 0
    while at < len(data):
        k = np.searchsorted(ends, at + most_bytes, side="right") - 1
        to = int(ends[k]) if k >= 0 and ends[k] > at else int(ends[np.searchsorted(ends, at, side="right")])
        yield data[at:to]
        at = to


def _posted(data: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray] | None:
    """The words of a run of bytes, the length of each one's list, and the lists one after the other."""
    solid = ~BLANK[data]
    edge = np.diff(solid.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return None
    piece = np.cumsum(SEPARATES[data], dtype=np.int32)[starts]
    positions = np.arange(len(starts), dtype=np.int32) + np.cumsum(np.diff(piece, prepend=piece[0]) != 0, dtype=np.int32)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    tokens = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[solid]])).dictionary_encode()
    codes = tokens.indices.to_numpy()
    return tokens.dictionary, np.bincount(codes, minlength=len(tokens.dictionary)).astype(np.int32), positions[np.argsort(codes, kind="stable")]


def _pack(lengths: np.ndarray, positions: np.ndarray) -> bytes:
    """Lists as differences, the first of each from 0, by byte planes: the upper planes are mostly zeros, which compress to nothing."""
    first = np.cumsum(lengths) - lengths
    steps = np.diff(positions, prepend=0)
    steps[first] = positions[first]
    return steps.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(lengths: np.ndarray, packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel().astype(np.int64)
    run, first = np.cumsum(steps), np.cumsum(lengths) - lengths
    return (run - np.repeat(run[first] - steps[first], lengths)).astype(np.int32)


def _index(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy()
        for code, lang in enumerate(langs.dictionary):
            for data in _streams(batch.column("text").take(pa.array(np.flatnonzero(codes == code))), most_bytes):
                if found := _posted(data):
                    words, lengths, positions = found
                    row = [block, lang.as_py(), len(positions), " ".join(words.to_pylist()), lengths.astype("<i4").tobytes(), _pack(lengths, positions)]
                    block += 1
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, INDEX_ARROW, strict=True)], schema=INDEX_ARROW)


def positional_index(docs: DataFrame, most_bytes: int = 8_000_000) -> DataFrame:
    """A row for each block: its words, separated by spaces, and for each the length of its list and the list of its positions."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")).where("text != ''")
    return texts.mapInArrow(partial(_index, most_bytes=most_bytes), INDEX)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, lengths in zip(*(batch.column(c) for c in ("lang", "words", "lengths")), strict=True):
            words, counts = words.as_py().split(" "), np.frombuffer(lengths.as_py(), "<i4").astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(words)), pa.array(words), pa.array(counts)], names=["lang", "phrase", "f"])


class _Block:
    """One block's lists, extended word by word.

    An occurrence of a phrase is its first word's place in the block's order of positions; `starts` has those of all live phrases, ascending."""

    def __init__(self, lang: str, words: str, lengths: bytes, positions: bytes):
        counts = np.frombuffer(lengths, "<i4")
        lists = _unpack(counts, positions)
        order = np.argsort(lists)
        self.words, self.positions = words.split(" "), lists[order]
        self.codes = np.repeat(np.arange(len(counts)), counts)[order]
        seed = xxhash.xxh3_64_intdigest(lang)
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.words], np.uint64)
        self.size, self.starts, self.phrase = 1, np.arange(len(order)), self.codes.astype(np.int64)

    def extend(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists of phrases of one more word: joins each live occurrence with the live one a place behind it. Returns an occurrence, the hash and the list's length of each phrase."""
        last = self.starts + self.size - 1
        behind = np.searchsorted(self.starts, self.starts + 1)
        behind[behind == len(self.starts)] = 0
        meets = self.starts[behind] == self.starts + 1
        meets[meets] = self.positions[last[meets] + 1] == self.positions[last[meets]] + 1
        starts = self.starts[meets]
        keys = self.phrase[meets] * len(self.words) + self.codes[starts + self.size]
        found, one, self.phrase, lengths = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        self.starts, self.size = starts, self.size + 1
        hashes = self.hashes[self.codes[starts[one]]].copy()
        for j in range(1, self.size):
            hashes = mix(hashes * STEP + self.hashes[self.codes[starts[one] + j]])
        return starts[one], hashes, lengths

    def keep(self, live: np.ndarray) -> None:
        """live: for each phrase whether it is frequent; the others' lists go."""
        on = live[self.phrase]
        self.starts = self.starts[on]
        self.phrase = np.unique(self.phrase[on], return_inverse=True)[1]

    def texts(self, one: np.ndarray) -> pa.Array:
        words = pa.array(self.words)
        return pc.binary_join_element_wise(*[words.take(pa.array(self.codes[one + j])) for j in range(self.size)], " ")


def _blocks(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, str, _Block]]:
    for row in table.select(["block", "lang", "words", "lengths", "positions"]).to_pylist():
        yield row["block"], row["lang"], _Block(row["lang"], row["words"], row["lengths"], row["positions"])


def _hashed(block: int, hashes: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.repeat(pa.scalar(block, pa.int64()), len(hashes)), pa.array(lengths.astype(np.int64))], names=["h", "block", "n"])


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, _, lists in _blocks(batch):
            yield _hashed(block, *lists.extend()[1:])


def _regrown(lists: _Block, live: pa.Table, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The lists of 2, 3, ... words up to that size, the infrequent phrases of each size but the last dropped."""
    of, hashes = live.column("size").to_numpy(), live.column("h").to_numpy().view(np.uint64)
    for k in range(2, size + 1):
        one, h, lengths = lists.extend()
        if k < size:
            on = np.isin(h, hashes[of == k])
            lists.keep(on)
            one, h, lengths = one[on], h[on], lengths[on]
        yield one, h, lengths


def _longer(index: pa.Table, live: pa.Table, size: int) -> pa.Table:
    """Hashes of phrases of that size in one block."""
    out = []
    for block, _, lists in _blocks(index):
        for _one, h, lengths in _regrown(lists, live, size):
            pass
        out.append(_hashed(block, h, lengths))
    return pa.Table.from_batches(out, pa.schema([("h", pa.int64()), ("block", pa.int64()), ("n", pa.int64())]))


def _phrase_rows(index: pa.Table, live: pa.Table, size: int) -> pa.Table:
    """The texts and counts of one block's phrases: live ones, and all those of the last size."""
    parts = [pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "f": pa.array([], pa.int64())})]
    for _, lang, lists in _blocks(index):
        for one, _, lengths in _regrown(lists, live, size):
            parts.append(pa.table({"lang": pa.repeat(lang, len(one)), "phrase": lists.texts(one), "f": lengths.astype(np.int64)}))
    return pa.concat_tables(parts)


def phrase_counts(docs: DataFrame, scratch: Scratch, words: int = 3, least: int = 10, most_bytes: int = 8_000_000) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of one to `words` words that stands `least` times or more in its lang, and (lang, n), the count of all words."""
    index = scratch.table(positional_index(docs, most_bytes), "index")
    each = [index.select("lang", "words", "lengths").mapInArrow(_word_rows, "lang string, phrase string, f long")]
    if words > 1:
        live = docs.sparkSession.createDataFrame([], "size int, h long, block long")
        for size in range(2, words):
            rows = index.mapInArrow(_pair_rows, "h long, block long, n long") if size == 2 else _by_block(index, live, partial(_longer, size=size), "h long, block long, n long")
            total = F.sum("n").over(Window.partitionBy("h"))
            frequent = rows.withColumn("total", total).where(F.col("total") >= least).select(F.lit(size).alias("size"), "h", "block")
            live = scratch.table(live.union(frequent), f"live{size}")
        each.append(_by_block(index, live, partial(_phrase_rows, size=words), "lang string, phrase string, f long"))
    counts = each[0] if len(each) == 1 else each[0].union(each[1])
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least), index.groupBy("lang").agg(F.sum("occurrences").alias("n"))


def _by_block(index: DataFrame, live: DataFrame, what, schema: str) -> DataFrame:
    return index.groupBy("block").cogroup(live.groupBy("block")).applyInArrow(what, schema)


def _pieces(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, words: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The first `top` phrases of each lang by score, without those of which a longer candidate makes up `share` percent of the occurrences."""
    scratch = Scratch(docs.sparkSession, "collocations")
    counted, sums = phrase_counts(docs, scratch, words, least)
    counts = scratch.table(counted, "counts")
    split = F.split("phrase", " ")
    candidates = counts.where(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("f").alias("a"), split.alias("w"))

    cut = candidates.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _pieces(F.col("w"), F.lit(1), F.col("k")).alias("head"), _pieces(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"))
    of = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    both = cut.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"({wide('a')} * {wide('a')} * cast(1000000 as decimal(7, 0))) div ({wide('l')} * {wide('r')})")
    scored = both.select("lang", "phrase", F.struct(score.alias("score"), "k", "l", "r", "a").alias("s")).groupBy("lang", "phrase").agg(F.min("s").alias("s"))

    inner = F.explode(F.expr("flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))))"))
    within = candidates.where("size(w) > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {int(share)} * s.a")

    # the best of each of 64 groups of a lang, then the best of these: no task sees all candidates of a lang
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = kept.select("lang", "phrase", "s.*").withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    near = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*best))).where(F.col("rank") <= top)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return last.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
