"""Toxicity: subword-bag embeddings, averaged into a linear softmax, trained jointly in numpy.

A word (a run without white space, lower case, without signs at its ends) is the bag of its character n-grams of 3 to 5
characters with marks for its ends and the word itself, each hashed to one of 2**BUCKET_BITS vectors; so an unseen misspelling shares vectors
with what was seen. A bag is a window of WINDOW words in a row, every place of the whole text; its vectors are averaged and
put through a softmax of two classes. A document's score is that of its highest window. As the softmax is linear, a window's
logit is the mean of one number per n-gram, which is all that scoring needs.

Fit on the driver, on a bounded sample of labelled rows (`positives` + `negatives` rows, by a hash of the id; of a text of more than
`positive_chars` or `negative_chars` characters a window of that many, from a hashed place on, so long texts teach too and memory is bounded): first on whole documents as bags, then on each document's highest windows. A part of the sample
is kept out of the fit and sets the point where the score is 0.5. Scores never see ids, languages, sources or labels.
Texts without words, empty and null, get the score of an empty bag, below 0.5; repeated rows and labels are harmless (the
highest label of a document counts); without labels of both classes every score is 0. The sample's n-grams, held as 32-bit numbers, take at most
12 bytes a character: 0.4 GB at the defaults if every sampled text is that long.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import mix, powers

BUCKET_BITS = 17
SIZES = (3, 4, 5)
WINDOW = 4
DIM = 8
RUN = 400_000
KNOWN = np.array([chr(c).isalnum() for c in range(0x10000)])
SPACE = np.array([chr(c).isspace() for c in range(0x10000)])
BEGIN, END = 0x110001, 0x110002
STEPS = np.uint64(0x9E3779B97F4A7C15)


def subwords(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram, grouped by word, and each word's number of n-grams."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.minimum(code, 0xFFFF)
    solid = ~SPACE[low]
    edge = np.diff(np.r_[False, solid, False].view(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.flatnonzero(KNOWN[low] & solid)
    a = np.searchsorted(letters, starts)
    b = np.searchsorted(letters, ends)
    has = b > a
    starts, ends = letters[a[has]], letters[b[has] - 1] + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = ends - starts + 2
    first = np.cumsum(size) - size
    chars = np.empty(size.sum(), np.uint64)
    inner = np.ones(len(chars), bool)
    inner[first] = inner[first + size - 1] = False
    count = ends - starts
    chars[inner] = code[np.repeat(starts - np.cumsum(count) + count, count) + np.arange(count.sum())]
    chars[first], chars[first + size - 1] = BEGIN, END
    left = np.repeat(first + size, size) - np.arange(len(chars))
    hashes = np.zeros((len(SIZES) + 1, len(chars)), np.uint64)
    fits = np.zeros(hashes.shape, bool)
    fits[:-1] = left >= np.array(SIZES)[:, None]
    hashes[-1, first] = np.add.reduceat(chars * powers(int(STEPS), int(size.max()) + 1)[left], first) ^ np.uint64(END)
    fits[-1, first] = True
    run = chars.copy()
    for n in range(2, min(SIZES[-1], len(chars)) + 1):
        run[: len(run) - n + 1] = run[: len(run) - n + 1] * STEPS + chars[n - 1 :]
        if n in SIZES:
            hashes[n - SIZES[0]] = run
    hashes = hashes.T[fits.T]
    per_char = fits.sum(axis=0)
    return (mix(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.add.reduceat(per_char, first)


def window_sums(value: np.ndarray, grams: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sum of values and number of n-grams of each window of words; a shorter text is one window."""
    ends = np.r_[0, np.cumsum(grams)]
    total = np.r_[0.0, np.cumsum(value, dtype=np.float64)]
    k = min(window, len(grams))
    at, to = ends[: len(grams) - k + 1], ends[k:]
    return total[to] - total[at], to - at


class Model:
    """value: logit share of each n-gram; bias: logit of an empty bag; cut: the logit where the score is 0.5."""

    def __init__(self, value: np.ndarray, bias: float, cut: float):
        self.value, self.bias, self.cut = value.astype(np.float32), bias, cut

    def logit(self, text: str | None) -> float:
        buckets, grams = subwords(text or "")
        if not len(grams):
            return min(self.bias, self.cut - 1)
        sums, counts = window_sums(self.value[buckets], grams)
        return float((sums / np.maximum(counts, 1)).max()) + self.bias

    def score(self, text: str | None) -> float:
        if not self.value.any():
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.logit(text) - self.cut, -30, 30))))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, name: str, at: np.ndarray, grad: np.ndarray) -> None:
        m, v = self.m.setdefault(name, np.zeros_like(at)), self.v.setdefault(name, np.zeros_like(at))
        m += 0.1 * (grad - m)
        v += 0.02 * (grad * grad - v)
        at -= self.rate * m / (np.sqrt(v) + 1e-7)


def fit(texts: list[str], labels: list[int], rounds: int = 24, seed: int = 0) -> Model:
    """Trains embeddings and softmax together; a fifth of the rows only sets the cut."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BUCKET_BITS), -40.0, 0.0)
    bags = [(ids.astype(np.int32), grams.astype(np.int32)) for ids, grams in map(subwords, texts)]
    used = np.array([len(g) > 0 for _, g in bags])
    held = rng.random(len(y)) < 0.2
    fold = np.flatnonzero(used & ~held)
    weight = np.where(y == 1, 0.5 / max(1, (y[fold] == 1).sum()), 0.5 / max(1, (y[fold] == 0).sum())).astype(np.float32) * len(fold)
    vectors = (rng.standard_normal((1 << BUCKET_BITS, DIM)) * 0.05).astype(np.float32)
    out, bias = (rng.standard_normal((DIM, 2)) * 0.3).astype(np.float32), np.zeros(2, np.float32)
    adam = _Adam(0.02)

    def learn(parts: list[np.ndarray], which: list[int], decay: float) -> None:
        """One step on bags of n-grams and the documents they are from; the gradient is added up over runs of about RUN n-grams."""
        sizes = np.array([len(x) for x in parts])
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // RUN)) + 1
        grad, grad_out, grad_bias = np.zeros_like(vectors), np.zeros_like(out), np.zeros_like(bias)
        for own in np.split(np.arange(len(parts)), cuts):
            ids, size, of = np.concatenate([parts[i] for i in own]), sizes[own], np.array([which[i] for i in own])
            mean = np.add.reduceat(vectors[ids], np.cumsum(size) - size) / size[:, None]
            z = mean @ out + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(of)), y[of].astype(int)] -= 1
            p *= (weight[of] / len(which))[:, None]
            back = ((p @ out.T) / size[:, None]).astype(np.float32)
            for d in range(DIM):
                grad[:, d] += np.bincount(ids, np.repeat(back[:, d], size), 1 << BUCKET_BITS)
            grad_out += mean.T @ p
            grad_bias += p.sum(axis=0)
        adam.step("vectors", vectors, grad + decay * vectors)
        adam.step("out", out, grad_out + decay * out)
        adam.step("bias", bias, grad_bias)

    distinct = [np.unique(bags[i][0]) for i in fold]
    for _ in range(8):
        learn(distinct, fold.tolist(), 1e-6)
    del distinct

    def best(i: int, value: np.ndarray, k: int):
        """The k highest windows of a document and one at random, as slices of its n-grams."""
        ids, grams = bags[i]
        sums, counts = window_sums(value[ids], grams)
        mean = sums / np.maximum(counts, 1)
        ends = np.r_[0, np.cumsum(grams)]
        top = [int(mean.argmax())]
        if k > 1:
            top.append(int(rng.integers(len(mean))))
        width = min(WINDOW, len(grams))
        return [ids[ends[t] : ends[t + width]] for t in top]

    for _ in range(rounds):
        value = (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32)
        parts, which = [], []
        for i in fold:
            got = [x for x in best(i, value, 1 if y[i] else 2) if len(x)]
            parts += got
            which += [i] * len(got)
        for _ in range(2):
            learn(parts, which, 2e-6)
    value = vectors @ (out[:, 1] - out[:, 0])
    model = Model(value, float(bias[1] - bias[0]), 0.0)
    check = np.flatnonzero(held & used) if len(set(y[held & used].tolist())) == 2 and (y[held & used] == 1).sum() >= 5 else np.flatnonzero(used)
    del bags
    z = np.array([model.logit(texts[i]) for i in check])
    order = np.argsort(-z, kind="stable")
    right = np.cumsum(np.where(y[check][order] == 1, 1, -1))
    at = int(right.argmax())
    lower = z[order[at + 1]] if at + 1 < len(z) else z[order[at]] - 1
    model.cut = float((z[order[at]] + lower) / 2) if right[at] > 0 else float(z.max() + 1)
    return model


def fold(doc_id: int | None) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


def train(docs: DataFrame, labels: DataFrame, positives: int = 1000, negatives: int = 2000, positive_chars: int = 20_000, negative_chars: int = 6_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on labelled rows of the folds 1 to 4 (crc32 of the id's digits, modulo 5). Of several texts with one id the least window counts."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows: dict[int, tuple] = {}
    for label, most, chars in ((0, negatives, negative_chars), (1, positives, positive_chars)):
        ids = known.where(F.col("toxic") == label).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        start = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int") + 1
        for r in read.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.substring(F.col("text"), start, F.lit(chars))).alias("text")).collect():
            rows[r.doc_id] = (r.text, label)
    order = sorted(rows)
    return fit([rows[i][0] for i in order], [rows[i][1] for i in order])


def _score(batches, model):
    m = model.value
    for batch in batches:
        score = [m.score(x) for x in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32())], names=["doc_id", "score", "predicted"])


def _keep(batches, at: int, model):
    m = model.value
    for batch in batches:
        yield batch.filter(pa.array([m.score(x) < 0.5 for x in batch.column(at).to_pylist()], pa.bool_()))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = read.mapInArrow(partial(_score, model=held), "doc_id long, score double, predicted int")
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that score below 0.5."""
    return docs.mapInArrow(partial(_keep, at=docs.columns.index(text_col), model=docs.sparkSession.sparkContext.broadcast(model)), docs.schema)
