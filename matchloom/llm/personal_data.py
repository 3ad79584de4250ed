"""Personal data: base rules, and a character-level bidirectional LSTM with CRF transitions that adds spans to theirs.

Base rules are leftmost, non-overlapping matches for each kind (KINDS), each then checked and dropped if it fails. The network is
trained in numpy from labelled spans: those of the base rules in a bounded sample of the texts, and written variants of
them (spelled-out e-mail addresses, numbers without a plus, addresses with other separators), each labelled where it is put into
sampled text. Every text is cut into windows of WINDOW characters, OVERLAP of them shared with the next, which is more than MOST, so any span that may
be added lies whole in a window; each window's best tag path is decoded. Spans of one kind that share characters are joined: a later piece adds its
margin for the characters that are new. Spans that only touch stay two. Of spans of several kinds that overlap in a document the set of the greatest
total score stays. A span of the network that meets a base span, is
not of LEAST to MOST characters, has fewer digits than its kind needs or a mean margin below MARGIN is left out, so base spans
always stay as they are.

Positions are code points, ends exclusive. Null and empty texts have no spans; repeated rows give equal rows; extra columns are
ignored; without any text to train on only the base rules speak. Memory follows the longest single text.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)
WINDOW, OVERLAP = 512, 96
WIDTHS = [64, 128, 192, 256, 320, 384, 448, WINDOW]
HIDDEN, EMBED = 8, 8
LEAST, MOST, MARGIN = 7, 80, 1.0
LEAST_DIGITS = (0, 4, 12, 7)
SLICE_CHARS = 500_000

# ---- base rules ----------------------------------------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def _emails(text: str):
    """From each @ back to the last match or the first character that can't stand before one: the leftmost match, in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: list[str]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, *s) for s in _emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(digits := DIGIT.findall(m.group())) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m.group())) <= 15]
    return out


# ---- characters ----------------------------------------------------------------------------------------------------------

SIGNS = "@.-_+()[]{}<>:;,/\\%#=*&'\"!?|~"
CLASSES = 34 + len(SIGNS)


def _class_table() -> np.ndarray:
    """0 beyond the text, 1 other, 2 other letters, 3 digits, 4 space, 5 line break, then a-z in either case, then SIGNS."""
    out = np.ones(0x3000, np.uint8)
    for c in range(len(out)):
        if chr(c).isalpha():
            out[c] = 2
        elif chr(c).isspace():
            out[c] = 4
    out[ord("0") : ord("9") + 1] = 3
    out[ord("\n")] = out[ord("\r")] = 5
    for i in range(26):
        out[ord("a") + i] = out[ord("A") + i] = 6 + i
    for i, s in enumerate(SIGNS):
        out[ord(s)] = 33 + i
    return out


CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASS[np.minimum(code, len(CLASS) - 1)]


# ---- network -------------------------------------------------------------------------------------------------------------


def _allowed() -> np.ndarray:
    """Transitions that make no sense: inside a span from anything but that kind's begin or inside."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        for y in range(TAGS):
            if y not in (1 + 2 * k, 2 + 2 * k):
                out[y, 2 + 2 * k] = -1e4
    return out


BANNED = _allowed()


def _runs(sizes: np.ndarray | None, n: int, size: int) -> list[tuple[int, int, int]]:
    """(size, first, end) of the windows of one size; sizes don't grow."""
    if sizes is None:
        return [(size, 0, n)]
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), n]
    return [(int(sizes[a]), a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _sigmoid(z: np.ndarray) -> None:
    """1 / (1 + exp(z)) in place; an exp beyond the floats gives 0. (numpy's tanh takes twice the time of its exp.)"""
    with np.errstate(over="ignore"):
        np.exp(z, out=z)
    z += 1
    np.divide(1, z, out=z)


class Network:
    """Parameters; gates stand in the order input, forget, output, candidate."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"embed": normal(CLASSES, EMBED, scale=0.5), "out": normal(2 * HIDDEN, TAGS, scale=0.3), "out_b": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.p |= {f"w{d}": normal(EMBED, 4 * HIDDEN, scale=0.35), f"u{d}": normal(HIDDEN, 4 * HIDDEN, scale=0.35), f"c{d}": bias}
        self.p["out_b"][0] = 2

    # -- scoring: (direction, gate, window) so that every step works on long rows

    def prepared(self):
        """Embeddings by character class; gates by state, one and embedding, so that one product gives all; tags by state and one.

        A sigmoid is 1 / (1 + exp(-x)), and a tanh is 2 * sigmoid(2 * x) - 1: signs and the factor stand in the gates."""
        turned = -np.r_[np.ones(3 * HIDDEN), np.full(HIDDEN, 2)].astype(np.float32)
        gates = np.stack([(np.concatenate([self.p[f"u{d}"], self.p[f"c{d}"][None], self.p[f"w{d}"]]) * turned).T for d in "fb"])
        bias = np.stack([self.p["out_b"], np.zeros_like(self.p["out_b"])])
        out = np.concatenate([self.p["out"].T.reshape(TAGS, 2, HIDDEN).transpose(1, 0, 2), bias[:, :, None]], axis=2)
        return tuple(np.ascontiguousarray(x, np.float32) for x in (self.p["embed"].T, gates, out))

    def emissions(self, windows: np.ndarray, prepared, sizes: np.ndarray | None = None) -> np.ndarray:
        """(character, tag, window) for windows of classes (window, character). Windows may have their own sizes, the greatest first: what stands
        beyond a window's size is left open then."""
        embed, gates, out = prepared
        n, size = windows.shape
        runs = _runs(sizes, n, size)
        backward = np.zeros_like(windows)
        for s, a, b in runs:
            backward[a:b, :s] = windows[a:b, :s][:, ::-1]
        by_char = np.ascontiguousarray(windows.T), np.ascontiguousarray(backward.T)
        emitted = np.empty((2, size, TAGS, n), np.float32)
        h, c = np.zeros((2, HIDDEN, n), np.float32), np.zeros((2, HIDDEN, n), np.float32)
        done = 0
        for s, _, k in reversed(runs):
            # the windows that end here leave, so the others stand in rows without gaps
            given = np.ones((2, gates.shape[2], k), np.float32)
            given[:, :HIDDEN], c = h[:, :, :k], np.ascontiguousarray(c[:, :, :k])
            h, state = given[:, :HIDDEN], given[:, : HIDDEN + 1]
            z, x = np.empty((2, 4 * HIDDEN, k), np.float32), np.empty_like(c)
            for t in range(done, s):
                for d in range(2):
                    np.take(embed, by_char[d][t, :k], axis=1, out=given[d, HIDDEN + 1 :], mode="clip")
                np.matmul(gates, given, out=z)
                _sigmoid(z)
                g = z[:, 3 * HIDDEN :]
                g *= 2
                g -= 1
                g *= z[:, :HIDDEN]
                c *= z[:, HIDDEN : 2 * HIDDEN]
                c += g
                np.multiply(c, -2, out=x)
                _sigmoid(x)
                x *= 2
                x -= 1
                np.multiply(x, z[:, 2 * HIDDEN : 3 * HIDDEN], out=h)
                np.matmul(out, state, out=emitted[:, t, :, :k])
            done = s
        for s, a, b in runs:
            emitted[0, :s, :, a:b] += emitted[1, s - 1 :: -1, :, a:b]
        return emitted[0]

    def decode(self, emitted: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """Best tags (window, character) under the transitions, by Viterbi; 0 beyond a window's size. The way back is worked out again from the kept scores,
        but where no path has a higher score than that without any span."""
        trans = self.p["trans"] + BANNED
        size, _, n = emitted.shape
        outside, begin, inside = [0, *range(1, TAGS, 2)], slice(1, None, 2), slice(2, None, 2)
        enter = np.ascontiguousarray(trans[:, outside][:, :, None])
        kinds = np.arange(len(KINDS))
        go_in, stay = trans[2 * kinds + 1, 2 * kinds + 2][:, None], trans[2 * kinds + 2, 2 * kinds + 2][:, None]
        runs = _runs(sizes, n, size)
        scores = np.empty((size, TAGS, n), np.float32)
        scores[0] = emitted[0]
        none, last, tags = emitted[0, 0].copy(), np.empty((TAGS, n), np.float32), np.zeros((n, size), np.int8)
        done = 1
        for s, a, k in reversed(runs):
            for t in range(done, s):
                before, now = scores[t - 1, :, :k], scores[t, :, :k]
                now[outside] = (before[:, None, :] + enter).max(axis=0)
                now[inside] = np.maximum(before[begin] + go_in, before[inside] + stay)
                now += emitted[t, :, :k]
                none[:k] += trans[0, 0]
                none[:k] += emitted[t, 0, :k]
            last[:, a:k], done = scores[s - 1, :, a:k], max(done, s)
        these = np.flatnonzero(last.max(axis=0) > none)
        if not len(these):
            return tags
        kept, ends = np.ascontiguousarray(scores[:, :, these]), last[:, these].argmax(axis=0)
        own = np.full(len(these), size) if sizes is None else np.asarray(sizes)[these]
        back = np.zeros((size, len(these)), np.int8)
        for t in range(int(own[0]) - 1, -1, -1):
            k, to = int(np.count_nonzero(own > t + 1)), int(np.count_nonzero(own > t))
            if k:
                back[t, :k] = (kept[t, :, :k] + trans[:, back[t + 1, :k]]).argmax(axis=0)
            back[t, k:to] = ends[k:to]
        tags[these] = back.T
        return tags

    # -- training

    def _run(self, x: np.ndarray, d: str):
        """States of one direction, and what the gradient needs. x: (character, window) in its order."""
        emb, w, u, b = self.p["embed"], self.p[f"w{d}"], self.p[f"u{d}"], self.p[f"c{d}"]
        size, n = x.shape
        h, c, kept = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), []
        table = emb @ w + b
        for t in range(size):
            z = table[x[t]] + h @ u
            s = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            g = np.tanh(z[:, 3 * HIDDEN :])
            before = c
            c = s[:, HIDDEN : 2 * HIDDEN] * c + s[:, :HIDDEN] * g
            tc = np.tanh(c)
            kept.append((h, before, s, g, tc))
            h = s[:, 2 * HIDDEN :] * tc
        return np.stack([k[0] for k in kept[1:]] + [h]), kept

    def _back(self, x: np.ndarray, d: str, kept, grad: np.ndarray, out: dict) -> None:
        w, u = self.p[f"w{d}"], self.p[f"u{d}"]
        size, n = x.shape
        dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        per_class, du = np.zeros((CLASSES, 4 * HIDDEN), np.float32), np.zeros_like(u)
        for t in range(size - 1, -1, -1):
            h, before, s, g, tc = kept[t]
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(per_class, x[t], dz)
            du += h.T @ dz
            dh, dc = dz @ u.T, dc * f
        out[f"u{d}"], out[f"c{d}"] = du, per_class.sum(axis=0)
        out[f"w{d}"] = self.p["embed"].T @ per_class
        out["embed"] = out.get("embed", 0) + per_class @ w.T

    def gradient(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags under the CRF, and its gradient."""
        x, y = np.ascontiguousarray(windows.T), tags.T.astype(np.int64)
        size, n = x.shape
        hf, kf = self._run(x, "f")
        hb, kb = self._run(x[::-1], "b")
        both = np.concatenate([hf, hb[::-1]], axis=2)
        e = both @ self.p["out"] + self.p["out_b"]
        trans = self.p["trans"] + BANNED

        def total(v, axis):
            top = v.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(v - top).sum(axis=axis))

        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for t in range(1, size):
            a[t] = total(a[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(size - 2, -1, -1):
            b[t] = total(trans + (e[t + 1] + b[t + 1])[:, None, :], 2)
        z = total(a[-1], 1)
        steps, rows = np.arange(size)[:, None], np.arange(n)
        gold = e[steps, rows, y].sum(axis=0) + trans[y[:-1], y[1:]].sum(axis=0)
        de = np.exp(a + b - z[:, None])
        de[steps, rows, y] -= 1
        pair = np.exp(a[:-1, :, :, None] + trans + (e[1:] + b[1:])[:, :, None, :] - z[:, None, None]).sum(axis=(0, 1))
        np.add.at(pair, (y[:-1], y[1:]), -1)
        de /= n
        grads = {"out": both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS), "out_b": de.sum(axis=(0, 1)), "trans": np.where(BANNED < 0, 0, pair / n)}
        dh = de @ self.p["out"].T
        self._back(x, "f", kf, dh[:, :, :HIDDEN], grads)
        self._back(x[::-1], "b", kb, np.ascontiguousarray(dh[::-1, :, HIDDEN:]), grads)
        return float((z - gold).mean()), grads

    def fit(self, windows: np.ndarray, tags: np.ndarray, steps: int = 700, batch: int = 48, rate: float = 0.02, seed: int = 1) -> "Network":
        rng = np.random.default_rng(seed)
        m, v = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            at = rng.choice(len(windows), min(batch, len(windows)), replace=False)
            _, grads = self.gradient(windows[at], tags[at])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            slow = rate * min(1.0, 3 * (1 - (step - 1) / steps))
            for k, g in grads.items():
                g = g * min(1.0, 5 / max(norm, 1e-9))
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] -= (slow * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            self.p["trans"] = np.minimum(self.p["trans"] - self.p["trans"][0, 0], 0)  # no step scores above none to none, so spans must show in emissions
        return self


# ---- labelled spans ------------------------------------------------------------------------------------------------------


def _letters(rng, n: int) -> str:
    return "".join(chr(97 + c) for c in rng.integers(0, 26, n))


def _digits(rng, n: int) -> str:
    return "".join(str(c) for c in rng.integers(0, 10, n))


def _spelled(at: str, dot: str):
    """An e-mail address with other signs for @ and the dot."""

    def make(rng: np.random.Generator) -> str:
        tail = ("com", "org", "net", "example" + dot + "com")[int(rng.integers(4))]
        return _letters(rng, int(rng.integers(3, 10))) + ("", ".", "_")[int(rng.integers(3))] + ("", _digits(rng, 2))[int(rng.integers(2))] + at + _letters(rng, int(rng.integers(3, 9))) + dot + tail

    return make


#: Written variants that the base rules don't have: (kind, how one is made).
VARIANTS = [
    *((0, _spelled(*x)) for x in ((" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" AT ", " DOT "), ("(at)", "."), (" [at] ", "."))),
    *((1, lambda rng, sign=sign: sign.join(str(int(x)) for x in rng.integers(1, 255, 4))) for sign in ("[.]", "(.)", " . ")),
    *((2, lambda rng, sign=sign: sign.join(_digits(rng, 4) for _ in range(4))) for sign in (".", "/", "_")),
    (3, lambda rng: f"({_digits(rng, 3)}) {_digits(rng, 3)}-{_digits(rng, 4)}"),
    (3, lambda rng: f"{_digits(rng, 3)}-{_digits(rng, 3)}-{_digits(rng, 4)}"),
    (3, lambda rng: f"00{_digits(rng, 2)} {_digits(rng, 3)} {_digits(rng, 7)}"),
    (3, lambda rng: f"tel. {_digits(rng, 3)}/{_digits(rng, 7)}"),
]


def _variant(rng: np.random.Generator, variants: list) -> tuple[int, str]:
    """Kinds are drawn alike, then the variants of the kind."""
    kinds = sorted({k for k, _ in variants})
    kind = kinds[int(rng.integers(len(kinds)))]
    own = [make for k, make in variants if k == kind]
    return kind, own[int(rng.integers(len(own)))](rng)


def _drawn(rng: np.random.Generator, spans: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """At most so many spans, one of each kind in turn, at random within a kind."""
    turns = []
    for kind in range(len(KINDS)):
        own = [s for s in spans if s[0] == kind]
        turns += [(n, kind, own[i]) for n, i in enumerate(rng.permutation(len(own)).tolist())]
    return [s for *_, s in sorted(turns)[:most]]


def labelled(texts: list[str], size: int = 96, seed: int = 5, per_text: int = 6, variants: list = VARIANTS) -> tuple[np.ndarray, np.ndarray]:
    """Windows of classes and tags: around base spans, of a text at most `per_text`, drawn over its kinds in turn, around variants put into text, and of text
    without any."""
    rng = np.random.default_rng(seed)
    rows, tags = [], []

    def add(text: str, spans: list[tuple[int, int, int]], at: int) -> None:
        x, y = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        own = classes(text[at : at + size])
        x[: len(own)] = own
        for kind, start, end in spans:
            a, b = max(start - at, 0), min(end - at, size)
            if a < b:
                y[a:b] = 2 + 2 * kind
                if start >= at:
                    y[a] = 1 + 2 * kind
        rows.append(x)
        tags.append(y)

    for text in texts:
        if not text:
            continue
        spans = base_spans(text)
        for _, start, _ in _drawn(rng, spans, per_text):
            add(text, spans, max(0, start - int(rng.integers(0, size * 3 // 4))))
        at = int(rng.integers(0, max(1, len(text) - size)))
        add(text, spans, at)
        kind, value = _variant(rng, variants)
        gap = text.find(" ", at + size // 4)
        gap = min(gap, at + size // 2) if gap >= 0 else min(len(text), at + size // 2)
        whole = text[at:gap] + " " + value + " " + text[gap : gap + size]
        add(whole, [*((k, a - at, b - at) for k, a, b in spans if b <= gap), (kind, gap - at + 1, gap - at + 1 + len(value))], max(0, gap - at - int(rng.integers(size // 3))))
        if rng.random() < 0.5:  # numbers and signs that are nobody's
            signs, n = (("0123456789", int(rng.integers(1, 9))), ("0123456789abcdef", int(rng.integers(24, 44))), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", int(rng.integers(12, 24))))[int(rng.integers(3))]
            junk = "".join(signs[int(c)] for c in rng.integers(0, len(signs), n))
            add(text[at:gap] + f" {junk} " + text[gap : gap + size], [(k, a - at, b - at) for k, a, b in spans if b <= gap], 0)
    return np.stack(rows) if rows else np.zeros((0, size), np.uint8), np.stack(tags) if tags else np.zeros((0, size), np.uint8)


def train(docs: DataFrame, sample: int = 800, chars: int = 6000, per_text: int = 6, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """Fits on a sample of at most `sample` texts (least hashes of their ids), of at most `chars` characters each from a hashed place on."""
    ids = docs.where(F.length(F.col(text_col)) > 0).select(F.col(id_col).cast("long").alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
    text = F.col(text_col).cast("string")
    start = F.pmod(F.xxhash64("_id", F.lit(3)), F.greatest(F.length(text) - chars, F.lit(1))).cast("int") + 1
    got = docs.withColumn("_id", F.col(id_col).cast("long")).join(F.broadcast(ids), "_id").where(text != "").groupBy("_id").agg(F.min(F.substring(text, start, F.lit(chars))).alias("part"))
    texts = [r.part for r in sorted(got.collect(), key=lambda r: r._id)]
    windows, tags = labelled(texts, per_text=per_text)
    return Network().fit(windows, tags) if len(windows) else None


# ---- scoring -------------------------------------------------------------------------------------------------------------


def reconciled(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, score): joins spans of one kind that share characters, then keeps the non-overlapping set of the greatest score."""
    joined: list[list] = []
    for kind in range(len(KINDS)):
        last = None
        for _, a, b, s in sorted(x for x in spans if x[0] == kind):
            if last is not None and a < last[2]:
                if b > last[2]:  # the new characters' part of the piece's score
                    last[2], last[3] = b, last[3] + s * (b - last[2]) / (b - a)
                elif s > last[3]:
                    last[3] = s
            else:
                joined.append(last := [kind, a, b, s])
    joined.sort(key=lambda x: (x[2], x[1]))
    ends = [x[2] for x in joined]
    best, take = [0.0], []
    for i, (_, a, _, s) in enumerate(joined):
        before = int(np.searchsorted(ends[:i], a, side="right"))
        take.append((best[before] + s > best[i], before))
        best.append(max(best[i], best[before] + s))
    out, i = [], len(joined)
    while i:
        on, before = take[i - 1]
        if on:
            out.append(tuple(joined[i - 1]))
        i = before if on else i - 1
    return out[::-1]


def _found(network: Network, prepared, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """The network's spans of each text, over windows of all texts at once."""
    out: list[list] = [[] for _ in texts]
    step = WINDOW - OVERLAP
    counts = [max(1, -(-(len(t) - OVERLAP) // step)) if t else 0 for t in texts]
    if not sum(counts):
        return out
    # each text's classes and a window of zeros, so that no window reaches into the next text
    coded = np.concatenate([x for t in texts for x in (classes(t), np.zeros(WINDOW, np.uint8))])
    lengths = np.array(list(map(len, texts)))
    base = np.cumsum(lengths + WINDOW) - lengths - WINDOW
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    start = (np.arange(len(owner)) - first[owner]) * step
    width = np.array(WIDTHS)[np.searchsorted(WIDTHS, np.minimum(lengths[owner] - start, WINDOW))]  # ends of texts don't fill a window, so they are run in shorter ones
    order = np.argsort(-width, kind="stable")
    parts = -(-int(width.sum()) // SLICE_CHARS)
    for part in range(parts):
        these = order[part::parts]
        if not len(these):
            continue
        sizes, own, at = width[these], owner[these], start[these]
        windows = np.lib.stride_tricks.sliding_window_view(coded, int(sizes[0]))[base[own] + at]
        emitted = network.emissions(windows, prepared, sizes)
        tags = network.decode(emitted, sizes)
        for w in np.flatnonzero(tags.any(axis=1)).tolist():
            size = int(sizes[w])
            line = tags[w, :size]
            doc, offset = int(own[w]), int(at[w])
            kind = np.where(line > 0, (line.astype(np.int64) + 1) // 2, 0)
            cuts = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (line[1:] % 2 == 1) & (line[1:] > 0)])
            for c, d in zip(cuts.tolist(), [*cuts[1:].tolist(), size], strict=True):
                if kind[c]:
                    e = min(d + offset, len(texts[doc]))
                    margin = emitted[np.arange(c, d), line[c:d], w] - emitted[c:d, 0, w]
                    if e > c + offset:
                        out[doc].append((int(kind[c]) - 1, c + offset, e, float(margin.sum())))
    return out


def all_spans(texts: list[str], network: Network | None, prepared=None) -> list[tuple[list, list]]:
    """For each text its base spans, and base and added spans together, by kind and start."""
    found = _found(network, prepared or network.prepared(), texts) if network else [[] for _ in texts]
    out = []
    for text, spans in zip(texts, found, strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        added = []
        for kind, a, b, score in reconciled(spans):
            while a < b and text[a].isspace():
                a += 1
            while a < b and text[b - 1].isspace():
                b -= 1
            at = int(np.searchsorted([x for x, _ in taken], b)) if taken else 0
            meets = any(y > a for _, y in taken[:at])
            digits = len(DIGIT.findall(text[a:b]))
            if LEAST <= b - a <= MOST and digits >= LEAST_DIGITS[kind] and score >= MARGIN * (b - a) and not meets:
                added.append((kind, a, b))
        out.append((base, sorted(base + added)))
    return out


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _score(batches, model):
    network = model.value
    prepared = network.prepared() if network else None
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"]
    for batch in batches:
        texts = [x or "" for x in batch.column(1).to_pylist()]
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE_CHARS):
                size += len(texts[to])
                to += 1
            rows = []
            for base, spans in all_spans(texts[at:to], network, prepared):
                rows.append((*(sum(k == kind for k, *_ in base) for kind in range(len(KINDS))), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), len(spans) - len(base), len(spans)))
            types = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([batch.column(0).slice(at, to - at), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=names)
            at = to


def personal_data(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans (kind:start:end, comma-joined), n_added and n_spans (added ones, and all) for every document."""
    held = docs.sparkSession.sparkContext.broadcast(network)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(partial(_score, model=held), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind]}]"]
            done = b
    return "".join([*out, text[done:]])
