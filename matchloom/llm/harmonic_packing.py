"""Harmonic packing: pieces of documents go to reciprocal-capacity classes, each with a fixed number of pieces in a sequence.

A piece of length n belongs to class capacity // n; a sequence of class j holds j of its pieces. From class MANY on only powers of two
are classes, so that there are few. A document gives off whole capacities; what is left stays one piece, or gives off at most CUTS pieces of
capacity // k tokens, which fill class k without padding, and leaves at least `least` tokens. Of these ways that with the least padding is
taken, where a cut counts as CUT tokens; so no document is cut into crumbs.

Each task fills its own bins and numbers them by task, so workers need nothing of each other and nothing is shuffled or gathered: a task
leaves at most one part-filled bin of each class, of some twenty. A task that is run again reads the same rows and makes the same bins. Null
and empty texts have the end id alone; repeated rows are packed each; a null id stays null; extra columns are ignored; memory follows the longest
single text.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CAPACITY = 1024
LEAST = 32
MANY = 16
CUT, CUTS = 4.0, 2
END_ID = 0
SPECIAL = "<|endoftext|>"


def vocabulary() -> tuple[str, str, str]:
    """Default files: the tokenizer, the same vocabulary as ranks, the pattern of its words."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def _encoder(files: tuple[str, str, str]):
    """Text -> ids. Ranks give the tokenizer's own ids several times faster; a text with its special token's string goes to the tokenizer itself."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(files[1]).read_bytes().splitlines())}
    fast = tiktoken.Encoding("ranks", pat_str=files[2], mergeable_ranks=ranks, special_tokens={})
    slow: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            if not slow:
                slow.append(Tokenizer.from_file(files[0]))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), "<u4")

    return encode


def class_of(length: int, capacity: int = CAPACITY) -> int:
    """How many pieces of this length, or of any longer one of its class, a sequence holds."""
    j = capacity // length
    return j if j < MANY else 1 << (j.bit_length() - 1)


def _padding(length: int, capacity: int) -> float:
    """A piece's share of the empty places in a full sequence of its class."""
    return capacity / class_of(length, capacity) - length


@lru_cache(maxsize=16384)
def _rest(tokens: int, capacity: int, least: int, cuts: int = CUTS) -> tuple[float, int, tuple[int, ...]]:
    """(cost, pieces, lengths) of the way with the least padding; of equal ones the fewest pieces, then the longest first piece."""
    best = (_padding(tokens, capacity), 1, (tokens,))
    for k in range(capacity // tokens + 1, MANY) if cuts else ():
        first = capacity // k
        if first >= least and tokens - first >= least:
            cost, pieces, lengths = _rest(tokens - first, capacity, least, cuts - 1)
            best = min(best, (cost + _padding(first, capacity) + CUT, pieces + 1, (first, *lengths)), key=lambda w: (w[0], w[1], -w[2][0]))
    return best


def cut(tokens: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of a document's pieces, in order."""
    out = [capacity] * (tokens // capacity)
    return [*out, *_rest(tokens % capacity, capacity, least)[2]] if tokens % capacity else out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class long"
ROWS = 20_000


def _pieces(batches, files, capacity: int, least: int, with_ids: bool):
    encode, task = _encoder(files), TaskContext.get().partitionId()
    number, at = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)  # of each class: pieces so far, tokens in its open bin
    rows, ids_out = [], []

    def batch_of():
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64()) for _ in range(8)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"]
        if with_ids:
            columns, names = [*columns, pa.array(ids_out, pa.list_(pa.int32()))], [*names, "ids"]
        out = pa.record_batch(columns, names=names)
        rows.clear()
        ids_out.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.append(encode(text), np.uint32(END_ID)).astype("<u4") if text else np.array([END_ID], "<u4")
            start = 0
            for length in cut(len(ids), capacity, least):
                own, j = ids[start : start + length], class_of(length, capacity)
                if number[j] % j == 0:
                    at[j] = 0
                sequence = (task << 40) + int(number[j] // j) * (capacity + 1) + j
                rows.append((doc_id, start, length, zlib.crc32(own.tobytes()), len(ids), sequence, int(at[j]), j))
                if with_ids:
                    ids_out.append(own.astype(np.int32).tolist())
                number[j] += 1
                at[j] += length
                start += length
            if len(rows) >= ROWS:
                yield batch_of()
        yield batch_of()


def packed(docs: DataFrame, capacity: int = CAPACITY, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, class, and with_ids its ids."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return read.mapInArrow(partial(_pieces, files=files or vocabulary(), capacity=capacity, least=least, with_ids=with_ids), schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """sequence_id, ids, tokens: the packed sequences of pieces with ids, padded to the capacity except at a power of two."""
    held = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("all"))
    ids = F.flatten(F.col("all.ids"))
    held = held.select("sequence_id", ids.alias("ids"), F.size(ids).alias("tokens"))
    exact = F.bit_count("tokens") == 1
    return held.select("sequence_id", F.when(exact, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.col("tokens")))).alias("ids"), "tokens")
