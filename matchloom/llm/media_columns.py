"""FLAC media columns: bytes are stored as FLAC streams of 8-bit samples, and read back as PCM blocks with sample offsets.

A byte's sample is its place in an order of all bytes, `frequent` first and the others by value, counted outwards from silence: 0, -1, 1, -2, ... Frequent letters become
quiet samples, so that prediction leaves small residuals and a text takes some 0.7 of its bytes instead of 0.9. The order is a parameter, reversible, and no part of the stream.

`encoded` and `pcm_blocks` work on a column of binary media; each row is coded on its own, many frames at a time, so nothing is
shuffled. `stored` writes the column as a table in the shared folder, so that a lost executor's streams are read again and not made again. `digests` reads a stored stream back as the same PCM blocks, in order, and works out all facts on the payload from them. A null or empty text is the padding alone; repeated rows give equal streams; extra columns are ignored. Memory follows
the longest single text.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flac
from .common import Scratch, exact_binary, slices, utf8

PAD = 255
#: Bytes of frequent letters and signs in texts with Latin letters; any order gives the payload back.
FREQUENT = b" etaonirshdlucmpfgwybvk.,\n"
SLICE_BYTES = 1_200_000
SAMPLES = 64 * flac.BLOCK


def sample_of(frequent: bytes) -> np.ndarray:
    """For each byte its unsigned 8-bit sample: 128 is silence."""
    order = np.array(list(dict.fromkeys([*frequent, *range(256)])), np.int64)
    place = np.arange(256)
    out = np.zeros(256, np.uint8)
    out[order] = 128 + np.where(place % 2 == 0, place // 2, -(place // 2) - 1)
    return out


def payload_of(pcm: bytes, frequent: bytes = FREQUENT) -> bytes:
    """The bytes of signed 8-bit samples as pcm_blocks gives them."""
    return np.argsort(sample_of(frequent)).astype(np.uint8)[np.frombuffer(pcm, np.int8).astype(np.int64) + 128].tobytes()


def _encode(batches, unit: int, frequent: bytes):
    sample = sample_of(frequent)
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in slices(offsets, SLICE_BYTES):
            payloads, sizes = [], np.diff(offsets[a : b + 1])
            for i, n in zip(range(a, b), sizes.tolist(), strict=True):
                payloads.append(sample[data[offsets[i] : offsets[i + 1]]].tobytes() + sample[[PAD]].tobytes() * (max(unit, -(-n // unit) * unit) - n))
            yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), exact_binary(flac.encode(payloads))], names=["doc_id", "n_bytes", "media"])


def encoded(docs: DataFrame, unit: int = flac.BLOCK, id_col: str = "doc_id", text_col: str = "text", frequent: bytes = FREQUENT) -> DataFrame:
    """doc_id, n_bytes and media: each text's UTF-8 bytes, padded with byte 255 to a positive multiple of unit, as a FLAC stream."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(partial(_encode, unit=unit, frequent=frequent), "doc_id long, n_bytes long, media binary")


def stored(media: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of `encoded`, written and read back. FLAC streams don't compress, so the files aren't compressed again."""
    path = f"{scratch.root}/media"
    media.write.option("compression", "uncompressed").parquet(path)
    return media.sparkSession.read.schema(media.schema).parquet(path)


def _runs(batch: pa.RecordBatch, column: int):
    """Ranges of rows with some MB of media, decoded."""
    media = batch.column(column)
    _, offsets = utf8(media)
    for a, b in slices(offsets, SLICE_BYTES):
        files = media.slice(a, b - a).to_pylist()
        yield a, b, files, flac.decode([x or b"" for x in files])


def _pcm(s: flac.Stream, samples: int):
    """A stream's blocks in order: first sample, number of samples, where to start reading (byte, that frame's first sample), PCM bytes."""
    wide = -(-s.bits // 8)
    for at in range(0, len(s.pcm), samples):
        x = s.pcm[at : at + samples]
        yield at, len(x), *flac.seek_frame(s, at), x.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :wide].tobytes()


def _blocks(batches, samples: int):
    schema = pa.schema([("doc_id", pa.int64()), ("first_sample", pa.int64()), ("n_samples", pa.int64()), ("frame_offset", pa.int64()), ("frame_sample", pa.int64()), ("pcm", pa.binary())])
    for batch in batches:
        for a, _, _, streams in _runs(batch, 1):
            rows = [(batch.column(0)[a + i].as_py(), *block) for i, s in enumerate(streams) for block in _pcm(s, samples)]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def pcm_blocks(media: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per block of samples: doc_id, first_sample, n_samples, pcm (signed, little-endian, channels interleaved; payload_of gives the bytes), and where to
    start reading the stream for it: frame_offset (byte) and frame_sample (that frame's first sample). Rows without media have none."""
    read = media.where(F.col(media_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(media_col).alias("media"))
    return read.mapInArrow(partial(_blocks, samples=samples), "doc_id long, first_sample long, n_samples long, frame_offset long, frame_sample long, pcm binary")


class _Facts:
    """Facts on a payload, from its PCM blocks of signed 8-bit samples as they come. byte: the byte of each unsigned sample."""

    def __init__(self, byte: np.ndarray):
        self.byte = byte
        self.hash, self.tail, self.size, self.last = hashlib.sha256(), b"", 0, None
        self.peak = self.total = self.energy = self.crossings = 0

    def add(self, pcm: bytes) -> None:
        x = np.frombuffer(pcm, np.int8).astype(np.int64)
        payload = self.byte[x + 128].tobytes()
        self.hash.update(payload)
        self.tail, self.size = (self.tail + payload)[-32:], self.size + len(payload)
        below = x < 0
        self.crossings += int((below[1:] != below[:-1]).sum()) + (self.last is not None and bool(below[0]) != self.last)
        self.last = bool(below[-1])
        self.peak, self.total, self.energy = max(self.peak, int(np.abs(x).max())), self.total + int(x.sum()), self.energy + int((x * x).sum())

    def row(self) -> tuple:
        feature = f"samples={self.size};peak={self.peak};sum={self.total};energy={self.energy};crossings={self.crossings}"
        return self.size, self.hash.hexdigest(), zlib.crc32(self.tail), feature


def _digests(batches, samples: int, frequent: bytes):
    byte = np.argsort(sample_of(frequent)).astype(np.uint8)
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "blocks", "last_block_frame_offset"]
    for batch in batches:
        for a, b, files, streams in _runs(batch, 2):
            rows = []
            for file, s in zip(files, streams, strict=True):
                facts, blocks, offset = _Facts(byte), 0, 0
                for at, _, offset, _, pcm in _pcm(s, samples):
                    if at != facts.size:
                        raise ValueError("blocks are not gapless")
                    facts.add(pcm)
                    blocks += 1
                size, digest, tail, feature = facts.row()
                rows.append((size, digest, tail, len(file), hashlib.sha256(file).hexdigest(), feature, len(s.offsets), blocks, offset))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=names)


def digests(media: DataFrame, samples: int = SAMPLES, frequent: bytes = FREQUENT) -> DataFrame:
    """From `encoded` rows of one 8-bit channel: facts on the payload as its PCM blocks are read back from the stream in order, on the stream, and the
    number of blocks with the byte of the frame where the last one starts."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames long, blocks long, last_block_frame_offset long"
    return media.mapInArrow(partial(_digests, samples=samples, frequent=frequent), schema)
