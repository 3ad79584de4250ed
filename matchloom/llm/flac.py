"""FLAC in numpy: many frames are coded or decoded in step, sample by sample, so that Python's cost is per sample number, not per sample.

The decoder reads any FLAC stream of 4 to 24 bits: constant, verbatim, fixed and linear predictors, Rice residuals of both
methods with escapes, wasted bits and stereo decorrelation. It finds frames by sync code and header CRC-8, and accepts
a frame only if the CRC-16 over all its bytes holds; the MD5 of all samples is compared too. The encoder writes mono streams of
8-bit samples in blocks of BLOCK, each frame with the cheapest of constant, verbatim, fixed (order 0 to 2) and linear prediction
(order LPC), and a seek point for every SEEK frames.

Work is bounded by FRAMES frames at a time, also within one stream. Anything that isn't a FLAC stream, and any checksum that
doesn't hold, raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

BLOCK = 576
PARTITION_ORDER = 2
LPC, PRECISION, SHIFT = 4, 8, 6
SEEK = 16
FRAMES = 2000
U = np.uint64


@lru_cache(maxsize=2)
def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        out = ((out << 1) ^ np.where(out >> (bits - 1), poly, 0)) & ((1 << bits) - 1)
    return out


def crc8(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    table, crc = _crc_table(0x07, 8), np.zeros(len(starts), np.int64)
    for i in range(int(sizes.max(initial=0))):
        on = i < sizes
        crc = np.where(on, table[crc ^ data[np.where(on, starts + i, 0)]], crc)
    return crc


def crc16(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-16 of each stretch, all in step; stretches are taken longest first, so each step looks at those that go on."""
    table, order = _crc_table(0x8005, 16), np.argsort(-sizes, kind="stable")
    crc, at, size = np.zeros(len(starts), np.int64), starts[order], sizes[order]
    going = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
    for i, n in enumerate(going.tolist()):
        c = crc[:n]
        crc[:n] = table[(c >> 8) ^ data[at[:n] + i]] ^ ((c << 8) & 0xFFFF)
    out = np.empty_like(crc)
    out[order] = crc
    return out


def coded_number(n: int) -> bytes:
    """A frame or sample number, coded as UTF-8 codes characters, to 36 bits."""
    if n < 0x80:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    tail = [0x80 | (n >> (6 * i) & 0x3F) for i in range(size - 1)][::-1]
    return bytes([(0xFF00 >> size & 0xFF) | n >> (6 * (size - 1))] + tail)


# ---- encoder -------------------------------------------------------------------------------------------------------------


def _linear(x: np.ndarray) -> np.ndarray:
    """Quantised predictor coefficients of each frame, by Levinson's recursion on the windowed autocorrelation."""
    w = x * np.hanning(x.shape[1] + 2)[1:-1]
    auto = np.stack([(w[:, : x.shape[1] - k] * w[:, k:]).sum(axis=1) for k in range(LPC + 1)])
    auto[0] = auto[0] * 1.0001 + 1e-9
    coef, error = np.zeros((LPC, len(x))), auto[0].copy()
    for i in range(LPC):
        k = (auto[i + 1] - sum(coef[j] * auto[i - j] for j in range(i))) / error
        old = coef[:i].copy()
        coef[:i] -= k * old[::-1]
        coef[i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    top = 1 << (PRECISION - 1)
    return np.clip(np.rint(coef * (1 << SHIFT)), -top, top - 1).astype(np.int32).T


def _rice(residual: np.ndarray, order: int):
    """Unsigned residuals, each partition's parameter, each residual's parameter, and the bits of all."""
    u = (residual << 1) ^ (residual >> 31)
    width = BLOCK >> PARTITION_ORDER
    cuts = np.r_[0, np.arange(width, BLOCK, width) - order]
    sizes = np.diff(np.r_[cuts, BLOCK - order])
    mean = np.add.reduceat(u, cuts, axis=1) / sizes
    k = np.clip(np.ceil(np.log2(np.maximum(mean * 0.69, 1e-9))), 0, 14).astype(np.int32)
    each = np.repeat(k, sizes, axis=1)
    return u, k, each, ((u >> each) + 1 + each).sum(axis=1, dtype=np.int64) + 4 * len(sizes) + 6


def _frames(x: np.ndarray, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the sizes of frames of BLOCK samples: x is one row of signed samples per frame."""
    coef = _linear(x)
    ahead = sum(coef[:, [j]] * x[:, LPC - 1 - j : BLOCK - 1 - j] for j in range(LPC)) >> SHIFT
    once = np.diff(x, axis=1)
    tried = [(8, 0, x), (9, 1, once), (10, 2, np.diff(once, axis=1)), (31 + LPC, LPC, x[:, LPC:] - ahead)]
    coded = [(kind, order, *_rice(r, order)) for kind, order, r in tried]
    bits = [np.where((x == x[:, :1]).all(axis=1), 16, 1 << 30), np.full(len(x), 8 + 8 * BLOCK)]
    bits += [8 + 8 * order + (9 + PRECISION * order if kind > 31 else 0) + c for kind, order, *_, c in coded]
    best = np.argmin(np.stack(bits), axis=0)
    bits = np.stack(bits)[best, np.arange(len(x))]
    heads = [b"\xff\xf8\x20\x02" + coded_number(n) for n in numbers]
    head = np.array([len(h) + 1 for h in heads])
    sizes = head + -(-bits // 8) + 2
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()) * 8, np.uint8)
    at = (starts + head) * 8

    def put(where: np.ndarray, value: np.ndarray | int, width: int) -> None:
        value = np.asarray(value)
        for i in range(width):
            out[where + i] = (value >> (width - 1 - i)) & 1

    for which, kind in ((0, 0), (1, 1)):
        rows = np.flatnonzero(best == which)
        put(at[rows], kind << 1, 8)
        n = 1 if which == 0 else BLOCK
        put(at[rows][:, None] + 8 + 8 * np.arange(n), x[rows, :n] & 255, 8)
    for which, (kind, order, u, k, each, _) in enumerate(coded, 2):
        rows = np.flatnonzero(best == which)
        if not len(rows):
            continue
        u, k, each, p = u[rows], k[rows], each[rows], at[rows]
        put(p, kind << 1, 8)
        put(p[:, None] + 8 + 8 * np.arange(order), x[rows, :order] & 255, 8)
        p = p + 8 + 8 * order
        if kind > 31:
            put(p, (PRECISION - 1) << 5 | SHIFT, 9)
            put(p[:, None] + 9 + PRECISION * np.arange(order), coef[rows] & ((1 << PRECISION) - 1), PRECISION)
            p = p + 9 + PRECISION * order
        put(p, PARTITION_ORDER, 6)
        quotient = u >> each
        size = quotient + 1 + each
        width = BLOCK >> PARTITION_ORDER
        cuts = np.r_[0, np.arange(width, BLOCK, width) - order]
        part = np.searchsorted(cuts, np.arange(BLOCK - order), side="right")
        begin = p[:, None] + 6 + np.cumsum(size, axis=1, dtype=np.int64) - size + 4 * part
        put(begin[:, cuts] - 4, k, 4)
        stop = begin + quotient
        out[stop] = 1
        for b in range(int(k.max(initial=0))):
            on = each > b
            out[(stop + each - b)[on]] = (u[on] >> b) & 1
    data = np.packbits(out)
    for n in np.unique(head).tolist():
        rows = np.flatnonzero(head == n)
        data[starts[rows][:, None] + np.arange(n - 1)] = np.frombuffer(b"".join(heads[i] for i in rows.tolist()), np.uint8).reshape(-1, n - 1)
    data[starts + head - 1] = crc8(data, starts, head - 1)
    tail = crc16(data, starts, sizes - 2)
    data[starts + sizes - 2], data[starts + sizes - 1] = tail >> 8, tail & 255
    return data, sizes


def _short_frame(samples: np.ndarray, number: int) -> bytes:
    """A last frame of fewer samples, verbatim."""
    head = b"\xff\xf8\x70\x02" + coded_number(number) + struct.pack(">H", len(samples) - 1)
    one = lambda data: (np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))
    body = head + bytes([int(crc8(*one(head))[0])]) + b"\x02" + samples.astype(np.int8).tobytes()
    return body + struct.pack(">H", int(crc16(*one(body))[0]))


def encode(payloads: list[bytes], rate: int = 8000) -> list[bytes]:
    """A FLAC stream for each payload; a byte b is the 8-bit sample b - 128."""
    counts = [len(p) // BLOCK for p in payloads]
    whole = [(i, n) for i, c in enumerate(counts) for n in range(c)]
    parts: list[list[bytes]] = [[] for _ in payloads]
    sizes: list[list[int]] = [[] for _ in payloads]
    for a in range(0, len(whole), FRAMES):
        run = whole[a : a + FRAMES]
        samples = np.frombuffer(b"".join(payloads[i][n * BLOCK : (n + 1) * BLOCK] for i, n in run), np.uint8).astype(np.int32) - 128
        data, size = _frames(samples.reshape(-1, BLOCK), [n for _, n in run])
        data, ends = data.tobytes(), np.cumsum(size).tolist()
        for (i, _), e, s in zip(run, ends, size.tolist(), strict=True):
            parts[i].append(data[e - s : e])
            sizes[i].append(s)
    out = []
    for payload, part, size in zip(payloads, parts, sizes, strict=True):
        signed = (np.frombuffer(payload, np.uint8) ^ 128).view(np.int8)
        if rest := len(payload) % BLOCK:
            part.append(_short_frame(signed[-rest:], len(part)))
        seek = np.zeros(-(-len(size) // SEEK), [("sample", ">u8"), ("offset", ">u8"), ("samples", ">u2")])
        seek["sample"], seek["samples"] = np.arange(len(seek)) * SEEK * BLOCK, BLOCK
        seek["offset"] = np.r_[0, np.cumsum(size)][: len(size) : SEEK]
        lengths = [len(x) for x in part] or [0]
        info = struct.pack(">HH", BLOCK, BLOCK) + min(lengths).to_bytes(3, "big") + max(lengths).to_bytes(3, "big") + (rate << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big")
        info += hashlib.md5(signed.tobytes()).digest()
        table = seek.tobytes()
        out.append(b"fLaC" + b"\x00\x00\x00\x22" + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(part))
    return out


# ---- decoder -------------------------------------------------------------------------------------------------------------


@dataclass
class Stream:
    """What a stream's metadata says, and its frames: where each starts, and its first sample."""

    rate: int
    channels: int
    bits: int
    total: int
    md5: bytes
    first: int
    block: int
    seek: list[tuple[int, int, int]] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    samples: list[int] = field(default_factory=list)
    pcm: np.ndarray | None = None


def metadata(data: bytes) -> Stream:
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, stream = 4, False, None
    while not last:
        if at + 4 > len(data):
            raise ValueError("the metadata breaks off")
        last, kind, size = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        if kind == 0:
            facts = int.from_bytes(body[10:18], "big")
            stream = Stream(facts >> 44, (facts >> 41 & 7) + 1, (facts >> 36 & 31) + 1, facts & (1 << 36) - 1, body[18:34], 0, int.from_bytes(body[:2], "big"))
        elif kind == 3 and stream:
            stream.seek = [p for p in struct.iter_unpack(">QQH", body) if p[0] != (1 << 64) - 1]
        at += 4 + size
    if stream is None:
        raise ValueError("no stream information")
    stream.first = at
    return stream


def _header(data: bytes, at: int, stream: Stream):
    """(block size, channel code, bits, number, size of the header, variable) if a frame header stands there and its CRC-8 holds."""
    if at + 6 > len(data) or data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8 or data[at + 3] & 1:
        return None
    block, rate, code, width = data[at + 2] >> 4, data[at + 2] & 15, data[at + 3] >> 4, data[at + 3] >> 1 & 7
    if block == 0 or rate == 15 or code > 10 or width == 3:
        return None
    lead, p = data[at + 4], at + 5
    number = lead
    if lead & 0x80:
        more = next((k for k in range(1, 7) if not lead >> (6 - k) & 1), 7) if lead & 0x40 else 0
        if not 1 <= more <= 6 or p + more > len(data):
            return None
        number = lead & (0x3F >> more)
        for b in data[p : p + more]:
            number = number << 6 | b & 0x3F
        p += more
    if block in (6, 7):
        size = int.from_bytes(data[p : p + block - 5], "big") + 1
        p += block - 5
    else:
        size = 192 if block == 1 else 576 << (block - 2) if block < 6 else 256 << (block - 8)
    p += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    crc, table = 0, _crc8_list()
    for b in data[at:p]:
        crc = table[crc ^ b]
    if p >= len(data) or crc != data[p]:
        return None
    return size, code, (stream.bits, 8, 12, 0, 16, 20, 24, 32)[width], number, p + 1 - at, data[at + 1] & 1


@lru_cache(maxsize=1)
def _crc8_list() -> list[int]:
    return _crc_table(0x07, 8).tolist()


def _candidates(data: bytes, stream: Stream) -> list[tuple]:
    """(position, header) of all that looks like a frame header."""
    raw = np.frombuffer(data, np.uint8)
    near = np.flatnonzero((raw[stream.first : -1] == 0xFF) & (raw[stream.first + 1 :] & 0xFE == 0xF8)) + stream.first
    found = [(p, h) for p in near.tolist() if (h := _header(data, p, stream))]
    if (not found and len(data) > stream.first) or (found and found[0][0] != stream.first):
        raise ValueError("no frame header where the frames should begin")
    return found


def _locate(files: list[bytes], streams: list[Stream]) -> list[list[tuple]]:
    """(start, header) of all frames; only stretches whose CRC-16 holds are frames, whatever their bytes look like."""
    found = [_candidates(data, s) for data, s in zip(files, streams, strict=True)]
    base = np.cumsum([0, *map(len, files)])
    raw = np.frombuffer(b"".join(files), np.uint8)
    starts = np.array([base[n] + p for n, own in enumerate(found) for p, _ in own], np.int64)
    ends = np.array([e for n, own in enumerate(found) for e in [*(base[n] + p for p, _ in own[1:]), *([base[n + 1]] if own else [])]], np.int64)
    right = np.concatenate([crc16(raw, starts[a : a + FRAMES], (ends - starts)[a : a + FRAMES]) for a in range(0, len(starts), FRAMES)] or [starts]) == 0
    out, at = [], 0
    for own in found:
        first, last = starts[at : at + len(own)], ends[at : at + len(own)]
        if right[at : at + len(own)].all():
            out.append(own)
        else:
            out.append([])
            i = 0
            while i < len(own):
                j = next((j for j in range(i, len(own)) if crc16(raw, first[i : i + 1], last[j : j + 1] - first[i : i + 1])[0] == 0), None)
                if j is None:
                    raise ValueError(f"the checksum of the frame at byte {own[i][0]} does not hold")
                out[-1].append(own[i])
                i = j + 1
        at += len(own)
    return out


def _windows(data: np.ndarray) -> np.ndarray:
    """At each byte, it and the seven after it as one number."""
    wide = np.r_[data, np.zeros(16, np.uint8)]
    out = np.zeros(len(wide) - 7, U)
    for i in range(8):
        out = (out << U(8)) | wide[i : len(wide) - 7 + i]
    return out


def _peek(win: np.ndarray, pos: np.ndarray, n) -> np.ndarray:
    """n bits (1 to 57; a number, or one for each) from each bit position."""
    return ((win[pos >> 3] << (pos & 7).astype(U)) >> (U(64) - np.asarray(n).astype(U))).astype(np.int64)


def _signed(v: np.ndarray, n) -> np.ndarray:
    return v - ((v >> (n - 1)) << n)


@lru_cache(maxsize=1)
def _zeros16() -> np.ndarray:
    """Zeros before the first one of 16 bits."""
    return np.r_[16, 15 - np.floor(np.log2(np.arange(1, 1 << 16)))].astype(np.int64)


def _unary(win: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Number of zeros before the next one."""
    q = _zeros16()[_peek(win, pos, 16)]
    on = np.flatnonzero(q == 16)
    while len(on):
        if (pos[on] + q[on] >> 3).max() >= len(win) - 2:
            raise ValueError("a residual breaks off")
        more = _zeros16()[_peek(win, pos[on] + q[on], 16)]
        q[on] += more
        on = on[more == 16]
    return q


def _residuals(win: np.ndarray, pos: np.ndarray, block: int, order: int, out: np.ndarray) -> np.ndarray:
    """Decodes Rice residuals into out (a row per sample number); returns the positions after them."""
    head = _peek(win, pos, 6)
    end = np.empty_like(pos)
    for h in np.unique(head).tolist():
        own = np.flatnonzero(head == h)
        method, parts = h >> 4, 1 << (h & 15)
        if method > 1 or block % parts or block // parts < order:
            raise ValueError("a residual of no known kind")
        p, width = pos[own] + 6, 4 + method
        for part in range(parts):
            k = _peek(win, p, width)
            p = p + width
            raw = k == (1 << width) - 1
            size = np.where(raw, _peek(win, p, 5), 0)
            p = p + 5 * raw
            some, low = raw.any(), (U(63) - k.astype(U))
            for i in range(order if part == 0 else part * (block // parts), (part + 1) * (block // parts)):
                w = win[p >> 3] << (p & 7).astype(U)
                q = _zeros16()[(w >> U(48)).astype(np.int64)]
                if (q == 16).any():
                    q = _unary(win, p) if not some else np.where(raw, 0, _unary(win, np.where(raw, 0, p)))
                    rest = (win[p + q + 1 >> 3] << (p + q + 1 & 7).astype(U)) >> low >> U(1)
                else:
                    rest = (w << (q + 1).astype(U)) >> low >> U(1)
                u = (q << k) | rest.astype(np.int64)
                value = (u >> 1) ^ -(u & 1)
                step = q + 1 + k
                if some:
                    value = np.where(raw, np.where(size > 0, _signed(_peek(win, p, np.maximum(size, 1)), np.maximum(size, 1)), 0), value)
                    step = np.where(raw, size, step)
                out[i, own] = value
                p = p + step
        end[own] = p
    return end


FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def _subframes(win: np.ndarray, pos: np.ndarray, block: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples (a row per sample number) of one channel of all frames, and the positions after it."""
    head = _peek(win, pos, 8)
    wasted = np.where(head & 1, _unary(win, pos + 8) + 1, 0)
    end, samples = np.empty_like(pos), np.zeros((block, len(pos)), np.int64)
    for key in np.unique(head << 8 | wasted).tolist():
        own, kind, lost = np.flatnonzero((head << 8 | wasted) == key), key >> 9, key & 255
        p, width = pos[own] + 8 + lost, bits - lost
        x = np.zeros((block, len(own)), np.int64)
        if kind == 0:
            x[:] = _signed(_peek(win, p, width), width)
            p = p + width
        elif kind == 1:
            for i in range(block):
                x[i] = _signed(_peek(win, p + i * width, width), width)
            p = p + block * width
        elif 8 <= kind <= 12 or kind >= 32:
            order = kind - 8 if kind <= 12 else kind - 31
            for i in range(order):
                x[i] = _signed(_peek(win, p + i * width, width), width)
            p = p + order * width
            if kind >= 32:
                precision, shift = _peek(win, p, 4) + 1, _signed(_peek(win, p + 4, 5), 5)
                p = p + 9
                coef = [_signed(_peek(win, p + j * precision, precision), precision) for j in range(order)]
                p = p + order * precision
            else:
                coef, shift = FIXED[order], np.zeros(len(own), np.int64)
            p = _residuals(win, p, block, order, x)
            for i in range(order, block) if order else ():
                ahead = coef[0] * x[i - 1]
                for j in range(1, order):
                    ahead += coef[j] * x[i - 1 - j]
                x[i] += ahead >> shift
        else:
            raise ValueError("a subframe of no known kind")
        samples[:, own], end[own] = x << lost, p
    return samples, end


def _decode_frames(win: np.ndarray, pos: np.ndarray, block: int, code: int, bits: int) -> np.ndarray:
    """Samples (frame, sample number, channel)."""
    channels = []
    for c in range(code + 1 if code < 8 else 2):
        side = (code in (8, 10) and c == 1) or (code == 9 and c == 0)
        x, pos = _subframes(win, pos, block, bits + side)
        channels.append(x)
    if code == 8:
        channels[1] = channels[0] - channels[1]
    elif code == 9:
        channels[0] = channels[0] + channels[1]
    elif code == 10:
        middle, side = (channels[0] << 1) | (channels[1] & 1), channels[1]
        channels = [(middle + side) >> 1, (middle - side) >> 1]
    return np.stack(channels).transpose(2, 1, 0)


def decode(files: list[bytes]) -> list[Stream]:
    """All streams with their frames' offsets, first samples and pcm (sample, channel), every checksum verified."""
    streams, frames = [metadata(x) for x in files], []
    for n, (stream, found) in enumerate(zip(streams, _locate(files, streams), strict=True)):
        at = 0
        for start, h in found:
            stream.offsets.append(start)
            stream.samples.append(at)
            if h[3] != (at if h[5] else len(stream.offsets) - 1):
                raise ValueError(f"the frame at byte {start} has another number")
            frames.append((n, start, at, h))
            at += h[0]
        if stream.total and at != stream.total:
            raise ValueError("frames are missing")
        stream.pcm = np.zeros((at, stream.channels), np.int32)
    kinds: dict[tuple, list] = {}
    for f in frames:
        kinds.setdefault(f[3][:3], []).append(f)
    for (block, code, bits), own in kinds.items():
        for a in range(0, len(own), FRAMES):
            run = own[a : a + FRAMES]
            spans = [files[n][start : start + block * (bits + 2) * (code + 1 if code < 8 else 2) // 8 + 64] for n, start, _, _ in run] if len(files) > 1 or len(run) < len(frames) else None
            if spans is None:
                win, pos = _windows(np.frombuffer(files[0], np.uint8)), np.array([s for _, s, _, _ in run])
            else:
                sizes = np.array([len(s) for s in spans])
                win, pos = _windows(np.frombuffer(b"".join(spans), np.uint8)), np.cumsum(sizes) - sizes
            got = _decode_frames(win, (pos + np.array([h[4] for *_, h in run])) * 8, block, code, bits)
            for (n, _, at, _), x in zip(run, got, strict=True):
                streams[n].pcm[at : at + block] = x
    for stream in streams:
        wide = -(-stream.bits // 8)
        signed = stream.pcm.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :wide].tobytes()
        if any(stream.md5) and hashlib.md5(signed).digest() != stream.md5:
            raise ValueError("the MD5 of the samples does not hold")
    return streams


def seek_frame(stream: Stream, sample: int) -> tuple[int, int]:
    """(byte offset, first sample) of the frame that holds a sample, from the frames found; without them, of the last seek point before it."""
    if stream.samples:
        i = int(np.searchsorted(stream.samples, sample, side="right")) - 1
        return stream.offsets[i], stream.samples[i]
    before = [p for p in stream.seek if p[0] <= sample]
    return (stream.first + before[-1][1], before[-1][0]) if before else (stream.first, 0)
