"""FLAC round trips and damage, packing invariants, the archive, preference formatting."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import verify
from matchloom.llm import content_archive, flac, harmonic_packing, media_columns, preference_format
from matchloom.llm.common import Scratch
from matchloom.llm.queries import QUERIES
from matchloom.llm.sql import ORACLE

TEXTS = [(1, "plain text " * 300), (2, None), (3, ""), (4, "é" * 5000), (4, "é" * 5000), (None, "x"), (5, "a" * 576), (6, "<|endoftext|> and \n\n more"), (7, "z" * 200_000)]


def docs(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"media": F.lit("clash"), "class": F.lit(9), "key": F.lit("clash")})


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=3000), st.integers(0, 4000).map(lambda n: bytes(n)), st.integers(1, 4000).map(lambda n: (128 + 90 * np.sin(np.arange(n) / 7)).astype(np.uint8).tobytes())), max_size=5))
def test_flac_round_trip(payloads):
    for p, s in zip(payloads, flac.decode(flac.encode(payloads)), strict=True):
        assert (s.pcm[:, 0] + 128).astype(np.uint8).tobytes() == p and s.total == len(p)


def test_flac_damage_and_seeking():
    payload = np.random.default_rng(0).integers(90, 140, 576 * 40, dtype=np.uint8).tobytes()
    (file,) = flac.encode([payload])
    (s,) = flac.decode([file])
    offset, first = flac.seek_frame(s, 576 * 20 + 5)
    assert first == 576 * 20 and file[offset : offset + 2] == b"\xff\xf8"
    blank = flac.metadata(file)
    assert flac.seek_frame(blank, 576 * 20)[1] == 576 * 16 and flac.seek_frame(blank, 576 * 20)[0] == s.offsets[16]
    for at in (60, len(file) // 2, len(file) - 1):
        bad = bytearray(file)
        bad[at] ^= 1
        if at > blank.first:
            with pytest.raises(ValueError):
                flac.decode([bytes(bad)])
    with pytest.raises(ValueError):
        flac.decode([b"RIFF"])


def _bits(*fields):
    out = "".join(format(v & ((1 << w) - 1), f"0{w}b") for v, w in fields)
    out += "0" * (-len(out) % 8)
    return bytes(int(out[i : i + 8], 2) for i in range(0, len(out), 8))


def test_flac_stereo_escape_and_wasted_bits():
    """A hand-made 16-bit mid/side frame: fixed predictor with an escaped partition, and a verbatim side channel with a wasted bit."""
    middle, side = [10, 12, 15, 11] + [7] * 12, [4, -6, 2, 0] * 4
    head = b"\xff\xf8\x60\xa8\x00\x0f"  # block size in one byte (16), mid/side, 16 bits
    crc = lambda f, x: int(f(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0])
    head += bytes([crc(flac.crc8, head)])
    residual = np.diff(middle)
    fields = [(0x12, 8), (middle[0], 16), (0, 6), (15, 4), (8, 5), *((int(r), 8) for r in residual), (0x03, 8), (1, 1), *((x >> 1, 16) for x in side)]
    body = head + _bits(*fields)
    body += crc(flac.crc16, body).to_bytes(2, "big")
    left, right = [(2 * m + (s & 1) + s) >> 1 for m, s in zip(middle, side, strict=True)], [(2 * m + (s & 1) - s) >> 1 for m, s in zip(middle, side, strict=True)]
    pcm = np.array([left, right], "<i2").T.tobytes()
    info = (16).to_bytes(2, "big") * 2 + bytes(6) + (44100 << 44 | 1 << 41 | 15 << 36 | 16).to_bytes(8, "big") + hashlib.md5(pcm).digest()
    (s,) = flac.decode([b"fLaC\x80\x00\x00\x22" + info + body])
    assert s.pcm[:, 0].tolist() == left and s.pcm[:, 1].tolist() == right


def test_media_digests(spark):
    media = media_columns.encoded(docs(spark))
    want = []
    for doc_id, text in TEXTS:
        raw = (text or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        want.append((doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])))
    got = [tuple(r)[:5] for r in media_columns.digests(media).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    blocks = media_columns.pcm_blocks(media.where("doc_id = 7"), samples=5760).orderBy("first_sample").collect()
    assert media_columns.payload_of(b"".join(bytes(b.pcm) for b in blocks))[:200_000] == b"z" * 200_000
    kept = media_columns.stored(media, Scratch(spark, "t"))
    again = [tuple(r)[:5] for r in media_columns.digests(kept).collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr) and not any("snappy" in f for f in kept.inputFiles())
    plain = media_columns.digests(media_columns.encoded(docs(spark), frequent=b""), frequent=b"").collect()
    assert [tuple(r)[:5] for r in plain] == got  # any order of the bytes gives the payload back
    assert sorted(media_columns.sample_of(b"zz\xff")) == list(range(256)) and media_columns.sample_of(b"ab")[[97, 98, 0]].tolist() == [128, 127, 129]
    assert media_columns.digests(media_columns.encoded(docs(spark).limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 5000))
def test_cut(n):
    pieces = harmonic_packing.cut(n)
    assert sum(pieces) == n and all(0 < p <= 1024 for p in pieces)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_ranks_give_the_tokenizers_ids(text):
    from tokenizers import Tokenizer

    files = harmonic_packing.vocabulary()
    assert harmonic_packing._encoder(files)(text).tolist() == Tokenizer.from_file(files[0]).encode(text, add_special_tokens=False).ids


def test_packing(spark):
    rows = TEXTS + [(i, "some words of a text " * (i % 90)) for i in range(100, 700)]
    packed = harmonic_packing.packed(docs(spark, rows).coalesce(1), with_ids=True)
    got = packed.collect()
    encode = harmonic_packing._encoder(harmonic_packing.vocabulary())
    whole = {i: [*encode(t or "").tolist(), 0] for i, t in rows}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, set()).add((r.start, tuple(r.ids)))
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.doc_tokens == len(whole[r.doc_id])
    for i, ids in whole.items():
        assert [x for _, part in sorted(by_doc[i]) for x in part] == ids
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and len(own) <= own[0]["class"]
    assert all(r.length >= harmonic_packing.LEAST or r.length == r.doc_tokens % 1024 for r in got)
    total = sum(r.length for r in got)
    padded = sum(n if n & (n - 1) == 0 else 1024 for n in (sum(r.length for r in own) for own in by_sequence.values()))
    assert padded <= 1.15 * total  # a few hundred texts leave one part-filled bin of each class
    several = harmonic_packing.packed(docs(spark, rows).repartition(5, "doc_id")).collect()  # tasks never share a bin
    assert sum(r.length for r in several) == total and max(Counter(r.sequence_id for r in several).values()) <= 1024
    done = harmonic_packing.sequences(packed).collect()
    assert all(len(r.ids) == (r.tokens if r.tokens & (r.tokens - 1) == 0 else 1024) for r in done)
    assert harmonic_packing.packed(docs(spark).limit(0)).count() == 0


def test_archive(spark, tmp_path):
    big, small = "b" * 120, "s" * 99
    pages = spark.createDataFrame([(3, "u3", big), (1, "u\r\n1", big), (2, None, small), (4, "u4", small), (5, "u5", None), (None, "n", big), (1, "u1", big)], "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    content_archive.write_archive(pages, f"{tmp_path}/a")
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == 3
    got = sorted((r.record or 0, r.record_type, r.refers_to or 0, r.bytes) for r in content_archive.read_archive(spark, f"{tmp_path}/a").collect())
    assert got == [(0, "revisit", 1, 120), (1, "response", 0, 120), (1, "response", 0, 120), (2, "response", 0, 99), (3, "revisit", 1, 120), (4, "response", 0, 99), (5, "response", 0, 0)]
    for r in content_archive.warc_records(spark, f"{tmp_path}/a").collect():
        head, _, block = bytes(r.warc).partition(b"\r\n\r\n")
        length = int(head.rpartition(b"Content-Length: ")[2])
        assert head.startswith(b"WARC/1.1\r\n") and len(block) == length + 4 and block.endswith(b"\r\n\r\n") and head.count(b"WARC-Target-URI") <= 1
    files = spark.read.parquet(f"{tmp_path}/a/payloads").withColumn("payload", F.encode(F.lit("other"), "UTF-8"))
    files.write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="does not hash"):
        content_archive.read_archive(spark, f"{tmp_path}/b").select("record", "bytes").collect()
    text = {r.page_id: (r.html or "") for r in pages.where("page_id is not null").collect()}
    for r in content_archive.rebuilt_facts(spark, f"{tmp_path}/a").where("record is not null").collect():
        assert (r.payload_bytes, r.payload_digest) == (len(text[r.record]), hashlib.sha256(text[r.record].encode()).hexdigest())
    content_archive.write_archive(pages.limit(0), f"{tmp_path}/c")
    assert content_archive.rebuilt_facts(spark, f"{tmp_path}/c").count() == 0
    content_archive.write_archive(spark.createDataFrame([(1, "u", "é" * 3_000_000)], "page_id long, url string, html string"), f"{tmp_path}/d")
    assert content_archive.rebuilt_facts(spark, f"{tmp_path}/d").first().payload_bytes == 6_000_000


def test_preference(spark):
    c = [(1, 0, "user", "hi"), (1, 1, "assistant", "A"), (1, 2, "user", "more"), (2, 0, "user", "same"), (3, 0, None, None), (None, 0, "user", "x"), (4, 0, "user", "q"), (4, 0, "user", "q")]
    r = [(1, 0, "user", "hi"), (1, 1, "assistant", "BB"), (2, 0, "user", "same"), (3, None, "assistant", "late"), (4, 0, "user", "q")]
    schema = "conv_id long, turn long, role string, text string"
    clash = lambda rows: spark.createDataFrame(rows, schema).withColumns({"pair_id": F.lit(7), "block": F.lit("b"), "side": F.lit("s")})
    rows = preference_format.preference_rows(clash(c), clash(r)).orderBy("block").collect()
    got = {x.pair_id: x for x in rows}
    one = got[1]
    assert set(got) == {1, 2, 3, 4} and one.prompt == "<|user|>\nhi<|end|>\n" and one.prompt_turns == 1 and one.n_turns == 4
    a, b = map(int, one.chosen_mask.split(":"))
    assert one.chosen[a:b] == "A<|end|>\n" and one.chosen.endswith("<|user|>\nmore<|end|>\n")
    a, b = map(int, one.rejected_mask.split(":"))
    assert one.rejected[a:b] == "BB<|end|>\n"
    assert (got[2].chosen, got[2].rejected, got[2].rejected_mask) == ("", "", "") and got[2].prompt
    third = [x for x in rows if x.pair_id == 3]  # a null turn stands last, in a block of its own
    assert "".join(x.prompt for x in third) == "" and "".join(x.chosen for x in third) == "<||>\n<|end|>\n" and "late" in third[1].rejected
    assert got[4].chosen.count("q") == 2 and got[4].rejected.count("q") == 1
    long = spark.createDataFrame([(9, t, "assistant", str(t) * (100_000 if t == 5 else 1)) for t in range(200)], schema)
    parts = preference_format.preference_rows(long, long.limit(0)).orderBy("block").collect()
    assert [p.n_turns for p in parts] == [64, 64, 64, 8] and "".join(p.chosen for p in parts) == "".join(f"<|assistant|>\n{str(t) * (100_000 if t == 5 else 1)}<|end|>\n" for t in range(200))
    assert preference_format.preference_rows(long.limit(0), long.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_preference_format", "op7_set_relation_join", "op8_content_archive"])
def test_same_rows_as_sql(spark, name):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in verify.TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf).toArrow(), con.sql(ORACLE[name]).to_arrow_table()
    assert len(got) and sorted(got.column_names) == sorted(want.column_names) and verify.normal(got) == verify.normal(want)
