"""Repeated passages against a brute force over all pairs of runs, and between differing neighbours."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from matchloom.llm import line_passages
from matchloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def planted(rng):
    """Pairs of unlike documents that share a passage of 1 to 6 lines and about 60 words, one within a line, and what has to be gone."""
    rows, passages = [], []
    for i in range(30):
        passage = [words(rng, 60 // (i % 6 + 1) + 1) for _ in range(i % 6 + 1)]
        passages.append(passage)
        for d in (2 * i, 2 * i + 1):
            rows.append((d, "\n".join([words(rng, 9), words(rng, 70), *passage, words(rng, 80), words(rng, 4)])))
    inner = ". ".join(words(rng, 15).capitalize() for _ in range(4)) + "."
    rows += [(d, f"{words(rng, 30)}. {inner} {words(rng, 30)}") for d in (60, 61)]
    return rows, [*passages, [inner]]


def check_planted(rows, passages, got):
    for i, passage in enumerate(passages):
        first, later = got[2 * i], got[2 * i + 1]
        assert first == rows[2 * i][1]
        assert not any(line in later for line in passage)
        assert later == re.sub(re.escape("\n".join(passage)) + r"\s", "", rows[2 * i + 1][1])


def test_short_passages(spark):
    rows, passages = planted(random.Random(1))
    got = {r.doc_id: r.text for r in line_passages.without_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    check_planted(rows, passages, got)


def brute(rows, least):
    """Units that go: all pairs of equal runs of over `least` words, of which the later place goes, but for runs over their own start."""
    split = {d: [u for u in t.split("\n")] for d, t in rows}
    seen, gone = {}, set()
    for d in sorted(split):
        u = split[d]
        for i in range(len(u)):
            for j in range(i + 1, len(u) + 1):
                if sum(len(x.split()) for x in u[i:j]) > least:
                    at = seen.setdefault(tuple(u[i:j]), (d, i))
                    if at[0] != d or i >= at[1] + j - i:
                        gone |= {(d, k) for k in range(i, j)}
    return {d: "\n".join(x for k, x in enumerate(u) if (d, k) not in gone) for d, u in split.items()}


@pytest.mark.parametrize("least", [3, 7])
def test_brute_force(spark, least):
    rng = random.Random(least)
    lines = [words(rng, rng.randint(1, 4)) for _ in range(9)]
    rows = [(d, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for d in range(80)]
    got = dict(line_passages.without_repeated_passages(spark.createDataFrame(rows, SCHEMA), least=least).collect())
    assert got == brute(rows, least)


def test_edges(spark):
    long = words(random.Random(3), 60)
    rows = [(1, long), (2, f"{long}\n\n"), (3, f"\n\n a\n  {long} \n\nb"), (4, None), (5, ""), (6, "\n\n"), (None, f"x. {long}\ny"), (7, "\n".join([long] * 4)), (8, "short"), (9, "short"), (10, f"A {long}. B c.\nnext")]
    rows += [(11, f"A {long}. other.\nnext"), (12, f"start: {long}\nthen: {long}\nend")]
    got = {r.doc_id: r for r in line_passages.without_repeated_passages(spark.createDataFrame(rows, SCHEMA), report=True).collect()}
    assert got[1].text == long and got[2].text == "" and got[3].text == "\n\n a\nb" and got[4].text is None and got[5].text == "" and got[6].text == "\n\n"
    assert got[None].text == "x.\ny" and got[7].text == "" and got[7].removed_units == 4 and got[8].text == got[9].text == "short"
    assert got[10].text == rows[10][1] and got[11].text == "other.\nnext" and got[12].text == "start:\nthen:\nend"
    assert line_passages.without_repeated_passages(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_query(spark):
    got = QUERIES["op10_line_chunk_dedup"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "text", "removed_units"] and got.where("removed_units > 0").count() > 0


def test_hot_keys_change_nothing(spark, monkeypatch):
    """A passage in most documents, dealt to several tasks or to one."""
    rng = random.Random(9)
    common = [words(rng, 30) for _ in range(4)]
    rows = [(d, "\n".join([words(rng, 8), *common[d % 2 :], words(rng, 5), *(common[2:] if d % 5 == 0 else [])])) for d in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(line_passages, "SHARE", 1)
    keyed = docs.selectExpr("doc_id as _id", "xxhash64(text) as _hash", "text as _text")
    assert line_passages._hot(keyed, 50).count() > 2
    got = dict(line_passages.without_repeated_passages(docs).collect())
    monkeypatch.setattr(line_passages, "HOT", 0)
    assert got == dict(line_passages.without_repeated_passages(docs).collect()) == brute(rows, 50)


def test_long_text(spark):
    rng = random.Random(4)
    lines = [words(rng, 6) for _ in range(9000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["other start here", *lines[3000:], "and end"]))]
    got = dict(line_passages.without_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got[1] == rows[0][1] and got[2] == "other start here\nand end"


def test_colliding_hashes_keep_both_texts(spark, monkeypatch):
    """Runs that differ stay if one of the two hashes of runs is the same for all; and equal passages are still found."""
    from pyspark.sql import functions as F

    rng = random.Random(12)
    passage = words(rng, 60)
    rows = [(d, "\n".join([words(rng, 70), passage, words(rng, 55)])) for d in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = dict(line_passages.without_repeated_passages(docs).collect())
    assert want == brute(rows, 50)
    real = line_passages._chunks
    for broken in ("h", "g"):
        monkeypatch.setattr(line_passages, "_chunks", lambda *a, broken=broken: real(*a).withColumn(broken, F.lit(1).cast("long")))
        assert dict(line_passages.without_repeated_passages(docs).collect()) == want


def test_segments_change_nothing(spark):
    rng = random.Random(13)
    lines = [words(rng, rng.randint(1, 4)) for _ in range(30)]
    rows = [(d, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 80)))) for d in range(60)]
    keyed = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id as _id", "xxhash64(text) as _hash", "text as _text")
    for least in (3, 9):
        whole = {tuple(r) for r in line_passages._chunks(keyed, least).collect()}
        assert whole == {tuple(r) for r in line_passages._chunks(keyed, least, segment=4).collect()} and len(whole) > 500


def test_very_long_texts_of_short_lines(spark):
    """Time and memory follow the number of lines: 300,000 one-word lines, most of them again in another text."""
    rows = spark.range(2).select(F_long(0, 300_000).alias("a"), F_long(1000, 299_000).alias("b"), "id")
    docs = rows.selectExpr("id as doc_id", "case when id = 0 then a else concat('other start of words here\n', b) end as text")
    got = {r.doc_id: r for r in line_passages.without_repeated_passages(docs, report=True).collect()}
    assert got[0].removed_units == 0 and got[1].removed_units == 298_999 and got[1].text == "other start of words here"


def F_long(first, n):
    from pyspark.sql import functions as F

    return F.array_join(F.transform(F.sequence(F.lit(first), F.lit(first + n - 2)), lambda i: F.concat(F.lit("w"), i.cast("string"))), "\n")


def test_units_are_cut_as_by_two_patterns(spark):
    """Asking first for the sign that both kinds of cut stand behind cuts at the same places."""
    from pyspark.sql import functions as F

    signs = ["a", "b c", ".", ". ", "! ", "\n", " ", "\t", "| ", ":", "é; ", "?\n"]
    texts = ["".join(signs[(i * 7 + j * j * (i + 1)) % len(signs)] for j in range(25)) for i in range(200)] + ["", "\n", " \n a", "a. ", "a.  b", "\n\n \t\nb"]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    plain = F.split("text", r"(?<=\n)(?=[^\S\n]*+\S)|(?<=[.!?;:|] )(?=\S)", -1)
    assert rows.where(~line_passages.units(F.col("text")).eqNullSafe(plain)).count() == 0
    assert line_passages.PATTERN.startswith(r"(?<=[\n ])")


def test_chunks_are_hashed_over_their_units_digests(spark):
    """A chunk's hashes are those of its units' digests as one stretch of bytes, in segments as in one piece."""
    lines = [" ".join(f"w{i * j % 11}" for j in range(1, 2 + i % 4)) + "\n" for i in range(40)]
    docs = spark.createDataFrame([(1, 7, "".join(lines)), (2, 8, "one word"), (3, 9, None)], "_id long, _hash long, _text string")
    whole = {tuple(r) for r in line_passages._chunks(docs, 5).collect()}
    assert whole == {tuple(r) for r in line_passages._chunks(docs, 5, segment=6).collect()} and len(whole) > 40
    digests = [hashlib.md5(x.strip().encode()).digest() for x in lines]
    runs = [(h, g, b"".join(digests[s >> 32 : (s & 2**32 - 1) + 1])) for _, _, s, h, g in whole]
    held = spark.createDataFrame(runs, "h long, g long, d binary").select("h", "g", F.xxhash64("d"), F.xxhash64(F.lit(line_passages.SEED), "d")).collect()
    assert all((h, g) == (x, y) for h, g, x, y in held)
