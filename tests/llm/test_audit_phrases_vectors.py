"""Filter interactions, collocations and vector near duplicates against brute force on small tables with odd rows."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from matchloom.llm import collocations, embedding_dedup, filter_audit
from matchloom.llm.queries import QUERIES

# ---- filters -------------------------------------------------------------------------------------------------------------


def brute_audit(docs, labels):
    good, toxic = ({d for d, q, x in labels if d is not None and v(q, x)} for v in (lambda q, x: q == 1, lambda q, x: x == 1))
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > first[t]}
        rows.append((s or "", fails, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own, totals = [r for r in rows if r[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                left = [r for r in own if not any(r[1][x] for x in order[: step - 1])]
                gone = [r for r in left if r[1][f]]
                totals[f] += len(gone)
                alone = sum(r[1][f] and sum(r[1].values()) == 1 for r in own)
                out[part, order, step] = [len(left) - len(gone), len(gone), sum(r[1][f] for r in own) - len(gone), alone, sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for k, v in out.items():
            if k[0] == part:
                v[6] = totals[v[6]]
    return out


def audited(spark, docs, labels):
    docs = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, part int, A int")
    labels = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, text string")
    return filter_audit.audit(docs, labels)


def test_filter_interactions(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n ", "AB", "a" * 50, " ".join(["x"] * 250), "ü#", " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(199)), " " + " ".join(f"W{i}" for i in range(300)) + "\n"]
    docs = [(rng.randrange(60), rng.choice(texts), rng.choice(["a", "b", None, "", "ü"])) for _ in range(150)] + [(None, "AB", "a"), (None, "", None), (None, None, "only")]
    docs += docs[:5]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1), (999, 1, 1)]
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in audited(spark, docs, labels).collect()}
    assert got == brute_audit(docs, labels)
    for part in {k[0] for k in got}:  # what the five filters remove together is shared out by the values
        assert sum(got[part, "ABCDE", s][6] for s in range(1, 6)) == 120 * sum(got[part, "ABCDE", s][1] for s in range(1, 6))


def test_filters_of_nothing(spark):
    assert audited(spark, [], []).count() == 0
    one = audited(spark, [(1, "x " * 100_000, "s")], []).where("filter_order = 'BACDE'").orderBy("step").collect()
    assert [(r.kept, r.removed) for r in one] == [(0, 1)] + [(0, 0)] * 4 and one[0].shapley == 120 and one[1].redundant == 0


def test_filter_plan_has_no_cross_join(spark, capsys):
    QUERIES["op11_filter_interactions"](spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


# ---- phrases -------------------------------------------------------------------------------------------------------------


def brute_phrases(docs, least, top, longest=3):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if a >= least}
        rows = []
        for p, a in kept.items():
            longer = [b for q, b in kept.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if len(p) > 1 and not any(100 * b >= 50 * a for b in longer):
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (p.decode(), -a, x, y, n[lang], -s)
    return out


def mined(spark, docs, **how):
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "text string, lang string, n int, phrase string")
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(frame, **how).collect()}


def prose(seed, rows=400):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new york", "new york city", "a b c", "a b", "x", "é", "\x00", "naïve", "z-1", " ", "rare", "state of the art"] + [f"w{i}" for i in range(20)]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(rng.randint(0, 40)))
    docs = [(text(), rng.choice(["en", "en", "de", None, "", "und"])) for _ in range(rows)]
    return docs + [(None, "en"), ("", "en"), ("...", "xx"), (docs[0][0], docs[0][1])] * 3


@pytest.mark.parametrize("least", [10, 2])
def test_collocations(spark, least):
    docs = prose(least)
    assert mined(spark, docs, least=least) == brute_phrases(docs, least, 2000)
    assert mined(spark, docs, least=least, top=7) == brute_phrases(docs, least, 7)


def test_longer_phrases_and_small_blocks(spark):
    """Four words, and blocks of a few texts, so that phrases must be pruned and counted over blocks."""
    docs = prose(3)
    frame = spark.createDataFrame(docs, "text string, lang string")
    from matchloom.llm.common import Scratch

    counts, _ = collocations.phrase_counts(frame, Scratch(spark, "t"), words=4, least=5, most_bytes=200)
    got = {(r.lang, r.phrase): r.f for r in counts.collect()}
    want = Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang if lang is not None else "und", " ".join(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert got == {k: v for k, v in want.items() if v >= 5}


def test_collocations_of_nothing_and_of_one_long_text(spark):
    assert mined(spark, []) == {} and mined(spark, [(None, None), ("", "en"), ("one two", "en")]) == {}
    rng = random.Random(8)
    long = " ".join(rng.choice("abcdefgh") for _ in range(120_000))
    assert mined(spark, [(long, "en")]) == brute_phrases([(long, "en")], 10, 2000)


def test_lists_are_packed_without_loss():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 9, 300).astype(np.int32)
    lists = np.concatenate([np.sort(rng.integers(0, 2**31 - 1, n)) for n in lengths]).astype(np.int32)
    assert (collocations._unpack(lengths, collocations._pack(lengths, lists)) == lists).all()


# ---- vectors -------------------------------------------------------------------------------------------------------------


def brute_vectors(rows, cosine):
    sound = lambda v: v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = lambda v: (lambda x: x / np.linalg.norm(x))(np.array(v) / max(map(abs, v)))
    units = [unit(v) if sound(v) else None for _, v in rows]
    links = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= cosine] for i, a in enumerate(units)]
    out = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in links[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((own, len(links[i]), least, own == least))
    return sorted(out, key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, copies int")


def test_vector_near_duplicates(spark):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for _ in range(40):
        base = rng.standard_normal(24)
        for k in range(int(rng.integers(1, 7))):
            rows.append((n, (base + rng.standard_normal(24) * rng.choice([0, 0.02, 0.05, 0.3])).tolist()))
            n += 1
    rows += [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [None, 1.0]), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, [float("inf")] * 24), (908, [1e200, 2e200]), (909, [1e-200, 2e-200]), (None, rows[0][1]), (None, [9.0, -1.0]), (910, [0.0, 1.0]), (911, [-0.0, 1.0])]
    rows += [rows[3], (rows[4][0], rows[80][1])]
    got = sorted([tuple(r) for r in embedding_dedup.near_duplicates(vectors(spark, rows), recall=0.9999).collect()], key=repr)
    assert got == brute_vectors(rows, 0.95)


def test_vector_blocks_change_nothing(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * (0.05 if i % 3 else 1)).tolist()) for i in range(240)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 240, 7)]
    one, many = (sorted([tuple(r) for r in embedding_dedup.near_duplicates(vectors(spark, rows), recall=0.9999, block=block).collect()], key=repr) for block in (4096, 16))
    want = brute_vectors(rows, 0.95)
    assert one == many and [(r[0], *r[2:]) for r in one] == [(r[0], *r[2:]) for r in want]
    assert all(a[1] <= b[1] for a, b in zip(one, want, strict=True)) and sum(r[1] for r in one) >= 0.98 * sum(r[1] for r in want)


def test_vectors_of_nothing(spark):
    assert embedding_dedup.near_duplicates(vectors(spark, [])).count() == 0
    assert [tuple(r) for r in embedding_dedup.near_duplicates(vectors(spark, [(3, None)])).collect()] == [(3, 0, 3, True)]
    assert [tuple(r) for r in embedding_dedup.near_duplicates(vectors(spark, [(3, [1.0]), (2, [1.0])])).orderBy("vec_id").collect()] == [(2, 1, 2, True), (3, 1, 2, False)]


@pytest.mark.parametrize("share", [0.34, 0.8])
def test_recall_in_one_hot_group(spark, share):
    """A group of near copies that holds a third of all rows, or most, is found as well as small ones are, and costs no more than its blocks."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal(64)
    rows = [(i, (base + 0.12 * rng.standard_normal(64) if i < share * 1500 else rng.standard_normal(64)).tolist()) for i in range(1500)]
    want = {r[0]: r[1] for r in brute_vectors(rows, 0.95)}
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(vectors(spark, rows), block=300).collect()}
    assert sum(want.values()) > 100_000 and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.95 * sum(want.values()), sum(got.values()) / sum(want.values())


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of just over 0.95, the hardest that count."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        a, b = np.linalg.qr(rng.standard_normal((48, 2)))[0].T
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.951 * a + math.sqrt(1 - 0.951**2) * b).tolist())]
    found = embedding_dedup.near_duplicates(vectors(spark, rows)).where("n_links > 0").count() / 800
    assert found >= 0.9, found


def test_codes_are_balanced_and_close():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 32)) * np.linspace(3, 0.1, 32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    mean, projection, middle = embedding_dedup.fit(x, 64)
    on = (x - mean) @ projection > middle
    assert abs(on.mean(0) - 0.5).max() < 0.01
    turned = embedding_dedup._rotation(x, np.random.default_rng(0), 30)
    loss = lambda r: np.linalg.norm(np.where(x @ r > 0, 1, -1) / math.sqrt(32) - x @ r)
    assert loss(turned) < loss(np.linalg.qr(np.random.default_rng(0).standard_normal((32, 32)))[0])


def test_new_queries_take_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op11_filter_interactions"](spark, sf)
    assert got.count() == 600 * docs.select("source").distinct().count()
    assert got.where("filter_order = 'ABCDE' and step = 1").selectExpr("sum(kept + removed) as n").first().n == docs.count()
    assert QUERIES["op12_phrase_collocations"](spark, sf).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert QUERIES["op13_quantised_near_dedup"](spark, sf).count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
