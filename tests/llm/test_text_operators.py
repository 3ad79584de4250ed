"""Joins, dedup, tiling, models: against brute force and held-out labels."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchloom.llm import importance_resampling, jaccard_join, line_chunks, personal_data, shingles, string_tiling, subword_toxicity
from matchloom.llm.common import load, utf8

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("k"), "_id": F.lit(1), "score": F.lit(0.5)})


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_components(rows, n, percent):
    sets = [shingle_set(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("n,percent,short", [(4, 85, 48), (2, 60, 3)])
def test_jaccard(spark, monkeypatch, n, percent, short):
    """short=3 makes clusters of index lists, so that blocks and incremental overlaps are used."""
    rng = random.Random(n)
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(jaccard_join, "HUBS", 2 if short == 3 else 4)
    monkeypatch.setattr(jaccard_join, "PART", 5)
    rows, base = [], [[rng.choice(WORDS) for _ in range(rng.randint(1, 40))] for _ in range(12)]
    for d in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((d, rng.choice([" ", "\t", "\n"]).join(w).title() if rng.random() < 0.3 else " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, rows[0][1]), (204, "one"), (205, "ONE")]
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(frame(spark, rows), n, percent).collect())
    assert got == brute_components(rows, n, percent)


def test_one_of_each_group(spark):
    text = " ".join(WORDS * 3)
    rows = [(3, text), (1, text), (1, text), (None, text), (5, None), (5, None), (None, " "), (None, " "), (6, ""), (7, "other words here")]
    got = jaccard_join.one_of_each_group(frame(spark, rows))
    assert sorted((r.doc_id for r in got.collect()), key=lambda x: x or 0) == [None, None, 1, 5, 5, 6, 7] and got.columns == frame(spark, rows).columns
    assert jaccard_join.one_of_each_group(frame(spark, rows).limit(0)).count() == 0


def test_lists_are_skipped_by_position():
    rng = np.random.default_rng(4)
    sizes = rng.integers(40, 120, 300)
    positions = (rng.random(300) * sizes * 0.15).astype(np.int64)
    keys, counts = [bytes([i // 256, i % 256]) for i in range(300)], [0, 0]
    got = set(jaccard_join._list_pairs(keys, sizes, positions, 85, counts))
    want = set()
    for i, j in itertools.combinations(range(300), 2):
        overlap = min(sizes[i] - positions[i], sizes[j] - positions[j])
        if 100 * overlap >= 85 * (sizes[i] + sizes[j] - overlap):
            want.add((keys[i], keys[j]))
    assert got == want and counts[0] == 300 * 299 // 2 and counts[1] > 0.4 * counts[0]


def test_near_copies_of_one_text_stay_linear(spark, monkeypatch):
    """A few hundred near copies, by hubs, parts and residual clusters, are one component; none of the lists is compared with itself."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(400):
        w = list(base)
        w[rng.randrange(120)] = f"x{d}"
        rows.append((d, " ".join(w)))
    rows += [(500 + d, " ".join(f"y{d}z{i}" for i in range(30))) for d in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(frame(spark, rows), 4, 85).collect()}
    assert {got[d] for d in range(400)} == {0} and all(got[500 + d] == 500 + d for d in range(20))


def test_jaccard_of_no_rows_and_long_text(spark):
    assert jaccard_join.jaccard_components(frame(spark, [(1, "a")]).limit(0)).count() == 0
    long = " ".join(f"w{i % 50_000}" for i in range(200_000))
    got = jaccard_join.jaccard_components(frame(spark, [(1, long), (2, long + " end"), (3, "end")])).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_block_links_are_complete():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(40)]
    up = jaccard_join._Groups(40)
    for i, j in jaccard_join.block_links(sets, 60):
        up.join(i, j)
    want = jaccard_join._Groups(40)
    for i, j in itertools.combinations(range(40), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 60 * (len(sets[i]) + len(sets[j]) - both):
            want.join(i, j)
    assert [up.find(i) for i in range(40)] == [want.find(i) for i in range(40)]


def test_line_chunks(spark):
    passage = [f"shared line {i} of a passage" for i in range(30)]
    rows = [(i, "\n".join([f"own {i} a", *passage, f"own {i} b"])) for i in range(5)] + [(9, None), (10, ""), (11, "\n\n"), (None, "\n".join(passage)), (12, "single"), (13, "single")]
    got = {r.doc_id: r for r in line_chunks.without_repeated_chunks(frame(spark, rows), report=True).collect()}
    assert got[0].text == rows[0][1] and got[0].removed_lines == 0
    for i in (1, 2, 3, 4):
        left = got[i].text.split("\n")
        assert left[0] == f"own {i} a" and left[-1] == f"own {i} b" and len(left) == 32 - got[i].removed_lines and got[i].removed_lines > 20
    assert got[9].text is None and got[10].text == "" and got[11].text == "\n\n" and got[12].text == got[13].text == "single"
    assert got[None].removed_lines > 20 and line_chunks.without_repeated_chunks(frame(spark, rows).limit(0)).count() == 0


def brute_tiles(doc, item, least):
    used_d, used_i, tiles = set(), set(), []
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while j + n < len(item) and i + n < len(doc) and doc[i + n] == item[j + n] and j + n not in used_i and i + n not in used_d:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, j, i)
        if best is None:
            return sorted(tiles)
        n, j, i = best
        used_i |= set(range(j, j + n))
        used_d |= set(range(i, i + n))
        tiles.append((i, j, n))


def test_tiling(spark):
    rng = random.Random(3)
    items = [(k, " ".join(rng.choice(WORDS[:6]) for _ in range(rng.randint(2, 30)))) for k in range(20)] + [(50, None), (51, " ")]
    rows = []
    for d in range(30):
        w = rng.choice(items[:20])[1].split()
        cut = rng.randrange(len(w))
        rows.append((d, " ".join([rng.choice(WORDS) for _ in range(10)] + w[cut:] + ["x"] + w[:cut]).upper()))
    rows += [(40, None), (41, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in string_tiling.leaks(frame(spark, rows), bench).select("doc_id", "item_id", "covered_words", "tiles").collect())
    want = []
    for d, text in rows:
        for k, item in items:
            a, b = (text or "").lower().split(), (item or "").split()
            if b:
                tiles = brute_tiles(a, b, min(5, len(b)))
                covered = sum(x[2] for x in tiles)
                if tiles and 100 * covered >= 50 * len(b):
                    want.append((d, k, covered, ",".join(f"{i}:{j}:{n}" for i, j, n in tiles)))
    assert got == sorted(want)
    kept = {r.doc_id for r in string_tiling.clean_documents(frame(spark, rows), bench).collect()}
    assert kept == {d for d, _ in rows} - {g[0] for g in got}


def test_tiling_edges(spark):
    bench = spark.createDataFrame([(1, "x " * 1000), (2, "one two three four five six seven"), (2, "one two three four five six seven")], "item_id long, text string")
    rows = [(1, "x " * 200_000), (2, "ONE two three four five six seven"), (2, "ONE two three four five six seven"), (3, "y")]
    got = sorted((r.doc_id, r.item_id, r.covered_words) for r in string_tiling.leaks(frame(spark, rows), bench).collect())
    assert got == [(1, 1, 1000), *[(2, 2, 7)] * 4]
    assert string_tiling.leaks(frame(spark, rows).limit(0), bench).count() == 0 == string_tiling.leaks(frame(spark, rows), bench.limit(0)).count()
    assert string_tiling.clean_documents(frame(spark, rows), bench.limit(0)).count() == 4


@pytest.mark.parametrize("pairs", [5, 1_000_000])
def test_tiling_of_repeated_words(monkeypatch, pairs):
    """Few different words, so many seeds on many diagonals, in small ranges of diagonals too."""
    import pyarrow as pa

    monkeypatch.setattr(string_tiling, "PAIRS", pairs)
    rng = random.Random(pairs)
    for _ in range(30):
        items, docs = ([" ".join(rng.choice("abc") for _ in range(rng.randint(1, n))) for _ in range(5)] for n in (25, 40))
        got = sorted((r, i, c, tuple(sorted(t))) for r, i, c, t in string_tiling._matches(pa.array(docs), string_tiling.Items(list(range(5)), items, 3), 50))
        tiles = {(r, i): brute_tiles(d.split(), x.split(), min(3, len(x.split()))) for r, d in enumerate(docs) for i, x in enumerate(items)}
        assert got == sorted((r, i, sum(x[2] for x in t), tuple(t)) for (r, i), t in tiles.items() if t and 100 * sum(x[2] for x in t) >= 50 * len(items[i].split()))


def test_base_spans():
    text = "a.b@c.d.e x@y @z.w 1.2.3.4 256.1.1.1 x 4111 1111-1111 1111 +1 (743) 555-3824 +12 m@n.o@p.q 12345678901234567890"
    got = [(personal_data.KINDS[k], text[a:b]) for k, a, b in personal_data.base_spans(text)]
    assert got == [("email", "a.b@c.d.e"), ("email", "m@n.o"), ("ip", "1.2.3.4"), ("card", "4111 1111-1111 1111"), ("phone", "+1 (743) 555-3824")]
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(0)
    for _ in range(3000):
        s = "".join(rng.choice("ab@@..-_ ") for _ in range(rng.randint(0, 25)))
        assert [m.span() for m in plain.finditer(s)] == list(personal_data._emails(s))


def test_crf_gradient_and_viterbi():
    rng = np.random.default_rng(0)
    net = personal_data.Network(2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(0, 30, (3, 7)).astype(np.uint8), np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [5, 6, 0, 0, 7, 8, 8]])
    loss, grads = net.gradient(x, y)
    for name, at in (("embed", (3, 2)), ("uf", (1, 5)), ("wb", (2, 9)), ("out", (4, 3)), ("trans", (0, 1)), ("cf", (7,))):
        step = 1e-4
        net.p[name][at] += step
        up = net.gradient(x, y)[0]
        net.p[name][at] -= 2 * step
        down = net.gradient(x, y)[0]
        net.p[name][at] += step
        assert abs((up - down) / (2 * step) - grads[name][at]) < 2e-3, name
    net.p = {k: v.astype(np.float32) for k, v in net.p.items()}
    emitted = rng.standard_normal((5, personal_data.TAGS, 4)).astype(np.float32)
    trans = net.p["trans"] + personal_data.BANNED
    tags = net.decode(emitted)
    for w in range(4):
        score = lambda p: sum(emitted[t, p[t], w] for t in range(5)) + sum(trans[p[t], p[t + 1]] for t in range(4))  # noqa: B023, E731
        best = max(itertools.product(range(personal_data.TAGS), repeat=5), key=score)
        assert math.isclose(score(tuple(tags[w])), score(best), rel_tol=1e-5)


def test_windows_of_all_sizes_run_together(monkeypatch):
    """One run of the network for texts of all lengths gives what each of them gives by itself, and what the states of training give."""
    rng, net, calls = np.random.default_rng(4), personal_data.Network(3), []
    net.p["out"] *= 3
    net.p["out_b"][0] = 0
    texts = ["".join(rng.choice(list("ab .@019-+")) for _ in range(n)) for n in (1, 700, 64, 65, 130, 250, 300, 0, 330, 400, 512, 513)]
    once = personal_data.Network.emissions
    monkeypatch.setattr(personal_data.Network, "emissions", lambda self, windows, *more: calls.append(len(windows)) or once(self, windows, *more))
    found = personal_data._found(net, net.prepared(), texts)
    assert calls == [13] and sum(map(len, found)) > 20
    for text, spans in zip(texts, found, strict=True):
        (alone,) = personal_data._found(net, net.prepared(), [text])
        assert [s[:3] for s in alone] == [s[:3] for s in spans]
        assert np.allclose([s[3] for s in alone], [s[3] for s in spans], atol=1e-3)
    windows = rng.integers(0, personal_data.CLASSES, (5, 40)).astype(np.uint8)
    x = windows.T
    plain = np.concatenate([net._run(x, "f")[0], net._run(x[::-1], "b")[0][::-1]], axis=2) @ net.p["out"] + net.p["out_b"]
    assert np.allclose(net.emissions(windows, net.prepared()), plain.transpose(0, 2, 1), atol=1e-4)
    net.p["embed"] *= 1e4  # an exp beyond the floats
    with np.errstate(all="raise", under="ignore"):
        assert np.isfinite(net.emissions(windows, net.prepared())).all()


def test_best_paths_without_a_span():
    """Where no path beats that without spans, it is taken without the way back; the others are as by brute force, in windows of several sizes."""
    rng, net = np.random.default_rng(6), personal_data.Network(2)
    net.p["trans"] = -np.abs(rng.standard_normal((personal_data.TAGS, personal_data.TAGS))).astype(np.float32)
    net.p["trans"][0, 0] = 0
    trans, sizes = net.p["trans"] + personal_data.BANNED, np.array([4, 4, 4, 3, 3, 1, 1])
    emitted = rng.standard_normal((4, personal_data.TAGS, 7)).astype(np.float32)
    emitted[:, 0, ::2] += 4
    tags = net.decode(emitted, sizes)
    for w, size in enumerate(sizes):
        score = lambda p: sum(emitted[t, p[t], w] for t in range(len(p))) + sum(trans[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert tuple(tags[w, :size]) == max(itertools.product(range(personal_data.TAGS), repeat=int(size)), key=score)
        assert not tags[w, size:].any()
    assert not tags[::2].any() and tags[1::2].any(axis=1).all()


def test_personal_data(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    texts = [r.text for r in docs.where("doc_id % 3 = 0").collect()]
    network = personal_data.Network().fit(*personal_data.labelled(texts), steps=500)
    windows, tags = personal_data.labelled([r.text for r in docs.where("doc_id % 3 = 1").collect()], seed=77)
    got = network.decode(network.emissions(windows, network.prepared()))
    hit = ((got > 0) & (tags > 0)).sum()
    assert hit / (tags > 0).sum() > 0.9 and hit / (got > 0).sum() > 0.9
    # variants of which nothing was trained on: one of each kind is held out
    new = [personal_data.VARIANTS[i] for i in (2, 6, 9, 13)]
    old = [v for v in personal_data.VARIANTS if v not in new]
    fewer = personal_data.Network().fit(*personal_data.labelled(texts, variants=old), steps=500)
    rng, found = np.random.default_rng(3), []
    for _ in range(120):
        kind, value = personal_data._variant(rng, new)
        text = f"some words before {value} and some after"
        ((_, spans),) = personal_data.all_spans([text], fewer)
        found.append(any(k == kind and a < 18 + len(value) and b > 18 for k, a, b in spans))
    print(f"held-out variants found: {np.mean(found):.2f}")
    assert np.mean(found) > 0.55
    long = "word " * 3000 + "me@there.org" + " word" * 3000
    rows = [(1, long), (1, long), (2, None), (3, ""), (4, "no data here"), (None, "me@there.org")]
    out = sorted(map(tuple, personal_data.personal_data(frame(spark, rows), network).select("doc_id", "n_email", "spans").where("doc_id is not null").collect()))
    assert out == [(1, 1, "email:15000:15012")] * 2 + [(2, 0, ""), (3, 0, ""), (4, 0, "")]
    assert personal_data.personal_data(frame(spark, rows).limit(0), None).count() == 0
    assert personal_data.train(frame(spark, rows).limit(0)) is None


def test_reconciled():
    spans = [(0, 0, 10, 5.0), (0, 8, 14, 4.0), (1, 12, 20, 9.0), (1, 30, 40, 1.0), (2, 32, 36, 3.0)]
    assert personal_data.reconciled(spans) == [(1, 12, 20, 9.0), (2, 32, 36, 3.0)]
    assert personal_data.reconciled([(0, 100, 150, 50.0), (0, 140, 180, 40.0)]) == [(0, 100, 180, 80.0)]
    assert personal_data.reconciled([(0, 0, 10, 5.0), (0, 10, 20, 4.0)]) == [(0, 0, 10, 5.0), (0, 10, 20, 4.0)]
    assert personal_data.masked("write a@b.c now", [(0, 6, 11)]) == "write [email] now"
    assert personal_data.OVERLAP > personal_data.MOST


def test_every_kind_is_drawn():
    text = "a@b.org " * 6 + "4111 1111 1111 1111 and 10.0.0.1 and +1 743 555 3824"
    spans = personal_data.base_spans(text)
    drawn = personal_data._drawn(np.random.default_rng(0), spans, 6)
    assert len(spans) == 9 and {k for k, *_ in drawn} == {0, 1, 2, 3} and len(drawn) == 6


def brute_weights(rows, targets):
    def buckets(text):
        import pyarrow as pa

        data, offsets = utf8(pa.array([text or ""]))
        words = shingles.word_hashes(data, offsets)[0]
        both = list(words) + [shingles.shingle_hashes(np.array(words[i : i + 2]), 2)[0] for i in range(len(words) - 1)]
        return [int(h >> np.uint64(64 - importance_resampling.BUCKET_BITS)) for h in both]

    def model(texts):
        counts = np.ones(1 << importance_resampling.BUCKET_BITS)
        for x in texts:
            for b in buckets(x):
                counts[b] += 1
        return np.log(counts / counts.sum())

    ratio = model(targets) - model([x for _, x in rows])
    return {d: sum(ratio[b] for b in buckets(x)) for d, x in rows}


def test_resampling(spark):
    rng = random.Random(5)
    rows = [(d, " ".join(rng.choice(WORDS[:6] if d % 2 else WORDS[6:]) for _ in range(rng.randint(0, 30)))) for d in range(200)] + [(300, None)]
    targets = [x for d, x in rows if d % 2][:40]
    good = spark.createDataFrame([(x,) for x in targets], "text string")
    keys = importance_resampling.weighted(frame(spark, rows), good)
    want = brute_weights(rows, targets)
    got = {r.doc_id: r for r in keys.collect()}
    assert all(math.isclose(got[d].log_weight, want[d], abs_tol=1e-9) for d in want)
    drawn = importance_resampling.drawn(frame(spark, rows), good, 0.4).collect()
    assert {r.doc_id for r in drawn} == {r.doc_id for r in sorted(got.values(), key=lambda r: -r.key)[: math.ceil(0.4 * len(rows))]}
    assert sum(r.doc_id % 2 for r in drawn) > 0.75 * len(drawn)
    assert importance_resampling.resampled(frame(spark, rows), good, 0.4).columns == frame(spark, rows).columns
    clash = frame(spark, rows).withColumn("drawn_id", F.lit("x")).withColumn("_drawn_hash", F.lit(1))
    kept = importance_resampling.resampled(clash, good, 0.4)
    assert kept.columns == clash.columns and kept.count() == len(drawn)
    assert importance_resampling.drawn(frame(spark, rows).limit(0), good).count() == 0
    flat = importance_resampling.weighted(frame(spark, rows), good.limit(0))
    assert flat.where("log_weight != 0").count() == 0


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    model = subword_toxicity.train(docs, labels)
    got = subword_toxicity.scored(docs, model)
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert len(held) > 40 and sum(r.predicted == r.toxic for r in held) / len(held) >= 0.9
    rows = [(1, None), (2, ""), (3, "word " * 50_000), (3, "word"), (None, "x")]
    few = subword_toxicity.scored(frame(spark, rows), model).collect()
    assert len(few) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in few) and few[0].score < 0.5
    assert subword_toxicity.without_toxic(frame(spark, rows).limit(0), model).count() == 0
    none = subword_toxicity.train(docs.limit(0), labels.limit(0))
    assert none.score("anything") == 0
    filler = "plain words of a long text about nothing " * 700
    long = spark.createDataFrame([(i, filler + ("vile slur here " * 2000 if i % 2 else "kind hello there " * 2000)) for i in range(40)], "doc_id long, text string")
    of_long = subword_toxicity.train(long, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    assert of_long.score("a vile slur here") > of_long.score("a kind hello there")


def test_pipeline(spark):
    docs = load(spark, SF, "documents")
    seen, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        rows = out.collect()
        assert 0 < len(rows) <= seen
        seen, docs = len(rows), spark.createDataFrame(rows, out.schema)
    last = corpus_pipeline.run(spark, SF)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
