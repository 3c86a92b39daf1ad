"""Operators that compare texts: both dedups, language model, near duplicates, search."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weirflow.llm import blocks, lm, recompress, simhash, suffixes, topk


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(lm, "BLOCK_WORDS", 1000)


def cut_words(texts, size):
    """Words removed from each text, by looking at every window."""
    seen, out = set(), []
    for t in texts:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            if key in seen:
                gone[i : i + size] = [True] * size
            seen.add(key)
        out.append((len(words), sum(gone), [w for w, g in zip(words, gone, strict=True) if not g]))
    return out


@pytest.mark.parametrize("window,rounds", [(20, 4), (6, 0), (6, 3), (3, 2)])
def test_passages(docs_of, prose, odd, small_blocks, window, rounds):
    texts = [*prose, *odd]
    got = {r.doc_id: r for r in recompress.dedup_passages(docs_of(texts).repartition(3), window, rounds).collect()}
    for i, (n, removed, kept) in enumerate(cut_words(texts, window)):
        r = got[i]
        assert (r.n_words, r.n_removed) == (n, removed), i
        assert (r.text or "").encode().split() == kept
        assert r.lang == "en" and (removed or r.text == texts[i])
        assert sum(int(b) - int(a) for a, b in (s.split("-") for s in r.removed_spans)) == removed


def test_passages_frames(docs_of, small_blocks):
    assert recompress.dedup_passages(docs_of([])).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    rows = recompress.dedup_passages(docs_of([text] * 4, [None, 5, 5, 6]).withColumn("n_words", F.lit("x"))).collect()
    assert sorted(r.n_removed for r in rows) == [0, 30, 30, 30]
    assert [r.n_removed for r in rows if r.doc_id is None] == [0]


def test_parse_is_the_same_inside_equal_passages():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 5, 60).astype(np.uint64)

    def parse(left, right):
        words = recompress.Words.__new__(recompress.Words)
        words.hashes = np.concatenate([rng.integers(0, 5, left), passage, rng.integers(0, 5, right)]).astype(np.uint64)
        words.counts = np.array([len(words.hashes)])
        words.ends, words.doc = np.cumsum(words.counts), np.zeros(len(words.hashes), int)
        p = recompress.Parse(words, 20, 3)
        return [(int(p.level[i]), p.names[max(0, p.level[i])][p.low[i] : p.high[i] + 1].tolist()) for i in range(left, left + 41)]

    for _ in range(30):
        a, b = parse(*rng.integers(0, 30, 2)), parse(*rng.integers(0, 30, 2))
        assert [x for x in a if x[0] >= 0] == [x for x in b if x[0] >= 0] and [x[0] for x in a] == [x[0] for x in b]


def cut_bytes(texts, ids, size):
    first = {}
    for i, t in zip(ids, texts, strict=True):
        raw = (t or "").encode()
        for p in range(len(raw) - size + 1):
            key = raw[p : p + size]
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in zip(ids, texts, strict=True):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - size + 1):
            if first[raw[p : p + size]] < i:
                gone[p : p + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("size", [50, 30])
def test_suffixes(docs_of, prose, odd, small_blocks, size):
    texts = [*prose, *odd, "\x00" * 90, "\x00" * 70 + "a", "b" + "\x00" * 60, "é" * 60]
    ids = random.Random(1).sample(range(1000), len(texts))
    got = {r.doc_id: r for r in suffixes.dedup_bytes(docs_of(texts, ids).repartition(3), size).collect()}
    for i, want in zip(ids, cut_bytes(texts, ids, size), strict=True):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, i
        assert sum(int(b) - int(a) for a, b in (s.split("-") for s in r.spans)) == r.n_removed


def test_suffix_frames(docs_of, small_blocks):
    assert suffixes.dedup_bytes(docs_of([])).count() == 0
    rows = suffixes.dedup_bytes(docs_of(["z" * 20 + "y" * 60] * 4, [None, 5, 5, 6])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in rows) == [(-1, 0), (5, 80), (5, 80), (6, 80)]
    with pytest.raises(ValueError):
        suffixes.dedup_bytes(docs_of([]), 24)


def test_merge_never_loses_order():
    rng = random.Random(4)

    class Run:
        def __init__(self, strings):
            self.strings = sorted(strings)
            self.lcp = [0] + [shared(a, b) for a, b in zip(self.strings, self.strings[1:], strict=False)]

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for k in (1, 2, 3, 7, 8):
        runs = [Run([bytes(rng.choices(b"ab", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))]) for _ in range(k)]
        from_run, common = suffixes.merge_runs(runs)
        at, out = [0] * k, []
        for r in from_run:
            out.append(runs[r].strings[at[r]])
            at[r] += 1
        assert out == sorted(x for r in runs for x in r.strings)
        assert common[1:] == [shared(a, b) for a, b in zip(out, out[1:], strict=False)]


def plain_scores(texts, ids, order, mass):
    counts, tokens = Counter(), {}
    for i, t in zip(ids, texts, strict=True):
        tokens[i] = words = [*(t or "").encode().lower().split(), b" end"]
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            full = [b" start", *words]
            counts.update(tuple(full[a - k + 1 : a + 1]) for a in range(len(full)) for k in range(1, order + 1) if a >= k - 1)
    words = {k: v for k, v in counts.items() if len(k) == 1 and k != (b" start",)}
    n, v = sum(words.values()), len(words)

    def chance(history, w):
        if not history:
            return (counts[(w,)] + 1) / (n + v + 1)
        return (counts[(*history, w)] + mass * chance(history[1:], w)) / (counts[history] + mass)

    out = {}
    for i, found in tokens.items():
        full = [b" start", *found]
        score = sum(math.log10(chance(tuple(full[max(0, a - order + 1) : a]), full[a])) for a in range(1, len(full)))
        base = sum(math.log10(chance((), w)) for w in found)
        out[i] = (len(found), sum(counts[(w,)] > 0 for w in found), n, base, score)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(docs_of, prose, odd, small_blocks, monkeypatch, order):
    monkeypatch.setattr(lm, "PART_KEYS", 500)
    texts = [*prose, *odd]
    ids = [None, *range(1, len(texts))]
    want = plain_scores(texts, ids, order, 3.0)
    rows = lm.score_texts(docs_of(texts, ids).repartition(3), lm.Model(order, 3.0)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, known, trained, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, trained)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_model_sums_to_one(docs_of, small_blocks):
    """Over all words and one unknown word, after a known history."""
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:3]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:6]
    texts = ["a b a c", "a b b", "c a"] + ["a a", "a b", "a c", "a zz", "a", "c"]
    rows = {r.doc_id: r.score for r in lm.score_texts(docs_of(texts, [*train, *held]), lm.Model(2, 2.0)).collect()}
    want = plain_scores(texts, [*train, *held], 2, 2.0)
    assert all(rows[i] == pytest.approx(want[i][4]) for i in held)
    assert lm.score_texts(docs_of([])).count() == 0
    only_held = lm.score_texts(docs_of(["q r", ""], held[:2])).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in only_held] == [(0, 0, 0.0, 0.0)] * 2


def plain_print(text, n):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits):
    label = list(range(len(prints)))
    while True:
        new = [min(label[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= bits) for i in range(len(prints))]
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("bits", [0, 3, 12])
def test_simhash(docs_of, prose, odd, monkeypatch, bits):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 8)
    monkeypatch.setattr(simhash, "_CELL", 4)
    texts = [*prose, *odd]
    prints = [plain_print(t, 3) for t in texts]
    want = classes(prints, bits)
    got = simhash.near_duplicates(docs_of(texts).repartition(3), 3, bits).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]


def test_simhash_random_points(spark, monkeypatch):
    """Links between shards and cells, over fingerprints with many near pairs."""
    monkeypatch.setattr(simhash, "SHARD_POINTS", 50)
    monkeypatch.setattr(simhash, "_CELL", 16)
    rng = random.Random(9)
    points = {rng.getrandbits(64) for _ in range(250)}
    for p in list(points)[:150]:
        q = p
        for _ in range(rng.randint(1, 4)):
            q ^= 1 << rng.randrange(64)
            points.add(q)
    points = sorted(points)
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(points)], "print bigint, node bigint")
    from weirflow.llm.graph import components

    found = {r.node: r.component for r in components(simhash.near_links(nodes, simhash.Near(3))).collect()}
    assert [found.get(i, i) for i in range(len(points))] == classes(points, 3)


def test_simhash_frames(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    rows = simhash.near_duplicates(docs_of(["a b c d e f"] * 4, [None, 8, 8, 9])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (8, 8), (8, 8), (9, 8)]


def similarity(a, b, n=5):
    sets = []
    for t in (a, b):
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies(docs_of, prose):
    texts = [*prose, None, "", None]
    kept = {r.doc_id for r in simhash.near_copies(docs_of(texts).repartition(3)).collect()}
    for i, t in enumerate(texts):
        best = max((similarity(t, texts[j]) for j in range(i)), default=0)
        if best == 1 and (t or "").split() and t in texts[:i]:
            assert i not in kept
        if best >= 0.9 and len(set((t or "").split())) > 50:
            assert i not in kept, i
        if max(similarity(t, u) for j, u in enumerate(texts) if j != i) < 0.6:
            assert i in kept, i
    assert simhash.near_copies(docs_of([])).count() == 0
    rows = simhash.near_copies(docs_of(["a b c d e f g"] * 5, [None, None, 8, 8, 9])).collect()
    assert sorted(r.doc_id or -1 for r in rows) == [-1, -1, 8]


def test_parities_never_rule_out_similar_sets():
    rng = np.random.default_rng(8)
    for n in [1, 2, 5, 40, 63, 64, 65, 128, 300, 1030]:
        x = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut, far = x[: math.ceil(0.8 * n)], rng.integers(0, 1 << 63, n).astype(np.uint64)
        added = np.concatenate([x, far[: n // 4]])
        for y in (x, cut, added):
            assert simhash.may_be_similar(simhash.parities(x), simhash.parities(y), n + len(y), 0.8)
        assert n < 40 or not simhash.may_be_similar(simhash.parities(x), simhash.parities(far), 2 * n, 0.8)


def test_near_copies_with_one_id_for_many_texts(docs_of, prose):
    """A shared id makes no group: the kept texts are those that stay with ids of their own."""
    texts = [t for t in dict.fromkeys(prose) if len(set(t.split())) > 20]
    ids = [7 if i % 3 == 0 else i for i in range(len(texts))]
    expected = least_of_groups(texts, ids, lambda a, b: similarity(a, b) >= 0.8)
    rows = simhash.near_copies(docs_of(texts, ids).coalesce(1)).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((i, texts[at]) for i, at in expected)
    assert sum(r.doc_id == 7 for r in rows) > 15


def test_crowd_of_one_fingerprint():
    """Many points that only sketches tell apart: each joins its leader."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 62, (5, 4)).astype(np.uint64)
    of = rng.integers(0, 5, 1500)
    points = np.zeros((1500, 6), np.uint64)
    points[:, 1] = np.arange(1500)
    points[:, 2:] = centres[of] ^ (np.uint64(1) << rng.integers(0, 60, (1500, 4)).astype(np.uint64))
    links = np.concatenate(simhash.link(points, points[:0], simhash.Near(3, 20)))
    label = list(range(1500))
    for a, b in links.tolist():
        x, y = label[a], label[b]
        if x != y:
            label = [min(x, y) if v in (x, y) else v for v in label]
    assert all((label[i] == label[j]) == (of[i] == of[j]) for i in range(0, 1500, 7) for j in range(0, 1500, 11))
    assert len(links) < 1500 * 6


def test_crowd_with_overlapping_chains():
    """Links between points that are no leaders, and between queries and such points."""
    rng = np.random.default_rng(4)

    def moved(point, bits):
        flat = np.unpackbits(point.view(np.uint8))
        flat[rng.choice(256, bits, replace=False)] ^= 1
        return np.packbits(flat).view(np.uint64)

    sketches = []
    for length in [1, 2, 3, 5, 40, 200, 700]:
        for _ in range(max(1, 90 // length)):
            sketches.append(rng.integers(0, 1 << 63, 4).astype(np.uint64))
            for _ in range(length - 1):
                sketches.append(moved(sketches[-1], 40))
    points = np.zeros((len(sketches), 6), np.uint64)
    points[:, 2:] = np.array(sketches)[rng.permutation(len(sketches))]
    points[:, 1] = np.arange(len(points))
    near = simhash.Near(3, 44)

    def groups(edges):
        label = np.arange(len(points))
        for a, b in edges:
            if label[a] != label[b]:
                label[label == label[a]] = label[b]
        return [np.flatnonzero(label == v).min() for v in label]

    expected = groups(np.argwhere(near.close(points, points)))
    got = np.concatenate(simhash.link(points, points[:0], near)).astype(int)
    assert groups(got) == expected
    own, asks = points[:900], points[900:]
    got = [simhash.link(own, asks, near), simhash.link(asks, asks[:0], near)]
    assert groups(np.concatenate(got[0] + got[1]).astype(int)) == expected
    assert all(near.close(points[[a]], points[[b]])[0, 0] for a, b in np.concatenate(got[0]).astype(int))


def best_of(rows, k):
    usable = [(i, [math.floor(64 * v) for v in x]) for i, x in rows if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for i, q in usable:
        if i % 20 == 0:
            scored = [(sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in usable if j != i and len(c) == len(q)]
            out += [(i, n + 1, j, s) for n, (s, j) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k])]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(0, 1, 24)]) for i in range(700)]
    rows += [(i, rows[i % 50][1]) for i in range(700, 800)]  # ties
    rows += [(800, None), (801, [None] * 24), (802, [float("nan")] * 24), (803, [float("inf")] * 24), (None, rows[0][1])]
    rows += [(820, [1.0, 2.0]), (821, [3.0, -1.0]), (840, []), (841, []), (860, [5.0])]
    rows += [(880, [1e9] * 24), (881, [-1e9] * 24), (882, [0.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x")).repartition(3)
    for block in (1 << 20, 2000):
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, 20, block_bytes=block).collect()
        assert sorted(map(tuple, got)) == best_of(rows, 20)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def least_of_groups(texts, ids, close):
    """The least (id, place) of each connected component of all pairs that are close."""
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and close(texts[i], texts[j]):
                label = [label[j] if v == label[i] else v for v in label]
    return {min((ids[i], i) for i in range(len(texts)) if label[i] == v) for v in set(label)}


def test_near_copies_added_cut_and_edited(docs_of):
    """Every pair from 0.8 up is linked, none below, wherever the copy differs."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abdeilnorstu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    notice = " ".join(rng.choice(words) for _ in range(40))  # many texts end alike
    texts = []
    for k in range(45):
        text = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        n = len(text) - 4
        share = [1, 0.95, 0.85, 0.8, 0.79][k % 5]
        added = text + [rng.choice(words) for _ in range(math.floor(n / share - n + 1e-9))]
        cut = text[: len(text) - math.floor(n * (1 - share) + 1e-9)]
        edited = list(text)
        for at in rng.sample(range(0, len(text) - 5, 5), math.floor(n * (1 - share) / (1 + share) / 5)):
            edited[at] = "edited"
        texts += [" ".join(t) for t in (text, added, cut, edited)]
        texts.append(" ".join(rng.choice(words) for _ in range(30)) + " " + notice)
    rng.shuffle(texts)
    ids = range(len(texts))
    expected = least_of_groups(texts, ids, lambda a, b: similarity(a, b) >= 0.8)
    rows = simhash.near_copies(docs_of(texts).repartition(3)).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in expected)
