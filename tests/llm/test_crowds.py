"""Near copies in crowds: linear rows, and the groups of brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import simhash
from weirflow.llm.common import stored
from weirflow.llm.simhash import near_copies, shingle_set


def groups_by_force(texts, similarity=0.8, words=5):
    """The first index of each text's group, groups being components of all similar pairs."""
    sets = [shingle_set(t, words) for t in texts]
    every = np.unique(np.concatenate(sets))
    table = np.zeros((len(texts), len(every)), np.float32)
    for i, s in enumerate(sets):
        table[i, np.searchsorted(every, s)] = 1
    same, sizes = table @ table.T, np.array([len(s) for s in sets])
    near = same * (1 + similarity) >= similarity * (sizes[:, None] + sizes[None, :]) - 1e-6
    label = np.arange(len(texts))
    for _ in range(len(texts)):
        least = np.where(near, label[None, :], len(texts)).min(axis=1)
        least = np.minimum(label, least)
        if (least == label).all():
            return label
        label = least
    return label


def word(rng):
    return "".join(rng.choice("abdeilnorstu") for _ in range(rng.randint(3, 8)))


@pytest.fixture(scope="module")
def crowd():
    """Copies of one text with one to nine edits, many of which are no copies of each other, and other texts."""
    rng = random.Random(21)
    hub = [word(rng) for _ in range(120)]
    texts = []
    for _ in range(260):
        mine = list(hub)
        for _ in range(rng.choice([1, 2, 3, 3, 4, 5, 5, 6, 9])):
            mine[rng.randrange(len(mine))] = word(rng)
        texts.append(" ".join(mine))
    # A passage that many texts share, among words of their own: some are mostly that passage.
    passage = [word(rng) for _ in range(40)]
    for k in range(160):
        texts.append(" ".join(passage + [word(rng) for _ in range(rng.choice([2, 4, 30, 80]))]))
    texts += [" ".join(word(rng) for _ in range(60)) for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("long_run,block", [(4, 16), (16, 64), (64, 4096)])
def test_groups_of_a_crowd(docs_of, crowd, monkeypatch, long_run, block):
    monkeypatch.setattr(simhash, "LONG_RUN", long_run)
    monkeypatch.setattr(simhash, "CROWD_BLOCK", block)
    label = groups_by_force(crowd)
    kept = sorted(r.doc_id for r in near_copies(docs_of(crowd)).select("doc_id").collect())
    assert kept == sorted(set(label.tolist()))
    assert 40 < len(kept) < len(crowd) - 100


def test_rows_of_a_crowd_grow_with_its_posts(docs_of, monkeypatch):
    """Pairs that become rows: of a crowd that hangs together, as many as its posts at most."""
    rng = random.Random(3)
    hub = [word(rng) for _ in range(100)]
    tables = {}

    def kept(df, name):
        tables[name] = stored(df, name)
        return tables[name]

    monkeypatch.setattr(simhash, "stored", kept)
    made = []
    for n in (300, 900):
        texts = []
        for _ in range(n):
            mine = list(hub)
            for _ in range(rng.choice([1, 1, 2, 2, 3])):
                mine[rng.randrange(len(mine))] = word(rng)
            texts.append(" ".join(mine))
        tables.clear()
        near_copies(docs_of(texts)).count()
        names = [t for t in tables if t.startswith("stars") or t in ("crowd-pairs", "prefix-pairs")]
        made.append(sum(tables[t].count() for t in names))
        assert made[-1] < 50 * n
    assert made[1] < 4.5 * made[0]


def test_leaders_are_few_and_pairs_cross_groups(spark):
    posts = [(t, n, n % 3 if n < 50 else n, 100, 0) for t in range(4) for n in range(100)]
    df = spark.createDataFrame(posts, "token bigint, node bigint, group bigint, size bigint, place bigint")
    for turn in range(3):
        pairs = simhash._stars(df, turn).collect()
        assert 50 <= len(pairs) <= 100 and all(r.a < r.b for r in pairs)
        group = {n: g for _, n, g, _, _ in posts}
        assert all(group[r.a] != group[r.b] for r in pairs)
    odd = df.select("node").distinct().withColumn("odd", F.lit(bytes(16)))
    pairs = {(r.a, r.b) for r in simhash.crowd_pairs(df, odd, 0.8).collect()}
    want = {(a, b) for a in range(100) for b in range(a + 1, 100) if group[a] != group[b]}
    assert pairs == want
