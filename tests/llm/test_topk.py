"""Top-k: large values, ties beyond 53 bits, and how much the bounds leave out."""

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F
from test_corpus import best_of

from weirflow.llm import topk


def asked(spark, rows, k):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect())


def exact_best(rows, k):
    """With whole numbers of any size; scores are cut to 64 bits before they are ranked."""
    whole = [(i, [math.floor(Fraction(v) * 64) for v in x]) for i, x in rows]
    out = []
    for i, q in whole:
        if i % 20 == 0:
            scored = [(min(max(sum(a * b for a, b in zip(q, c, strict=True)), -(2**63)), 2**63 - 1), j) for j, c in whole if j != i]
            out += [(i, n + 1, j, s) for n, (s, j) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k])]
    return sorted(out)


def test_large_and_small_values(spark):
    rows = [(0, [1e307, 1.0]), (1, [1e307, -5.0]), (2, [2.0, 3.0]), (3, [-1e300, 0.0]), (20, [1e-300, 2.0]), (21, [0.0, 1.7e308])]
    for k in (1, 3, 9):
        assert asked(spark, rows, k) == exact_best(rows, k)


def test_ties_beyond_floats(spark):
    """Scores of 2**53 and a little: a later tie with a smaller id is not lost, one less is no tie."""
    big = float(2**26)
    rows = [(20, [big, 1 / 64, 1 / 64])] + [(100 + i, [big / 32, (3 + (i % 3)) / 64, 0.0]) for i in range(30)]
    rows += [(i, [big / 32, 5 / 64, 0.0]) for i in range(1, 6)]
    for order in (rows, rows[::-1]):
        assert asked(spark, order, 8) == best_of(rows, 8)


def test_bounds_leave_most_pairs_of_clusters_out():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(50, 32)) * 4
    x = np.concatenate([c + rng.normal(size=(160, 32)) * 0.2 for c in centres])
    ids = rng.permutation(len(x))
    x = x[ids]
    queries = np.arange(0, len(x), 40)
    block = topk._Block(np.arange(len(queries)), queries, x[queries], 10)
    for a in range(0, len(x), 2048):
        block.offer(np.arange(a, min(a + 2048, len(x))), x[a : a + 2048])
    assert block.computed < 0.45 * len(queries) * len(x)
    w = np.floor(64 * x)
    scores = w[queries] @ w.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = -np.sort(-scores, axis=1)[:, :10]
    q, _, found = block.best
    for i in range(len(queries)):
        assert sorted(map(int, found[q == i]), reverse=True) == best[i].astype(int).tolist()
