"""Ranked search against plain scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from weirflow.llm.ranked import contributions, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def expected(docs, items, k=10):
    """(id, text) rows of both to sorted result rows."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c, n in counts:
            score, m = 0, 25 + 75 * n * n_docs // n_terms
            for t, q in Counter(plain_terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += q * w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEMS)


@pytest.fixture(scope="module")
def corpus():
    """Common and rare words, many ties, items that occur in documents."""
    rng = random.Random(13)
    words = [f"w{i}" for i in range(400)]
    common = ["the", "of", "Et", "été", "и"]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else words[int(400 * rng.random() ** 3)] for _ in range(n))

    docs = [(i, text(rng.randint(0, 60))) for i in range(600)]
    docs += [(600 + i, docs[i % 7][1]) for i in range(60)]
    items = [(i, text(rng.randint(1, 25))) for i in range(20)] + [(50 + i, docs[i][1]) for i in range(5)]
    items += [(90, None), (91, "..."), (92, "nowhere"), (93, "the the THE"), (93, "the the THE")]
    return docs, items


@pytest.mark.parametrize("slice_docs,bundle", [(8192, 256), (32, 4)])
def test_search(spark, corpus, slice_docs, bundle):
    docs, items = corpus
    want = expected(docs, items)
    assert result(search(*frames(spark, docs, items), slice_docs=slice_docs, bundle=bundle)) == want
    assert len(want) > 200


@pytest.mark.parametrize("owners", [(1.0,), (0.001, 0.002, 0.01, 0.05, 0.2, 0.5, 1.0)])
def test_owners(spark, corpus, owners):
    docs, items = corpus
    assert result(search(*frames(spark, docs, items), k=3, owners=owners, slice_docs=100)) == expected(docs, items, 3)


def test_odd_rows(spark, odd):
    docs = [*enumerate(odd), (None, "one two"), (3, "one two"), (3, "one two"), (None, "two"), (-5, "ONE"), (8, "x" * 300_000 + " one")]
    items = [(None, "one"), (1, "one two ONE"), (2, None), (3, "中 文 é中 😀"), (4, "word"), (5, "a b")]
    assert result(search(*frames(spark, docs, items))) == expected(docs, items)


def test_empty_tables_and_clashes(spark):
    docs, items = frames(spark, [], [(1, "a")])
    assert search(docs, items).count() == 0
    docs, items = frames(spark, [(1, "a b"), (2, "b"), (3, None)], [])
    assert search(docs, items).count() == 0
    docs, items = frames(spark, [(1, "a b"), (2, "b c"), (3, "c")], [(7, "a")])
    clash = docs.selectExpr("*", "'x' AS term", "1 AS score", "2 AS slice", "3 AS item_id")
    assert result(search(clash, items.selectExpr("*", "9 AS rank", "8 AS doc_id"))) == expected([(1, "a b"), (2, "b c"), (3, "c")], [(7, "a")])
    with pytest.raises(ValueError):
        search(docs, items, owners=(0.5,))


def test_terms_and_contributions():
    for text in ["", "A-b_c9", "Été\u0000x ÄÖ", "a\x7fb\x80c"]:
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)
    tf, lengths = np.array([1, 5, 70_000]), np.array([1, 10**7, 3 * 10**9])
    got = contributions(tf, lengths, 10**11, 10**13)
    want = [10**9 * t // (1000 * t + 8 * (25 + 75 * n * 10**11 // 10**13)) for t, n in zip(tf.tolist(), lengths.tolist(), strict=True)]
    assert got.tolist() == want
