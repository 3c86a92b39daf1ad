"""Exact dedup against plain grouping, and the filter against plain counting."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirflow.llm import copies
from weirflow.llm.common import stored
from weirflow.llm.copies import exact_copies, filter_of, merged, read_filter


def expected(rows):
    """(doc_id, text) to sorted result rows."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        rest = sorted(ids, key=lambda i: (i is not None, i or 0))
        out += [(i, keep, len(ids), k == len(rest) - 1, digest) for k, i in enumerate(rest)]
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def arrays(counter, bits):
    keys = np.array(sorted(counter), np.uint64) << np.uint64(64 - bits)
    return keys, np.array([counter[k] for k in sorted(counter)], np.int64)


@settings(max_examples=150, deadline=None)
@given(st.sampled_from([4, 7, 20, 64]), st.data())
def test_filters_are_lossless(bits, data):
    """Read back, and merged, filters give the counts of all keys."""
    lead = data.draw(st.integers(0, min(5, bits - 2)))
    first = data.draw(st.integers(0, 2**lead - 1)) << (bits - lead)
    body = st.integers(0, 2 ** (bits - lead) - 1).map(lambda x: first | x)
    parts = data.draw(st.lists(st.dictionaries(body, st.one_of(st.integers(1, 4), st.integers(1, 10**6)), max_size=40), max_size=4))
    blobs = [filter_of(*arrays(p, bits), lead, bits) for p in parts]
    for p, blob in zip(parts, blobs, strict=True):
        for got, want in zip(read_filter(blob), arrays(p, bits), strict=True):
            assert got.tolist() == want.tolist()
    total = sum((Counter(p) for p in parts), Counter())
    for got, want in zip(merged([read_filter(b) for b in blobs]), arrays(total, bits), strict=True):
        assert got.tolist() == want.tolist()


def test_filter_is_small():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 10_000, np.uint64))
    assert len(filter_of(keys, np.ones(len(keys), np.int64))) < 7 * len(keys)


def test_groups(docs_of, prose, odd):
    texts = [*prose, *odd, "a", "a ", "A", "é", "é"]
    assert result(exact_copies(docs_of(texts))) == expected(list(enumerate(texts)))


@pytest.mark.parametrize("bits", [4, 9, 64])
def test_fingerprints_shared_by_different_texts(docs_of, bits):
    """With four bits every fingerprint stands for many texts; bytes tell them apart."""
    rng = random.Random(bits)
    texts = [f"t{rng.randint(0, 200)}" for _ in range(500)]
    assert result(exact_copies(docs_of(texts).repartition(7), bits=bits)) == expected(list(enumerate(texts)))


def test_ids(docs_of):
    """Missing ids, ids that repeat, one id on a third of all rows, negative ids."""
    texts = ["same"] * 100 + ["", None, " "] * 20 + [f"t{i % 50}" for i in range(140)]
    ids = [None if i % 9 == 0 else 7 if i % 3 == 0 else -i for i in range(len(texts))]
    rows = list(zip(ids, texts, strict=True))
    assert result(exact_copies(docs_of(texts, ids).repartition(11))) == expected(rows)


def test_frames(docs_of):
    assert exact_copies(docs_of([])).count() == 0
    df = docs_of(["x", "x", None]).selectExpr("doc_id AS id", "text AS body", "'a' AS text", "1 AS doc_id", "true AS kept", "0 AS block")
    assert result(exact_copies(df, "id", "body")) == expected([(0, "x"), (1, "x"), (2, None)])
    same = exact_copies(docs_of(["A b", "a B", "c"]), normalize=F.lower)
    assert [r.group_size for r in same.orderBy("doc_id").collect()] == [2, 2, 1]
    with pytest.raises(ValueError):
        exact_copies(df, bits=3)


def test_only_copies_leave_their_block(docs_of, monkeypatch):
    """Texts that occur once stay where they are; a copied one is sent once for each block."""
    tables = {}
    monkeypatch.setattr(copies, "stored", lambda df, name: tables.setdefault(name, stored(df, name)))
    df = exact_copies(docs_of([f"{'word ' * 2000}{i}" for i in range(40)] + ["x"] * 30).coalesce(2))
    assert df.where("group_size > 1").count() == 30
    sent = tables["copies"].where("text IS NOT NULL").collect()
    assert {bytes(r.text) for r in sent} == {b"x"} and len(sent) <= 2
