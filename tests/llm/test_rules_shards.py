import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weirflow.llm import queries, sharding
from weirflow.llm.quality import RULES, Rule, quality_rules
from weirflow.llm.sharding import row_bytes, shard_rows, write_shards


def judged(df):
    return {r.doc_id: r for r in quality_rules(df).collect()}


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


def test_metrics(docs_of, prose, odd):
    texts = [*prose, *odd, "a b c d e f\na b c d e f\n\n \n#x $y|z", "a b c d e a b c d e a b c d e"]
    got = judged(docs_of(texts))
    for i, t in enumerate(texts):
        r, want = got[i], plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(t)[:80]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept <= (not r.base_failed)


def test_verdicts(docs_of, sf, spark):
    stop = "the cat and the dog of it was in a big house with "
    varied = " ".join(f"{stop}{w}" for w in ("x1 q", "y2 r", "z3 s")).replace("the cat", "the cat9", 1)
    clean = "The storm of last night was a surprise to all that live by the sea and it is not over yet"
    good, loud, marked = clean, " ".join(f"{w}!!" for w in clean.split()), " ".join(f"{w}%" for w in clean.split())
    got = judged(docs_of([good, loud, marked, varied]))
    assert got[0].kept and got[0].broken_rules == []
    assert got[1].broken_rules == ["exclamations per word"]
    assert got[2].broken_rules == ["symbols per word"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    wrong = rows.where("quality = 1 and not kept and not base_failed").count()
    assert wrong == 0 and rows.where("quality = 0 and not kept").count() >= 0.9 * rows.where("quality = 0").count()


def test_rules_frame(docs_of):
    df = docs_of(["a b", None]).withColumn("kept", F.lit("input")).withColumn("n_words", F.lit("input"))
    out = quality_rules(df, rules=[*RULES, Rule("never", "n_words", low=10**6)])
    assert [type(r.kept) for r in out.collect()] == [bool, bool]
    assert quality_rules(df.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("n,shards", [(0, 5), (1, 5), (403, 5), (403, 40), (403, 1)])
def test_shards(docs_of, n, shards):
    df = docs_of([None if i % 50 == 0 else "same" if i % 3 == 0 else f"t{i}" for i in range(n)])
    rows = shard_rows(df.withColumn("bytes", row_bytes(df)).withColumn("slot", F.lit("x")), shards, "bytes", bucket_bytes=4000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(n))
    sizes = Counter(r.shard for r in rows)
    assert all(0 <= s < shards for s in sizes) and (n < shards or max(sizes.values()) - min(sizes.values()) <= 1)
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_shards_mix_and_hot_key(docs_of):
    rows = shard_rows(docs_of(["t"] * 900, [7 if i % 3 else i for i in range(900)]), 9, bucket_bytes=2000).collect()
    assert Counter(r.doc_id for r in rows)[7] == 600
    hot = Counter(r.shard for r in rows if r.doc_id == 7)
    assert max(hot.values()) < 95 and min(hot.values()) > 35  # of 100 places each
    plain_order = shard_rows(docs_of(["t"] * 900), 1, bucket_bytes=2000).orderBy("slot").collect()
    ids = [r.doc_id for r in plain_order]
    assert sum(b == a + 1 for a, b in zip(ids, ids[1:], strict=False)) < 20


def test_shard_folders(docs_of, tmp_path, spark):
    sharded = shard_rows(docs_of([f"t{i}" for i in range(50)]), 4)
    write_shards(sharded, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r.shard: r.n for r in back.groupBy("shard").agg(F.count("*").alias("n")).collect()} == {0: 13, 1: 13, 2: 12, 3: 12}


def test_bad_arguments(docs_of):
    with pytest.raises(ValueError):
        shard_rows(docs_of(["a"]), 0)


def test_query_shards_whole_documents(spark, sf, monkeypatch):
    seen = []
    real = sharding.shard_rows
    monkeypatch.setattr(sharding, "shard_rows", lambda df, *a, **k: seen.append((df.columns, a, k)) or real(df, *a, **k))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = queries.QUERIES["op1_sharding"](spark, sf).collect()
    columns, args, named = seen[0]
    assert set(docs.columns) < set(columns) and "bucket_bytes" not in named and len(args) == 2
    expected = sorted((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
