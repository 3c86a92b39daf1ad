from test_corpus import cut_words, similarity

import __spark_entry__ as entry
import corpus_pipeline
from weirflow.llm.common import stored


def test_registry():
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf), name.replace(" ", "-")))
    start, good, single, cut, packed = frames
    assert start.columns == good.columns == single.columns == cut.columns
    texts = {r.doc_id: r.text for r in good.collect()}
    kept = {r.doc_id for r in single.collect()}
    assert kept < set(texts)
    order = sorted(texts)
    for i in order:
        best = max((similarity(texts[i], texts[j]) for j in order if j != i), default=0)
        if best < 0.6:
            assert i in kept
        if texts[i] in [texts[j] for j in order if j < i]:
            assert i not in kept
    after = {r.doc_id: r for r in cut.collect()}
    ids = sorted(kept)
    for i, (_, removed, words) in zip(ids, cut_words([texts[i] for i in ids], 20), strict=True):
        assert after[i].text.encode().split() == words
        assert after[i].n_chars == len(after[i].text) and (removed or after[i].text == texts[i])
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_odd_documents(spark, sf):
    """Nulls, repeated rows and ids, very long texts and extra columns, through all stages; and no rows."""
    clean = "The storm of last night was a surprise to all that live by the sea and it is not over yet"
    words = [f"w{i}" for i in range(3000)]
    long = " ".join(f"the {w} of" for w in words)
    passage = " ".join(f"p{i} and" for i in range(30))
    texts = [
        (1, clean), (1, clean), (2, clean), (3, None), (4, ""), (None, clean + " in the end"), (5, long), (6, " \n"),
        (7, f"{passage} the first of the two that have it in them"), (7, f"and this is the other of the two, it has it at the end {passage}"),
        (8, "é中 文 😀 " * 12),
    ]
    rows = [(i, t, "en", "s", None if t is None else len(t), "extra", 1) for i, t in texts]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, n_words int"
    docs = spark.createDataFrame(rows, schema)
    for frame, empty in ((docs, False), (docs.limit(0), True)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, sf), name.replace(" ", "-"))
            assert frame.columns == docs.columns and frame.schema == docs.schema
        packed = corpus_pipeline.STAGES[-1][1](spark, frame, sf)
        assert (packed.count() == 0) == empty
        if empty:
            continue
        left = [(r.doc_id, r.text) for r in frame.collect()]
        ids = sorted(str(i) for i, _ in left)
        assert ids == ["1", "5", "7", "7", "None"], ids  # one of the equal rows; both texts of one id; a row without id
        assert sum(t.count("p29") for _, t in left if t) == 1  # the passage stays where it is first
        assert {r.kept for r in frame.collect()} == {"extra"}
