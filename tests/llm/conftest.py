import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from texts; ids from 0 unless given."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words: some share passages, some are copies with a few words changed."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abdeilnorstu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    texts = [text(rng.randint(5, 300)) for _ in range(60)]
    shared = text(70)
    for k in range(0, 40, 3):
        texts.append(f"{text(20)}\n{shared}\t{text(rng.randint(0, 30))}")
        changed = texts[k].split(" ")
        changed[len(changed) // 2] = "changed"
        texts.append(" ".join(changed))
    texts += [texts[0]] * 5 + [" ".join(["the"] * 90)] * 2 + ["ab " * 200, "ba ab " * 100]
    rng.shuffle(texts)
    return texts


#: Texts that are often handled wrongly.
ODD = [None, "", " \n\t ", "one", "é中 文 😀", "a\x00b \x00", "x" * 20_000, "word " * 5_000, "one", "one"]


@pytest.fixture(scope="session")
def odd():
    return ODD
