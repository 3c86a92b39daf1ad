"""Operators that look at one text: extraction, BPE, packing."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirflow.llm import bpe, packing
from weirflow.llm.html import extract_text, main_text

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no, no, no</p>";</script></head>
<body><header><h1>Site, name</h1></header><nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>
<!-- <p>hidden, text</p> --><div class="cookie-notice"><p>We use cookies, many, many of them, every day.</p></div>
<div id="content"><article><h2>A &amp; B&nbsp;C</h2><p>First   paragraph, with <b>bold
text</b>, commas, and enough words to count.<br>After a break.<p>Second, left open, with x &lt; y &#38; &#x41;.
<aside>Related, things, here.</aside><form><label>Name</label><input></form>
<ul><li><a href=1>More like this</a></li><li><a href=2>And this</a></li></ul>
<blockquote>A quoted, short line.</blockquote></article>
<div class="comments"><p>Nice, really, really nice, I liked it, thanks, a lot.</p></div></div>
<div class="sidebar"><p>Buy, now, and, save, a lot, of money.</p></div><footer>&copy; me</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == (
        "A & B C\nFirst paragraph, with bold text, commas, and enough words to count. After a break.\n"
        "Second, left open, with x < y & A.\nA quoted, short line."
    )


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("plain", "plain"), ("<p>just <b>this</p>", "just this"), ("<<>>", "<<>>"),
        ("</p></div>text", "text"), ("<p>a<p>b</p></p>c", "a\nb\nc"), ("<script>no", ""), ("<table><tr><td>x<td>y</table>", "x\ny"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "tag", ["div class='content has-sidebar'", "article class='post category-social'", "div id='page' class='no-comments'",
            "div class='layout with-header'", "div class='fixed-header'", "div class='widget'"],
)
def test_names_that_only_sound_unlikely(tag):
    line = "A long line, with commas, that is surely a part of the article."
    article = f"<{tag}><h1>Title</h1><p>{line}</p><p>{line}</p></{tag.split()[0]}>"
    rest = "<div class='sidebar'><p>Buy, now.</p></div><div class='comments'><p>Nice, very.</p></div>"
    assert main_text(f"<body>{article}{rest}</body>") == f"Title\n{line}\n{line}"
    assert main_text(f"<body><div class='comments'><p>{line}</p></div></body>") == line  # nothing else is there


def test_references_stay():
    line = "A long line, with commas, that is surely a part of the article."
    entries = "".join(f"<li>Writer {k}, 2001: <a href=x>A work of some length and number {k}</a></li>" for k in "abc")
    bare = "<ol class='references'><li><a href=1>One work</a></li><li><a href=2>Other work</a></li></ol>"
    text = main_text(f"<body><article><p>{line}</p><ul>{entries}</ul>{bare}</article></body>")
    assert "Writer b, 2001: A work of some length and number b" in text and text.endswith("One work\nOther work")


def test_long_and_nested_pages():
    assert main_text("<div>" * 50_000 + "deep").strip() == "deep"
    long = "word, " * 50_000
    assert main_text(f"<body><p>{long}</p></body>") == long.strip()
    assert main_text("<" * 50_000) and main_text('<a b="' * 20_000) is not None


def test_pages_table(spark, sf):
    """Against the article element of the test pages."""
    import html
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in extract_text(pages.withColumn("text", F.lit(1))).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)
    assert extract_text(pages.limit(0)).count() == 0


def strange(n):
    rng = random.Random(3)
    letters = list(" \n\t'abcXYZ019.,!é́\xa0 \x1c\x85中😀st<|>endoftxmr")
    fixed = ["a  b", "a \n b", "a\n \nb", "  x  ", "it's we'll ''s", "<|endoftext|>x <|endoftext|>", "aaaa" * 300, "ab" * 700]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_bpe_equals_library(docs_of, odd, prose):
    texts = [*odd, *prose[:20], *strange(500)]
    library = Tokenizer.from_file(BYTES)
    rows = {r.doc_id: r for r in bpe.bpe_round_trip(docs_of(texts).repartition(3), BYTES, with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert rows[i].ids == ids and rows[i].n_tokens == len(ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[i].decoded == decoded and rows[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.bpe_round_trip(docs_of([]), BYTES).count() == 0


def test_merges_against_scan():
    """The segment tree against a scan for the lowest rank, leftmost first."""
    rng = random.Random(5)
    for _ in range(300):
        ranks = {a << 32 | b: r for r, (a, b) in enumerate(rng.sample([(a, b) for a in range(12) for b in range(12)], 30))}
        merged = [rng.randrange(12) for _ in ranks]
        symbols = [rng.randrange(6) for _ in range(rng.randint(0, 40))]
        want = list(symbols)
        while True:
            found = [(ranks[a << 32 | b], i) for i, (a, b) in enumerate(zip(want, want[1:], strict=False)) if a << 32 | b in ranks]
            if not found:
                break
            rank, i = min(found)
            want[i : i + 2] = [merged[rank]]
        assert bpe.merge_pairs(symbols, ranks, merged) == want


def test_packing(docs_of, odd, prose):
    texts = [*odd, *prose, *strange(100)]
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack_sequences(docs_of(texts).repartition(4), WORDS, packing.Capacity(256, 256, 256 * 256)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 256)))
        for r in pieces:
            cut = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == 256 * r.piece and zlib.crc32(cut) == r.ids_crc32
        assert sum(r.length for r in pieces) == len(ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 256) + 3
    assert packing.pack_sequences(docs_of([]), WORDS).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    rng = np.random.default_rng(1)
    counts = {int(n): int(c) for n, c in zip(range(1, 101), rng.integers(0, 50, 100), strict=True) if c}
    capacity = packing.Capacity(100, 7, 10_000, (1.0, 0.2, 0.2), rule)
    runs = packing.plan_sequences(counts, capacity)
    held = {}
    for length, first, sequence, n, offset in runs.tolist():
        for k in range(n):
            held.setdefault(sequence + k, []).append((offset, length, first + k))
    for pieces in held.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 100 and len(pieces) <= 7 and sum(x[1] ** 2 for x in pieces) <= 10_000
    for length, n in counts.items():
        assert sorted(x[2] for p in held.values() for x in p if x[1] == length) == list(range(n))
    with pytest.raises(ValueError):
        packing.Capacity(100, 7, 0)


@pytest.mark.parametrize(
    "capacity,counts,sequences",
    [
        (packing.Capacity(100, 100, 10_000), {50: 4}, 2),  # tokens alone decide
        (packing.Capacity(100, 1, 10_000), {50: 4}, 4),  # documents refuse
        (packing.Capacity(100, 100, 4_999), {50: 4}, 4),  # attention refuses: two cost 5,000
        (packing.Capacity(100, 100, 5_000), {50: 4}, 2),
        (packing.Capacity(100, 100, 2_600), {100: 2, 50: 2, 10: 2}, 4),  # full pieces stand alone, each 50 takes a 10
    ],
)
def test_each_capacity_refuses(capacity, counts, sequences):
    runs = packing.plan_sequences(counts, capacity)
    used = {}
    for length, _, first, pieces, offset in runs.tolist():
        for s in range(first, first + pieces):
            used.setdefault(s, []).append((offset, length))
    assert len(used) == sequences and sum(len(p) for p in used.values()) == sum(counts.values())
    for pieces in used.values():
        lengths = [n for _, n in pieces]
        assert sum(lengths) <= capacity.max_tokens and len(lengths) <= capacity.max_docs
        assert len(lengths) == 1 or sum(n * n for n in lengths) <= capacity.max_attention
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n


def test_sequences_with_ids(docs_of, prose, odd, spark, tmp_path):
    import zlib

    packed = packing.pack_sequences(docs_of([*prose, *odd]), WORDS, packing.Capacity(512, 512, 512**2), with_ids=True)
    rows = packed.collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    packing.write_sequences(packed, str(tmp_path / "s"))
    whole = {r.sequence_id: r for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert set(whole) == {r.sequence_id for r in rows}
    for r in rows:
        assert bytes(whole[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
        assert len(whole[r.sequence_id].ids) <= 4 * 512
