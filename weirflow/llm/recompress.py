"""Substring dedup by recompression of word sequences.

Every text is parsed bottom up, by rules that look only at a symbol and its neighbour:
first runs of one word become run symbols, then in each round a pair (x, y) becomes one
symbol if x falls on the left side and y on the right side of a coin that is tossed for
each name and round. A name is a hash of what it stands for, so the rounds name runs and
pairs alike all over the corpus without asking anybody. Equal passages thus get equal
symbols, except near their borders, where a neighbour outside may have a part in a symbol.

For every window of ``window`` words the parse tells which symbols depend on the window
alone. They are asked for at the highest level that has some: an exchange counts names over
the corpus, and a window can be a repeat only if all its own symbols are shared. These are
few; each such window is then verified, by a hash of all its words, in a second exchange,
which tells the first document that holds it. Words under a window that started earlier go.

Work is linear in the text. A block asks for each name and each window once, so a passage
that a third of all documents share costs one key for each block.

Windows are compared by 64-bit hashes of word hashes: two different ones are taken for
equal with a probability of 2**-64 for each pair that shares all its symbols.

Defined results: a null or empty text has no words and stays as it is; texts shorter than
the window stay; copies are removed in all but the first document; rows without an id come
first, rows with one id are taken in some fixed order; an empty table gives no rows. All
input columns stay; result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm import blocks as B
from weirflow.llm.common import stored
from weirflow.llm.lm import _mix

ROUNDS = 4
PART_KEYS = 1_000_000
_WORD = re.compile(rb"[^ \t-\r]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_RUN, _PAIR, _COIN = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)


class Words:
    """Word hashes of a block's texts, one after the other."""

    def __init__(self, texts: pa.ChunkedArray) -> None:
        digest = xxhash.xxh64_intdigest
        found = [[] if t is None else t.encode().split() for t in texts.to_pylist()]
        self.counts = np.fromiter(map(len, found), np.int64, len(found))
        self.ends = np.cumsum(self.counts)
        n = int(self.ends[-1]) if len(found) else 0
        self.hashes = np.fromiter((digest(w) for words in found for w in words), np.uint64, n)
        self.doc = np.repeat(np.arange(len(found)), self.counts)

    def windows(self, size: int) -> np.ndarray:
        """Where windows start: they do not cross texts."""
        return np.flatnonzero(np.arange(len(self.hashes)) + size <= self.ends[self.doc])


class Parse:
    """Symbols of each level, and for each window those that depend on it alone.

    ``names[l]`` are the symbols of level l; ``level``, ``low`` and ``high`` give each
    window its symbols: ``names[level][low..high]``, or level -1 if it has none.
    """

    def __init__(self, words: Words, size: int, rounds: int) -> None:
        self.starts = words.windows(size)
        names, doc = words.hashes, words.doc
        low, high = self.starts.copy(), self.starts + size - 1
        self.names = []
        self.level = np.full(len(low), -1)
        self.low, self.high = low.copy(), high.copy()

        # Runs. What is outside may prolong the first and the last run.
        first = np.ones(len(names), bool)
        first[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
        symbol = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        length = np.diff(np.append(at, len(names))).astype(np.uint64)
        names, doc = np.where(length > 1, _mix(names[at] ^ _RUN, length), names[at]), doc[at]
        low, high = symbol[low] + 1, symbol[high] - 1
        self._level(names, low, high)

        # Pairs. The first may be the right half, the last the left half, of a pair with what is outside.
        for r in range(1, rounds + 1):
            right = (_mix(names ^ _COIN, np.full(1, r, np.uint64)) & np.uint64(1)).astype(bool)
            last = len(names) - 1
            open_ = low <= high
            low = np.where(open_ & right[np.minimum(low, last)], low + 1, low)
            high = np.where(open_ & ~right[np.maximum(high, 0)], high - 1, high)
            pair = np.zeros(len(names), bool)
            pair[:-1] = ~right[:-1] & right[1:] & (doc[:-1] == doc[1:])
            first = np.ones(len(names), bool)
            first[1:] = ~pair[:-1]
            symbol = np.cumsum(first) - 1
            at = np.flatnonzero(first)
            joined = names[at].copy()
            pairs = pair[at]
            joined[pairs] = _mix(names[at][pairs] ^ _PAIR, names[at[pairs] + 1])
            open_ = low <= high
            low = np.where(open_, symbol[np.minimum(low, last)], 1)
            high = np.where(open_, symbol[np.maximum(high, 0)], 0)
            names, doc = joined, doc[at]
            self._level(names, low, high)

    def _level(self, names: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.names.append(names)
        some = low <= high
        self.level[some] = len(self.names) - 1
        self.low[some], self.high[some] = low[some], high[some]

    def asked(self) -> Iterator[tuple[int, np.ndarray]]:
        """For each level, the numbers of the symbols that some window asks for."""
        for level, names in enumerate(self.names):
            mine = self.level == level
            cover = np.zeros(len(names) + 1, np.int64)
            np.add.at(cover, self.low[mine], 1)
            np.add.at(cover, self.high[mine] + 1, -1)
            yield level, np.flatnonzero(np.cumsum(cover[:-1]) > 0)

    def keys(self) -> tuple[np.ndarray, np.ndarray, list]:
        """Distinct names asked for, how often (up to 2), and for each level what is where."""
        places, names = [], []
        for level, at in self.asked():
            places.append(at)
            names.append(_mix(self.names[level][at], np.full(1, level, np.uint64)))
        distinct, where, count = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
        cuts = np.cumsum([len(p) for p in places])[:-1]
        return distinct, np.minimum(count, 2).astype("u1"), list(zip(places, np.split(where, cuts), strict=True))

    def shared_windows(self, shared: np.ndarray, places: list) -> np.ndarray:
        """Windows that may be repeats: all their symbols are shared, or they have none."""
        may = self.level < 0
        for level, (at, where) in enumerate(places):
            missing = np.zeros(len(self.names[level]) + 1, np.int64)
            missing[at + 1] = ~shared[where]
            missing = np.cumsum(missing)
            mine = np.flatnonzero(self.level == level)
            may[mine] = missing[self.high[mine] + 1] == missing[self.low[mine]]
        return may


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of the words of each window."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(size):
        out = out * _BASE + hashes[starts + k]
    return _mix(out, np.full(1, size, np.uint64))


def _count(rows: list[tuple]) -> list[tuple[bytes, int]]:
    """For each block's names: 1 where the corpus has the name twice or more."""
    keys = [B.unpack_sorted(k) for _, k, _ in rows]
    counts = np.concatenate([B.unpack(f, "u1") for _, _, f in rows])
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    shared = (np.bincount(where, weights=counts) > 1)[where].astype("u1")
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [(B.pack(s), int(s.sum())) for s in np.split(shared, cuts)]


def _first(rows: list[tuple]) -> list[tuple[bytes, int]]:
    """For each block's windows: 1 where no other block has it in an earlier document."""
    keys = [B.unpack_sorted(k) for _, k, _ in rows]
    every = np.concatenate(keys)
    ids = np.concatenate([B.unpack(f, "<i8") for _, _, f in rows])
    block = np.repeat(np.array([b for b, _, _ in rows]), [len(k) for k in keys])
    order = np.lexsort((block, ids, every))
    first = np.zeros(len(every), "u1")
    sorted_keys = every[order]
    first[order] = np.concatenate([np.ones(min(1, len(every)), bool), sorted_keys[1:] != sorted_keys[:-1]])
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [(B.pack(f), 0) for f in np.split(first, cuts)]


def _spans(removed: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of removed words, as (first, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], removed.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans``; what stands between kept words stays.

    A removed run takes the white space after it along.
    """
    if not spans:
        return text
    raw = text.encode()
    at = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out, pos = [], 0
    for a, b in spans:
        out.append(raw[pos : at[a]])
        pos = at[b]
    return b"".join([*out, raw[pos:]]).decode()


def dedup_passages(
    docs: DataFrame, window: int = 20, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows with repeated passages cut from the text.

    ``n_words`` and ``n_removed`` count words before and those removed, ``removed_spans``
    gives the removed runs as "first-end" word numbers.
    """
    if window < 2 or rounds < 0:
        raise ValueError("window: at least 2; rounds: at least 0")
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_removed", "removed_spans")
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    held = B.store_blocks(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    parts = B.parts_for(spark, int(size) // 20, PART_KEYS)

    def parsed(row: dict) -> tuple[pa.Table, Words, Parse]:
        table = B.unpack_rows(row["rows"])
        words = Words(table.column(text_col))
        return table, words, Parse(words, window, rounds)

    def ask_names(row: dict) -> Iterator[pa.RecordBatch]:
        _, _, parse = parsed(row)
        keys, counts, _ = parse.keys()
        yield B.sent_batch(row["block"], keys, counts, parts)

    names = stored(B.answered(B.each_block(held, ask_names, B.SENT), parts, _count), "names")

    def repeats(row: dict) -> tuple:
        """Windows to verify, their distinct hashes, and which is each window's."""
        table, words, parse = parsed(row)
        _, _, places = parse.keys()
        shared = B.joined(row["names"], "u1").astype(bool)
        starts = parse.starts[parse.shared_windows(shared, places)]
        hashes = window_hashes(words.hashes, starts, window)
        distinct, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        return table, words, starts, distinct, first, where

    def ask_windows(row: dict) -> Iterator[pa.RecordBatch]:
        table, words, starts, distinct, first, _ = repeats(row)
        ids = B.ids_of(table, id_col)[words.doc[starts[first]]]
        yield B.sent_batch(row["block"], distinct, ids, parts)

    sent = B.each_block(B.with_answers(held, names=names), ask_windows, B.SENT)
    firsts = stored(B.answered(sent, parts, _first), "windows")
    fields = [f for f in docs.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", n_words bigint, n_removed bigint, removed_spans array<string>"

    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        table, words, starts, _, first, where = repeats(row)
        is_first = np.zeros(len(starts), bool)
        is_first[first] = B.joined(row["firsts"], "u1").astype(bool)
        cover = np.zeros(len(words.hashes) + 1, np.int64)
        gone = starts[~is_first]
        cover[: len(words.hashes)] += np.bincount(gone, minlength=len(words.hashes))
        ends = np.bincount(gone + window, minlength=len(cover))
        removed = np.cumsum(cover - ends)[:-1] > 0
        begins = words.ends - words.counts
        total = np.concatenate([[0], np.cumsum(removed)])
        n_removed = total[words.ends] - total[begins]
        texts, spans = table.column(text_col).to_pylist(), [[] for _ in begins]
        for d in np.flatnonzero(n_removed):
            found = _spans(removed[begins[d] : words.ends[d]])
            texts[d] = cut_words(texts[d], found)
            spans[d] = [f"{a}-{b}" for a, b in found]
        at = table.column_names.index(text_col)
        kept = table.set_column(at, text_col, pa.array(texts, pa.string()))
        kept = kept.append_column("n_words", pa.array(words.counts))
        kept = kept.append_column("n_removed", pa.array(n_removed.astype(np.int64)))
        kept = kept.append_column("removed_spans", pa.array(spans, pa.list_(pa.string())))
        yield from kept.combine_chunks().to_batches()

    return B.each_block(B.with_answers(held, names=names, firsts=firsts), cut, schema)
