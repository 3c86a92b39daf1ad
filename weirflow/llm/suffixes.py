"""Suffix dedup of bytes by a common-prefix-aware distributed merge sort.

Asked is, for every string of ``size`` bytes, whether it also starts in an earlier document.

1. Which suffixes. Of the 24-byte grams inside a window of ``size`` bytes the one with the
   least hash (the leftmost of them) is its anchor. Equal windows have equal anchors, so
   only suffixes that start at anchors are sorted, about one in fourteen; a window at
   distance ``o`` before its anchor is repeated if an earlier document has a suffix at an
   anchor that shares ``size - o`` bytes to the right and ``o`` bytes to the left. An
   exchange of gram hashes leaves out anchors whose gram occurs in one document only.
2. Sort. A block sorts its suffixes (``size`` bytes) and sends them as front-coded runs:
   the length of the prefix shared with the string before, and the rest. Equal suffixes
   with equal left sides are sent once. Runs go to the task that owns the gram's range.
3. Merge. A loser tree combines the runs of all blocks. Each contender carries the prefix
   length that it is known to share with the last winner; longer prefixes win, and bytes
   are compared only from there on, so that no known prefix is compared again. The output
   is the sorted order with the common prefix of neighbours.
4. Answer. In that order, suffixes with ``size - o`` bytes in common are neighbours; those
   among them with the same ``o`` bytes on the left form a group, whose least document
   keeps its window. Each suffix is answered with a bit for each ``o``.

Work is linear in the text up to sorting. A passage that many documents share is sent once
by each block, whatever the number of its copies. Left sides are compared by 64-bit
hashes, suffixes byte by byte.

Defined results: a null text counts as empty; matches never cross texts; a text shorter
than ``size`` stays; rows without an id come before all others and, having one id, leave
each other alone, as rows with equal ids do; an empty table gives no rows. All input
columns stay; result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm import blocks as B
from weirflow.llm.common import stored
from weirflow.llm.lm import _mix

GRAM = 24
PART_KEYS = 500_000


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes that start at each place (there are len(data) - 23 of them)."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    word = data.astype(np.uint64)
    for width in (1, 2, 4):
        word = word[: len(word) - width] | (word[width:] << np.uint64(8 * width))
    return _of_words(word[:n], word[8 : 8 + n], word[16 : 16 + n])


def _of_words(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return _mix(_mix(first ^ np.uint64(0x8EBC6AF09C88C6E3), second), third)


def _spread(hashes: np.ndarray) -> np.ndarray:
    """Anchors have the least hashes of their windows, which crowd; mixed again they fill all ranges alike."""
    return _mix(hashes, np.uint64(0xD6E8FEB86659FD93))


class Anchors:
    """The texts of a block as one byte array, and the anchors of its windows.

    ``at`` are the anchors' places where they are known already.
    """

    def __init__(self, texts: pa.ChunkedArray, size: int, at: np.ndarray | None = None) -> None:
        raw = [b"" if t is None else t.encode() for t in texts.to_pylist()]
        self.lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(self.lengths)
        self.raw = b"".join(raw)
        self.data = np.frombuffer(self.raw, np.uint8)
        n_windows = np.maximum(self.lengths - size + 1, 0)
        begin = self.ends - self.lengths
        if at is None:
            hashes = gram_hashes(self.data)
            at = self._least(hashes, size - GRAM + 1, begin, n_windows) if n_windows.sum() else np.zeros(0, np.int64)
            self.hash = _spread(hashes[at])
        else:
            words = _rows_at(self.data, at, GRAM).view("<u8")
            self.hash = _spread(_of_words(words[:, 0], words[:, 1], words[:, 2]))
        self.at = at
        self.doc = np.searchsorted(self.ends, self.at, "right")
        self.left = np.minimum(self.at - begin[self.doc], size - GRAM)
        self.right = np.minimum(self.ends[self.doc] - self.at, size)

    @staticmethod
    def _least(hashes: np.ndarray, span: int, begin: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
        """Places of the leftmost least hash in ``span`` places, over all windows."""
        least, place = hashes, np.arange(len(hashes), dtype=np.int32 if len(hashes) < 1 << 31 else np.int64)
        width = 1
        while width < span:
            step = min(width, span - width)
            a, b = least[: len(least) - step], least[step:]
            left = a <= b
            place = np.where(left, place[: len(a)], place[step:])
            least = np.where(left, a, b)
            width += step
        starts = np.zeros(len(place) + 1, np.int32)
        some = n_windows > 0
        starts[begin[some]] += 1
        stop = (begin + n_windows)[some]
        starts -= np.bincount(stop, minlength=len(starts)).astype(np.int32)
        inside = np.cumsum(starts[:-1]) > 0
        found = np.zeros(len(hashes), bool)
        found[place[inside]] = True
        return np.flatnonzero(found)


def _rows_at(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes from each place; zero beyond the array."""
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, width)[at])


class Suffixes:
    """The distinct suffixes of a block, sorted, and which of them each anchor is.

    A suffix is its bytes (``rows``, zero after the end of the text) with their number, and
    the bytes before it with theirs. Sorted by part, bytes, right length, left side.
    """

    def __init__(self, anchors: Anchors, use: np.ndarray, ids: np.ndarray, size: int, parts: int) -> None:
        a = anchors
        self.use = use
        right = a.right[use]
        rows = _rows_at(a.data, a.at[use], size)
        rows[np.arange(size)[None, :] >= right[:, None]] = 0
        n_left = a.left[use]
        side = size - GRAM
        before = np.concatenate([np.zeros(side, np.uint8), a.data])
        left = _rows_at(before, a.at[use], side)[:, ::-1].copy()  # the byte next to the anchor comes first
        left[np.arange(side)[None, :] >= n_left[:, None]] = 0
        part = B.part_of(a.hash[use], parts).astype(">u4")
        record = np.concatenate(
            [part.view(np.uint8).reshape(-1, 4), rows, right.astype(np.uint8)[:, None], n_left.astype(np.uint8)[:, None], left],
            axis=1,
        )
        width = record.shape[1]
        whole = np.ascontiguousarray(record).view(f"V{width}").ravel() if len(use) else np.zeros(0, f"V{width}")
        order = np.argsort(_sortable(record), kind="stable") if len(use) else np.zeros(0, np.int64)
        new = np.ones(len(order), bool)
        new[1:] = whole[order[1:]] != whole[order[:-1]]
        self.where = np.empty(len(order), np.int64)
        self.where[order] = np.cumsum(new) - 1
        first = order[new]  # stable: the occurrence in the first document of the block
        self.first_doc = a.doc[use][first]
        self.part = part.astype(np.int64)[first]
        self.rows, self.right = rows[first], right[first]
        self.left, self.n_left = left[first], n_left[first]
        self.ids = ids[self.first_doc]


def _sortable(record: np.ndarray) -> np.ndarray:
    """Rows of bytes as fixed-size strings that numpy sorts in byte order."""
    return np.ascontiguousarray(record).view(f"S{record.shape[1]}").ravel()


def common_prefix(rows: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each sorted row, how many bytes it shares with the one before."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[1:] = np.minimum(shared, np.minimum(right[1:], right[:-1]))
    return out


RUN = "block bigint, part int, run binary"
_PLACES = "block bigint, part int, answer binary"


def front_coded(s: Suffixes, a: int, b: int) -> bytes:
    """Suffixes a to b of a block as a run: shared prefix lengths, the rest, left sides, ids."""
    rows, right = s.rows[a:b], s.right[a:b]
    shared = common_prefix(rows, right)
    columns = np.arange(rows.shape[1])[None, :]
    rest = rows[(columns >= shared[:, None]) & (columns < right[:, None])]
    left = s.left[a:b][np.arange(s.left.shape[1])[None, :] < s.n_left[a:b, None]]
    table = pa.table(
        {
            "blob": [
                B.pack(shared.astype(np.uint8)), B.pack(right.astype(np.uint8)), B.pack(rest),
                B.pack(s.n_left[a:b].astype(np.uint8)), B.pack(left), B.pack(s.ids[a:b]),
            ]
        }
    )
    return B.pack_rows(table)


class Run:
    """A sorted run as it arrives: strings, shared prefixes, left sides, ids."""

    def __init__(self, blob: bytes, size: int) -> None:
        shared, right, rest, n_left, left, ids = B.unpack_rows(blob).column("blob").to_pylist()
        self.shared = B.unpack(shared, "u1").astype(np.int64)
        self.right = B.unpack(right, "u1").astype(np.int64)
        self.n_left = B.unpack(n_left, "u1").astype(np.int64)
        self.ids = B.unpack(ids, "<i8")
        n = len(self.shared)
        self.left = np.zeros((n, size - GRAM), np.uint8)
        self.left[np.arange(size - GRAM)[None, :] < self.n_left[:, None]] = B.unpack(left, "u1")
        bytes_left = B.unpack(rest, "u1").tobytes()
        self.strings, before, at = [], b"", 0
        for keep, length in zip(self.shared.tolist(), self.right.tolist(), strict=True):
            take = length - keep
            before = before[:keep] + bytes_left[at : at + take]
            at += take
            self.strings.append(before)
        self.lcp = self.shared.tolist()


def merge_runs(runs: list[Run]) -> tuple[list[int], list[int]]:
    """Loser-tree merge: for each output, its run, and the prefix shared with the one before.

    ``known[r]`` is the prefix that run r's head shares with the last string that beat it or
    was put out before it. The longer it is, the smaller the head; only equal ones are
    compared, from that length on.
    """
    if len(runs) == 1:
        return [0] * len(runs[0].strings), runs[0].lcp
    k = 1 << (max(1, len(runs)) - 1).bit_length()
    heads: list[bytes | None] = [r.strings[0] if r.strings else None for r in runs] + [None] * (k - len(runs))
    known = [0 if h is not None else -1 for h in heads]
    place = [0] * k
    strings, lcps = [r.strings for r in runs], [r.lcp for r in runs]

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        p, q = known[x], known[y]
        if p != q:
            return (x, y) if p > q else (y, x)
        if p < 0:
            return x, y
        a, b = heads[x], heads[y]
        n = min(len(a), len(b))
        if a[p:n] == b[p:n]:
            p = n
            x, y = (x, y) if len(a) <= len(b) else (y, x)
        else:
            while a[p] == b[p]:
                p += 1
            if a[p] > b[p]:
                x, y = y, x
        known[y] = p
        return x, y

    losers = [0] * k

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, loser = play(build(2 * node), build(2 * node + 1))
        losers[node] = loser
        return winner

    champion = build(1) if k > 1 else 0
    from_run, shared = [], []
    while known[champion] >= 0:
        from_run.append(champion)
        shared.append(known[champion])
        i = place[champion] + 1
        if i < len(strings[champion]):
            place[champion] = i
            heads[champion], known[champion] = strings[champion][i], lcps[champion][i]
        else:
            heads[champion], known[champion] = None, -1
        node, winner = (champion + k) >> 1, champion
        while node:
            loser = losers[node]
            # Most games are decided by what is known; play() compares the others.
            if known[winner] == known[loser]:
                winner, losers[node] = play(winner, loser)
            elif known[winner] < known[loser]:
                losers[node], winner = winner, loser
            node >>= 1
        champion = winner
    return from_run, shared


def repeated(shared: np.ndarray, right: np.ndarray, left: np.ndarray, n_left: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """For each suffix in sorted order, bit o: its window at distance o started in a smaller id."""
    out = np.zeros(len(shared), np.uint64)
    side = np.zeros(len(shared), np.uint64)
    for o in range(size - GRAM + 1):
        if o:
            side = _mix(side, left[:, o - 1].astype(np.uint64) + np.uint64(1))
        group = np.cumsum(shared < size - o)
        fits = np.flatnonzero((n_left >= o) & (right >= size - o))
        # Alone in its group: nothing to look at.
        crowd = np.bincount(group[fits], minlength=len(shared) + 2)
        fits = fits[crowd[group[fits]] > 1]
        if not len(fits):
            continue
        key = _mix(group[fits].astype(np.uint64), side[fits])
        order = np.lexsort((ids[fits], key))
        key, own = key[order], ids[fits][order]
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        least = own[begins][np.cumsum(begins) - 1]
        out[fits[order[own > least]]] |= np.uint64(1 << o)
    return out


def _in_two(rows: list[tuple]) -> list[tuple[bytes, int]]:
    """For each block's grams: 1 where two documents of the corpus have the gram."""
    keys = [B.unpack_sorted(k) for _, k, _ in rows]
    counts = np.concatenate([B.unpack(f, "u1") for _, _, f in rows])
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    shared = (np.bincount(where, weights=counts) > 1)[where].astype("u1")
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [(B.pack(s), int(s.sum())) for s in np.split(shared, cuts)]


def dedup_bytes(
    docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` and ``kept_sha256``.

    ``spans`` lists the removed runs as "first-end" byte numbers; the text stays as it is,
    as a cut may fall inside a character. ``size`` may be 25 to 87.
    """
    if not GRAM < size < GRAM + 64:
        raise ValueError(f"size: {GRAM + 1} to {GRAM + 63}")
    spark = docs.sparkSession
    added = ["n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"]
    docs = docs.drop(*added).withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    held = B.store_blocks(docs, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    parts = B.parts_for(spark, int(total) // 12, PART_KEYS)

    def anchored(row: dict) -> tuple[pa.Table, Anchors]:
        table = B.unpack_rows(row["rows"])
        known = row.get("marks")
        at = None if known is None else np.cumsum(B.unpack(known[0]["answer"], "<u4"), dtype=np.int64)
        return table, Anchors(table.column(text_col), size, at)

    def grams(a: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct grams, in how many documents (up to 2), and which is each anchor's."""
        keys, first, where = np.unique(a.hash, return_index=True, return_inverse=True)
        several = np.zeros(len(keys), bool)
        several[where[a.doc != a.doc[first][where]]] = True
        return keys, 1 + several.astype("u1"), where

    # What costs most is done once and stored: where the anchors are, then which suffix each is.
    def find(row: dict) -> Iterator[pa.RecordBatch]:
        at = anchored(row)[1].at
        yield B.record_batch([(row["block"], 0, B.pack(np.diff(at, prepend=0).astype("<u4")))], _PLACES)

    marks = stored(B.each_block(held, find, _PLACES), "anchors")

    def ask_grams(row: dict) -> Iterator[pa.RecordBatch]:
        keys, counts, _ = grams(anchored(row)[1])
        yield B.sent_batch(row["block"], keys, counts, parts)

    asked = B.each_block(B.with_answers(held, marks=marks), ask_grams, B.SENT)
    shared = stored(B.answered(asked, parts, _in_two), "grams")

    def send_runs(row: dict) -> Iterator[pa.RecordBatch]:
        table, a = anchored(row)
        _, _, where = grams(a)
        use = np.flatnonzero(B.joined(row["grams"], "u1").astype(bool)[where])
        s = Suffixes(a, use, B.ids_of(table, id_col), size, parts)
        cuts = np.searchsorted(s.part, np.arange(parts + 1))
        rows = [(row["block"], p, front_coded(s, x, y), None) for p, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
        found = [B.pack(np.diff(use, prepend=0).astype("<u4")), B.pack(s.where.astype("<u4")), B.pack(s.first_doc.astype("<u4"))]
        rows.append((row["block"], 0, None, B.pack_rows(pa.table({"blob": found}))))
        yield B.record_batch(rows, f"{RUN}, answer binary")

    def merged(rows: list[tuple]) -> list[tuple[bytes, int]]:
        runs = [Run(blob, size) for _, blob in rows]
        from_run, common = merge_runs(runs)
        order = np.argsort(np.array(from_run, np.int64), kind="stable")  # run after run, as they came
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        take = lambda name: np.concatenate([getattr(r, name) for r in runs])[place]
        bits = repeated(np.array(common), take("right"), take("left"), take("n_left"), take("ids"), size)
        cuts = np.cumsum([len(r.lcp) for r in runs])[:-1]
        return [(B.pack(x), 0) for x in np.split(bits[order], cuts)]

    runs = stored(B.each_block(B.with_answers(held, grams=shared, marks=marks), send_runs, f"{RUN}, answer binary"), "runs")
    places = runs.where("answer IS NOT NULL").select("block", "part", "answer")
    bits = stored(B.answered(runs.where("answer IS NULL").drop("answer"), parts, merged), "suffixes")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema += ", n_bytes bigint, n_removed bigint, n_spans bigint, spans array<string>, kept_sha256 string"

    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        table, a = anchored(row)
        gaps, where, first_doc = B.unpack_rows(row["places"][0]["answer"]).column("blob").to_pylist()
        use, where = np.cumsum(B.unpack(gaps, "<u4"), dtype=np.int64), B.unpack(where, "<u4").astype(np.int64)
        anchor_bits = B.joined(row["bits"], "<u8")[where]
        # A copy of a suffix of an earlier document in this block: each of its windows is repeated.
        ids = B.ids_of(table, id_col)
        later = ids[a.doc[use]] > ids[B.unpack(first_doc, "<u4").astype(np.int64)][where]
        at, left, right = a.at[use], a.left[use], a.right[use]
        change = np.zeros(len(a.data) + 1, np.int64)
        some = np.flatnonzero(later | (anchor_bits != 0))
        for o in range(size - GRAM + 1):
            gone = (anchor_bits[some] & np.uint64(1 << o)) != 0
            gone |= later[some] & (left[some] >= o) & (right[some] >= size - o)
            start = at[some[gone]] - o
            # Places of a block's anchors differ, so each place is met once.
            change[start] += 1
            change[start + size] -= 1
        removed = np.cumsum(change[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(removed)])
        begins = a.ends - a.lengths
        n_removed = total[a.ends] - total[begins]
        spans, digests = [[] for _ in begins], []
        for d, (x, y) in enumerate(zip(begins.tolist(), a.ends.tolist(), strict=True)):
            kept = a.raw[x:y]
            if n_removed[d]:
                gone = removed[x:y]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans[d] = [f"{p}-{q}" for p, q in zip(edge[::2], edge[1::2], strict=True)]
                kept = a.data[x:y][~gone].tobytes()
            digests.append(hashlib.sha256(kept).hexdigest())
        columns = [
            pa.array(a.lengths), pa.array(n_removed.astype(np.int64)),
            pa.array([len(x) for x in spans], pa.int64()), pa.array(spans, pa.list_(pa.string())), pa.array(digests),
        ]
        for name, column in zip(added, columns, strict=True):
            table = table.append_column(name, column)
        yield from table.combine_chunks().to_batches()

    return B.each_block(B.with_answers(held, marks=marks, places=places, bits=bits), cut, schema)
