"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to a few owners, rare terms to the first and common ones to the last, by the share
of the documents that hold them. Items travel in bundles, one for each slice of the documents,
from owner to owner. A bundle carries sparse accumulators: for each item the documents of the slice
that have scored so far, and their sums. At each owner the bundle is cogrouped with the postings
of its terms, integer contributions are added, and the bundle goes on. After the last owner each
bundle gives its best documents, and Spark ranks these for each item.

A slice is some thousand documents that one task read, sorted by id, so accumulators and postings
of a bundle are bounded however many documents hold a term. Only postings of the items' terms are
written: the tasks that read the documents know a table of a fixed number of bits, set by the
hashes of these terms; what passes it by chance finds no item later. Documents are never dealt
anew, texts never move.

Owners leave out what cannot matter, by a bound and never by a count: a document that is ``k``-th
best in its slice has a sum that the final score cannot fall below; what a document may still gain
is at most a million times the weights of the item's terms at the owners to come. Documents that
cannot reach that sum any more are dropped, and once no new document can reach it, none is added.
Ties stay, so results are exact.

Defined results: null and term-less texts count in no statistic and are never found; items without
a term give no rows, repeated items are ranked one by one; equal scores go by ascending id, rows
without an id last; repeated ids are documents of their own; empty tables give no rows. Other
columns are left out.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import release, stored
from weirflow.llm.lm import pack, unpack

SLICE_DOCS = 8_192
SLICE_BYTES = 64 << 20
#: Items that travel together.
BUNDLE = 256
#: An owner has the terms that at most this share of the documents hold, and the one before has not.
OWNERS = (1 / 64, 1 / 12, 1 / 4, 1.0)
#: Bits that say which terms the items have: a table of 256 KB.
MARKS = 1 << 21
#: No contribution reaches this many times its weight.
MOST = 1_000_000

_RESULT = "item_id {}, rank int, doc_id bigint, score bigint"
#: Digits, letters in lower case and all bytes above 127 stay; everything else parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


# -- tables --------------------------------------------------------------------------------


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term, q): q times the term in the item; items are numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                rows.append([(item, t, q) for t, q in Counter(terms_of(text or "")).items()])
                item += 1
            where = [i for i, found in enumerate(rows) for _ in found]
            flat = list(zip(*(x for found in rows for x in found), strict=True)) or [(), (), ()]
            arrays = [
                pa.array(flat[0], pa.int64()), batch.column(0).take(pa.array(where, pa.int64())),
                pa.array(flat[1], pa.binary()), pa.array(flat[2], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "term", "q"])

    kind = items.schema[item_col].dataType.simpleString()
    narrow = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stored(narrow.mapInArrow(run, f"item bigint, item_id {kind}, term binary, q bigint"), "items")


class _Slice:
    """Documents of one task, until there are enough, and the postings of wanted terms."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.size = 0
        self.postings: dict[bytes, tuple[array, array]] = {}

    def add(self, doc_id: int | None, text: str, wanted: bytes) -> None:
        words = terms_of(text)
        self.size += len(text)
        if not words:
            return
        at = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        crc, mask, postings = zlib.crc32, MARKS - 1, self.postings
        for term, tf in Counter(words).items():
            h = crc(term) & mask
            if wanted[h >> 3] >> (h & 7) & 1:
                mine = postings.get(term)
                if mine is None:
                    mine = postings[term] = (array("I"), array("q"))
                mine[0].append(at)
                mine[1].append(tf)

    def rows(self) -> pa.RecordBatch:
        """The slice's documents in one row without a term, then a row for each term."""
        lengths = np.array(self.lengths, np.int64)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        order = np.lexsort((ids, np.array([i is None for i in self.ids], bool)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        out = [(self.number, None, len(ids), int(lengths.sum()), None, None, None, [self.ids[i] for i in order])]
        for term, (at, tf) in self.postings.items():
            at, tf = np.frombuffer(at, np.uint32).astype(np.int64), np.frombuffer(tf, np.int64)
            by_place = np.argsort(place[at])
            docs = place[at][by_place]
            gaps = np.diff(docs, prepend=0).astype("<u4")
            out.append((self.number, term, len(ids), len(docs), pack(gaps), pack(tf[by_place]), pack(lengths[at][by_place]), None))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _INDEX_NAMES)


_INDEX = "slice bigint, term binary, docs bigint, n bigint, at binary, tf binary, length binary, ids array<bigint>"
_INDEX_NAMES = [f.split()[0] for f in _INDEX.split(", ")]


def _index(docs: DataFrame, id_col: str, text_col: str, wanted: bytes, slice_docs: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _Slice(TaskContext.get().partitionId() << 28)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    now.add(doc_id, text or "", wanted)
                    if len(now.ids) >= slice_docs or now.size >= SLICE_BYTES:
                        yield now.rows()
                        now = _Slice(now.number + 1)
        yield now.rows()
        release()

    narrow = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stored(narrow.mapInArrow(run, _INDEX), "postings")


# -- owners --------------------------------------------------------------------------------


def contributions(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) for each posting, m from the document's length; 64-bit, or exact beyond."""
    scaled = lengths.astype(object) if 75 * int(lengths.max(initial=0)) * n_docs >= 1 << 63 else lengths
    m = 25 + (75 * n_docs * scaled) // n_terms
    return ((10**9 * tf) // (1000 * tf + 8 * m)).astype(np.int64)


_CARRIED = "slice bigint, bundle int, item bigint, closed boolean, docs binary, scores binary"
_CARRIED_TYPE = pa.schema(
    [("slice", pa.int64()), ("bundle", pa.int32()), ("item", pa.int64()), ("closed", pa.bool_()), ("docs", pa.binary()), ("scores", pa.binary())]
)


def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Where the k highest are, ties to smaller docs; docs are ascending."""
    if len(docs) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(docs))
    return some[np.argsort(-scores[some], kind="stable")][:k]


def _owner(k: int, n_docs: int, n_terms: int, last: bool):
    """A bundle meets the postings of its terms that this owner has."""

    def visit(key: tuple, carried: pa.Table, postings: pa.Table) -> pa.Table:
        number, bundle = (x.as_py() for x in key)
        sums: dict[int, tuple[bool, np.ndarray, np.ndarray]] = {}
        for item, closed, docs, scores in zip(*(carried.column(c).to_pylist() for c in ("item", "closed", "docs", "scores")), strict=True):
            sums[item] = closed, unpack(docs, "<u4").astype(np.int64), unpack(scores, "<i8")
        gains: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        to_come: dict[int, int] = {}
        for at, tf, length, w, asked in zip(*(postings.column(c).to_pylist() for c in ("at", "tf", "length", "w", "asked")), strict=True):
            docs = np.cumsum(unpack(at, "<u4"), dtype=np.int64)
            gain = w * contributions(unpack(tf, "<i8"), unpack(length, "<i8"), n_docs, n_terms)
            for a in asked:
                gains.setdefault(a["item"], []).append((docs, gain if a["q"] == 1 else a["q"] * gain))
                to_come[a["item"]] = a["to_come"]
        size = postings.column("docs")[0].as_py() if postings.num_rows else 0
        out = []
        for item in sums.keys() | gains.keys():
            closed, docs, scores = sums.get(item, (False, np.zeros(0, np.int64), np.zeros(0, np.int64)))
            if item in gains:
                dense = np.zeros(size, np.int64)
                for where, gain in gains[item]:
                    dense[where] += gain
                if closed:
                    scores = scores + dense[docs]
                else:
                    dense[docs] += scores
                    docs = np.flatnonzero(dense)
                    scores = dense[docs]
                if len(docs) > k:
                    sure = int(np.partition(scores, len(scores) - k)[len(scores) - k])
                    rest = to_come[item]
                    closed = closed or rest < sure
                    keep = scores + rest >= sure
                    docs, scores = docs[keep], scores[keep]
            if last:
                best = _best(docs, scores, k)
                docs, scores = docs[best], scores[best]
            if len(docs):
                out.append((number, bundle, item, closed, pack(docs.astype("<u4")), pack(scores)))
        columns = list(zip(*out, strict=True)) or [()] * 6
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CARRIED_TYPE, strict=True)], schema=_CARRIED_TYPE)

    return visit


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for number, item, docs, scores in zip(*(batch.column(c).to_pylist() for c in ("slice", "item", "docs", "scores")), strict=True):
            rows += [(number, item, d, s) for d, s in zip(unpack(docs, "<u4").tolist(), unpack(scores, "<i8").tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slice", "item", "at", "score"])


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    item_col: str = "item_id",
    text_col: str = "text",
    id_col: str = "doc_id",
    owners: Sequence[float] = OWNERS,
    slice_docs: int = SLICE_DOCS,
    bundle: int = BUNDLE,
) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score."""
    if k < 1 or slice_docs < 1 or bundle < 1 or list(owners) != sorted(owners) or owners[-1] < 1:
        raise ValueError("k, slice_docs, bundle: at least 1; owners: ascending shares up to 1")
    spark = docs.sparkSession
    asked = _item_terms(items, item_col, text_col)
    mark = F.pmod(F.crc32("term"), F.lit(MARKS)).cast("int")
    marks = np.zeros(MARKS, np.uint8)
    marks[[r[0] for r in asked.select(mark).distinct().collect()]] = 1  # at most MARKS numbers
    index = _index(docs, id_col, text_col, np.packbits(marks, bitorder="little").tobytes(), slice_docs)
    total = index.where("term IS NULL").agg(F.sum("docs"), F.sum("n")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    bundles = -(-asked.agg(F.count_distinct("item")).first()[0] // bundle) or 1
    if not n_docs:
        return spark.createDataFrame([], _RESULT.format(items.schema[item_col].dataType.simpleString()))

    df = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    owner = sum((F.col("df") > F.lit(int(share * n_docs))).cast("int") for share in owners[:-1])
    known = asked.join(df, "term").select(
        "item", "term", "q", weight.cast("bigint").alias("w"), F.lit(owner).cast("int").alias("owner") if isinstance(owner, int) else owner.alias("owner")
    )
    known = known.where("w > 0").withColumn("bundle", F.pmod(F.hash("item"), F.lit(bundles)))
    most = F.sum(F.when(F.col("owner") >= 0, F.col("q") * F.col("w") * MOST))
    later = Window.partitionBy("item").orderBy("owner").rangeBetween(1, Window.unboundedFollowing)
    known = known.withColumn("to_come", F.coalesce(most.over(later), F.lit(0)))
    # One row for each owner, bundle and term, with the items of the bundle that have it.
    visits = stored(
        known.groupBy("owner", "bundle", "term", "w").agg(F.collect_list(F.struct("item", "q", "to_come")).alias("asked")), "visits"
    )
    postings = index.where("term IS NOT NULL").select("slice", "term", "docs", "at", "tf", "length")

    carried = spark.createDataFrame([], _CARRIED)
    for k_owner in range(len(owners)):
        mine = postings.join(visits.where(F.col("owner") == k_owner).drop("owner"), "term").drop("term")
        visit = _owner(k, n_docs, n_terms, k_owner == len(owners) - 1)
        carried = carried.groupBy("slice", "bundle").cogroup(mine.groupBy("slice", "bundle")).applyInArrow(visit, _CARRIED)

    found = carried.mapInArrow(_unpacked, "slice bigint, item bigint, at bigint, score bigint")
    ids = index.where("term IS NULL").select("slice", F.posexplode("ids").alias("at", "doc_id"))
    named = found.join(ids.withColumn("at", F.col("at").cast("bigint")), ["slice", "at"])
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
