"""Exact dedup by counting quotient filters.

Documents are held in blocks of some megabytes, each of them the part of the table that one
filter counts. A filter keeps the fingerprints of its texts and how often each occurs: the upper
bits of a fingerprint (its quotient) are told by the place, the others (its remainder) are stored,
sorted, with counters behind those that occur more than once. Nothing is rounded, so filters
merge without loss, in one pass over their sorted remainders.

Every block sends its filter, cut by ranges of fingerprints, to the tasks that own the ranges. An
owner merges the filters of all blocks and answers each with one bit for each of its fingerprints:
whether the sum of the counts is above one. Only texts with such a fingerprint leave their block,
each distinct one once, and are compared byte by byte: Spark groups them by the whole text, first
within a number of salts, so neither a group of copies nor its counts meet in one task. Texts that
merely share a fingerprint fall into different groups there. The group's result goes back to the
lists of ids, one for each block and text, by fingerprint and SHA-256; the latter only matters
where one fingerprint stands for several texts.

So a text of which there is one never moves, and one that a third of all documents share moves
once for each block (a few for each task after the first grouping). Nothing goes through the driver.

Defined results: a null text is an empty one; rows without an id are never kept where a row with
an id has the same text, and are named by null; of rows with one id and one text one is kept; an
empty table gives no rows. Other columns are left out. The id -2**63 counts as none.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm import blocks as B
from weirflow.llm.common import id_and_text, stored

PART_KEYS = 1_000_000
#: A text that is shared by many blocks is counted in so many groups before these are summed up.
SALTS = 16
_HEAD = struct.Struct("<QIBBB")
_COPIES = "block bigint, dup boolean, fp bigint, digest binary, text binary, ids array<bigint>"


# -- the filter --------------------------------------------------------------------------


def _bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of every number, one after the other."""
    places = np.arange(width, dtype=np.uint64)
    return np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8)).tobytes()


def _numbers(raw: bytes, count: int, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=count * width).reshape(count, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def filter_of(keys: np.ndarray, counts: np.ndarray, lead: int = 0, bits: int = 64) -> bytes:
    """A counting quotient filter of sorted distinct ``keys`` that share their first ``lead`` bits.

    Only the first ``bits`` bits of a key count; the others are zero. Parts: a bit for each
    quotient that occurs; for each slot a bit that ends its quotient's run, and one that tells
    counters from remainders; the slots, as wide as a remainder. A count above one follows its
    remainder, less one, in digits of a slot each.
    """
    n = len(keys)
    q = min(max(1, n.bit_length()), bits - lead - 1)
    r = bits - lead - q
    if r < 1:
        raise ValueError("bits: at least two more than lead")
    low = np.uint64((1 << r) - 1)
    body = (keys >> np.uint64(64 - bits)) & np.uint64((1 << (bits - lead)) - 1)
    quotient, remainder = (body >> np.uint64(r)).astype(np.int64), body & low
    extra = counts.astype(np.uint64) - np.uint64(1)
    digits, rest = np.zeros(n, np.int64), extra.copy()
    while rest.any():
        digits += rest > 0
        rest >>= np.uint64(r)
    at = np.arange(n) + np.cumsum(digits) - digits
    total = n + int(digits.sum())
    slots, counter, ends = np.zeros(total, np.uint64), np.ones(total, np.uint8), np.zeros(total, np.uint8)
    slots[at], counter[at] = remainder, 0
    for j in range(int(digits.max(initial=0))):
        some = digits > j
        slots[at[some] + 1 + j] = (extra[some] >> np.uint64(r * j)) & low
    occupied = np.zeros(1 << q, np.uint8)
    occupied[quotient] = 1
    if n:
        last = np.append(quotient[1:] != quotient[:-1], True)
        ends[(at + digits)[last]] = 1
    first = int(keys[0] >> np.uint64(64 - lead)) if n and lead else 0
    return b"".join(
        [_HEAD.pack(first, total, q, r, lead), *(np.packbits(x).tobytes() for x in (occupied, ends, counter)), _bits(slots, r)]
    )


def read_filter(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, counts) of a filter."""
    first, total, q, r, lead = _HEAD.unpack_from(blob)
    pos = _HEAD.size

    def take(count: int) -> np.ndarray:
        nonlocal pos
        size = -(-count // 8)
        out = np.unpackbits(np.frombuffer(blob, np.uint8, size, pos), count=count)
        pos += size
        return out

    occupied, ends, counter = take(1 << q), take(total), take(total).astype(bool)
    slots = _numbers(blob[pos:], total, r)
    run = np.cumsum(ends) - ends
    at = np.flatnonzero(~counter)
    quotient = np.flatnonzero(occupied).astype(np.uint64)[run[at]]
    bits = lead + q + r
    keys = ((quotient << np.uint64(r)) | slots[at]) << np.uint64(64 - bits)
    if lead:
        keys |= np.uint64(first) << np.uint64(64 - lead)
    counts = np.ones(len(at), np.int64)
    owner = np.cumsum(~counter) - 1
    where = np.flatnonzero(counter)
    place = where - at[owner[where]] - 1
    np.add.at(counts, owner[where], (slots[where] << (place * r).astype(np.uint64)).astype(np.int64))
    return keys, counts


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The filters' keys and summed counts: sorted runs, merged by a sort that knows runs."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[begin], np.add.reduceat(counts[order], begin) if len(keys) else counts


# -- the operator --------------------------------------------------------------------------


def _fingerprints(texts: list[bytes], bits: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    made = np.fromiter((digest(t) for t in texts), np.uint64, len(texts))
    return made >> np.uint64(64 - bits) << np.uint64(64 - bits)


def _texts(table: pa.Table) -> list[bytes]:
    return table.column("text").cast(pa.binary()).to_pylist()


def _answer(rows: list[tuple]) -> list[tuple[bytes, int]]:
    """For each block of a range: a bit for each of its fingerprints, set if it occurs elsewhere as well."""
    parts = [read_filter(blob) for _, blob in rows]
    keys, counts = merged(parts)
    often = keys[counts > 1]
    out = []
    for mine, _ in parts:
        at = np.searchsorted(often, mine)
        dup = (often[np.minimum(at, len(often) - 1)] == mine) if len(often) else np.zeros(len(mine), bool)
        out.append((np.packbits(dup).tobytes(), int(dup.sum())))
    return out


def exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalize: Callable[[Column], Column] | None = None,
    bits: int = 64,
) -> DataFrame:
    """For every row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows of equal texts are one group; the row with the largest id stays. ``normalize`` is applied
    to texts first; ``bits`` is the length of a fingerprint.
    """
    if not 4 <= bits <= 64:
        raise ValueError("bits: 4 to 64")
    spark = docs.sparkSession
    narrow = id_and_text(docs, id_col, text_col)
    if normalize is not None:
        narrow = narrow.withColumn("text", F.coalesce(normalize(F.col("text")), F.lit("")))
    held = B.store_blocks(narrow, "doc_id", "text")
    parts = min(B.parts_for(spark, narrow.count(), PART_KEYS), 1 << (bits - 2))
    lead = (parts - 1).bit_length()

    def ask(row: dict) -> Iterator[pa.RecordBatch]:
        prints = _fingerprints(_texts(B.unpack_rows(row["rows"])), bits)
        keys, counts = np.unique(prints, return_counts=True)
        rows = [(row["block"], p, filter_of(keys[a:b], counts[a:b], lead, bits)) for p, a, b in B.split_keys(keys, parts)]
        yield B.record_batch(rows, "block bigint, part int, filter binary")

    sent = B.each_block(held, ask, "block bigint, part int, filter binary")
    answers = stored(B.answered(sent, parts, _answer), "filters")

    def route(row: dict) -> Iterator[pa.RecordBatch]:
        """A row for each text that occurs once, without it, and for each distinct other one, with it."""
        table = B.unpack_rows(row["rows"])
        texts, ids = _texts(table), B.ids_of(table, "doc_id").tolist()
        prints = _fingerprints(texts, bits)
        keys, where = np.unique(prints, return_inverse=True)
        found = [p for p, _, _ in B.split_keys(keys, parts)]
        sizes = [b - a for _, a, b in B.split_keys(keys, parts)]
        told = {a["part"]: a["answer"] for a in row["told"] or []}
        dup = np.concatenate(
            [np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(told[p], np.uint8), count=n) for p, n in zip(found, sizes, strict=True))]
        ).astype(bool)[where]
        groups: dict[bytes, list[int]] = {}
        out = []
        names = prints.view(np.int64).tolist()
        for i, text in enumerate(texts):
            if not dup[i]:
                out.append((row["block"], False, names[i], hashlib.sha256(text).digest(), None, [ids[i]]))
            elif text in groups:
                groups[text].append(ids[i])  # rows of a block are in the order of ids
            else:
                groups[text] = [ids[i]]
                out.append((row["block"], True, names[i], hashlib.sha256(text).digest(), text, groups[text]))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(made, ["block", "dup", "fp", "digest", "text", "ids"])

    routed = stored(B.each_block(B.with_answers(held, told=answers), route, _COPIES), "copies")
    shared = routed.where("dup")
    # Bytes decide: the groups are of whole texts. Salts first, so that a common text's rows spread.
    salted = (
        shared.select("fp", "text", "block", F.pmod(F.hash("block"), F.lit(SALTS)).alias("salt"), F.size("ids").alias("n"), F.get("ids", F.size("ids") - 1).alias("top"))
        .groupBy("fp", "text", "salt")
        .agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.max_by("block", "top").alias("holder"))
    )
    groups = salted.groupBy("fp", "text").agg(
        F.sum("n").alias("group_size"), F.max("top").alias("keep"), F.max_by("holder", "top").alias("holder")
    )
    # Stored, so that a tie between holders is settled once.
    classes = stored(
        groups.select("fp", F.unhex(F.sha2("text", 256)).alias("digest"), "group_size", "keep", "holder"), "classes"
    )
    lists = shared.select("fp", "digest", "block", "ids").join(classes, ["fp", "digest"])
    several = lists.select(
        F.posexplode("ids").alias("_at", "_id"), "keep", "group_size", "digest", (F.col("block") == F.col("holder")).alias("_here"), F.size("ids").alias("_n")
    )
    single = routed.where("NOT dup").select(F.get("ids", F.lit(0)).alias("_id"), "digest")
    known = lambda c: F.nullif(F.col(c), F.lit(B.NO_ID).cast("bigint"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return single.select(
        known("_id").alias("doc_id"), known("_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), digest
    ).unionByName(
        several.select(
            known("_id").alias("doc_id"), known("keep").alias("keep_id"), "group_size", (F.col("_here") & (F.col("_at") == F.col("_n") - 1)).alias("kept"), digest
        )
    )
