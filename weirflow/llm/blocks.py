"""Blocks of documents, and the exchange of keys between them.

Some operators ask, for many short keys of every document, what the rest of the corpus
knows about them. Documents are gathered in blocks of a few megabytes; a block asks once
for each of its distinct keys, in sorted, delta-coded lists, one for each range of keys.
The task that owns a range sees the lists of all blocks together and answers each of them
in its own order. So what crosses the network is a few bytes for each distinct key of a
block, a key that occurs everywhere is asked at most once by each block, and the blocks
themselves never move: they are stored in buckets by number, and answers come to them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import release, scratch, shuffle_parts
from weirflow.llm.lm import pack, pack_sorted, unpack, unpack_sorted

BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).min


def pack_rows(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_rows(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def ids_of(table: pa.Table, id_col: str) -> np.ndarray:
    """Ids as long; rows without one come before all others."""
    return table.column(id_col).cast(pa.int64()).fill_null(NO_ID).to_numpy()


def store_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, rows): all columns of ``docs``, ordered by id within a block.

    The table is stored in buckets by block, so that joins on it leave it where it is.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held, size = [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            order = np.argsort(ids_of(table, id_col), kind="stable")
            blob = pack_rows(table.take(pa.array(order)).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([blob], pa.binary())], ["block", "rows"])

        for batch in batches:
            lengths = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
            start = 0
            for i, n in enumerate(lengths.tolist()):
                size += n + 16
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(start, i + 1 - start))
                    yield block()
                    number, held, size, start = number + 1, [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield block()
        release()

    spark = docs.sparkSession
    name = f"weirflow_blocks_{uuid.uuid4().hex}"
    made = docs.mapInArrow(run, "block bigint, rows binary")
    made.write.bucketBy(shuffle_parts(spark), "block").sortBy("block").option(
        "path", scratch(spark, "blocks")
    ).saveAsTable(name)
    return spark.table(name)


def parts_for(spark, keys: int, part_keys: int) -> int:
    """How many ranges of keys: a power of two, for a bounded number of keys in each."""
    return 1 << (max(1, shuffle_parts(spark), -(-keys // part_keys)) - 1).bit_length()


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range that owns each key."""
    return keys >> np.uint64(64 - (parts - 1).bit_length()) if parts > 1 else np.zeros(len(keys), np.uint64)


def split_keys(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the ranges that have some of the sorted ``keys``."""
    at = np.searchsorted(part_of(keys, parts), np.arange(parts + 1).astype(np.uint64))
    return [(p, int(a), int(b)) for p, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a < b]


SENT = "block bigint, part int, keys binary, facts binary"
ANSWERED = "block bigint, part int, answer binary, n bigint"


def sent_batch(block: int, keys: np.ndarray, facts: np.ndarray, parts: int) -> pa.RecordBatch:
    """A block's sorted distinct keys with a number for each, as rows of ``SENT``."""
    rows = [(block, p, pack_sorted(keys[a:b]), pack(facts[a:b])) for p, a, b in split_keys(keys, parts)]
    return record_batch(rows, SENT)


def record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
        "boolean": pa.bool_(), "double": pa.float64(),
    }
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [n for n, _ in fields]
    )


def answered(sent: DataFrame, parts: int, answer: Callable[[list[tuple]], list[tuple[bytes, int]]]) -> DataFrame:
    """``answer`` gets all rows (block, keys, facts) of a range, and gives a blob and a count for each.

    ``sent`` has the columns block and part, then what the owner of the part is told.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, rows = None, []

        def close() -> pa.RecordBatch:
            found = answer(rows)
            out = [(r[0], owner, blob, n) for r, (blob, n) in zip(rows, found, strict=True)]
            return record_batch(out, ANSWERED)

        for batch in batches:
            for b, p, *told in zip(*batch.columns, strict=True):
                if p.as_py() != owner:
                    if rows:
                        yield close()
                    owner, rows = p.as_py(), []
                rows.append((b.as_py(), *(x.as_py() for x in told)))
        if rows:
            yield close()
        release()

    owned = sent.repartition(parts, "part").sortWithinPartitions("part", "block")
    return owned.mapInArrow(run, ANSWERED)


def with_answers(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Blocks with, under each name, a list of (part, answer) in the order of parts."""
    out = blocks
    for name, found in answers.items():
        lists = found.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "answer"))).alias(name))
        out = out.join(lists, "block", "left")
    return out


def joined(answers: list[dict] | None, kind: str) -> np.ndarray:
    """The numbers of all answers to a block, in the order of its keys."""
    return np.concatenate([np.zeros(0, kind), *(unpack(a["answer"], kind) for a in answers or [])])


def each_block(blocks: DataFrame, work: Callable[[dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on every block row, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(batch.slice(i, 1).to_pylist()[0])
        release()

    return blocks.mapInArrow(run, schema)


__all__ = [
    "ANSWERED", "NO_ID", "SENT", "answered", "each_block", "ids_of", "joined", "pack", "pack_sorted", "part_of", "parts_for",
    "record_batch", "sent_batch", "split_keys", "store_blocks", "unpack", "unpack_rows", "unpack_sorted", "with_answers",
]
