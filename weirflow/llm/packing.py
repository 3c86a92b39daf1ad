"""Best-fit packing of documents into sequences, under several capacities at once.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared
piece lengths). Pieces are placed longest first. A piece goes into the open sequence that
has room in every dimension and, after the placement, the smallest weighted residual norm
(or the largest weighted dot product of demand and residual); only if none has room a new
sequence is opened. A limit on attention below that of one full piece keeps long pieces from
being joined by others: a piece may always stand alone.

Pieces of one length are interchangeable, and so are sequences with the same residuals.
So the placement of the whole corpus is decided on counts by length, of which there are at
most ``max_tokens``: one global best-fit, not one for each partition, whose size does not
grow with the data. Each decision becomes a run "pieces r to r+m of length L go to sequences
s to s+m at offset o". Workers then number the pieces of each length and look their run up.

Defined results: a null text counts as empty, which still has its end token; repeated
rows are packed each; an empty table gives no rows; other input columns are left out.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirflow.llm.common import id_and_text, release, stored

END_ID = 0
#: Words a worker remembers, at most: up to 500 MB if a worker meets so many.
REMEMBERED = 1 << 21

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and the weight of each dimension in the choice."""

    max_tokens: int = 2048
    max_docs: int = 2048
    max_attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"

    def __post_init__(self) -> None:
        if min(self.max_tokens, self.max_docs, self.max_attention) < 1:
            raise ValueError("capacities must be at least 1")
        if self.rule not in ("norm", "dot"):
            raise ValueError("rule: norm or dot")


class _WordIds:
    """The ids of white-space-free chunks as bytes; encoded by the library, remembered up to a bound."""

    def __init__(self, source: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}

    def texts(self, texts: list[str], remembered: int = REMEMBERED) -> list[bytes]:
        """Ids of texts: no pre-token of this kind of vocabulary holds white space."""
        words = [text.encode().split() for text in texts]
        known = self.known
        if len(known) > remembered:
            known.clear()
        new = list(set().union(*words).difference(known))
        if new:
            found = self.tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)
            known.update(zip(new, (np.array(e.ids, "<u4").tobytes() for e in found), strict=True))
        return [b"".join(map(known.__getitem__, w)) for w in words]


_TOKENIZERS: dict[int, _WordIds] = {}


def _word_ids(source: str) -> _WordIds:
    key = hash(source)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = _WordIds(source)
    return _TOKENIZERS[key]


def _few(batch: pa.RecordBatch, rows: int = 256) -> list[pa.RecordBatch]:
    return [batch.slice(i, rows) for i in range(0, batch.num_rows, rows)]


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, max_tokens: int, remembered: int = REMEMBERED, with_ids: bool = False
) -> DataFrame:
    """A row for each piece; ``nth`` counts the pieces of its length within its task ``part``.

    ``with_ids`` adds ``ids``, the piece's ids as little-endian unsigned 32-bit numbers.
    """
    source = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(source.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in (part for whole in batches for part in _few(whole)):
            rows: list[tuple] = []
            found = ids_of.texts(batch.column("text").to_pylist(), remembered)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    cut = ids[at : at + 4 * max_tokens]
                    n = len(cut) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(cut), part, int(seen[n]), *([cut] if with_ids else [])))
                    seen[n] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *([pa.binary()] if with_ids else [])]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])],
            )
        release()

    return id_and_text(docs).mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def plan_sequences(counts: dict[int, int], capacity: Capacity = Capacity()) -> np.ndarray:
    """Rows (length, first piece, first sequence, pieces, offset): the placement of all pieces.

    ``counts`` holds the number of pieces by length. Sequences with equal residuals form one
    class, kept as runs of sequence ids.
    """
    full = np.array([capacity.max_tokens, capacity.max_docs, capacity.max_attention], np.int64)
    weights = np.array(capacity.weights) / full.astype(float) ** 2
    classes: dict[tuple[int, int, int], list[list[int]]] = {}
    keys = np.zeros((0, 3), np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, placed = counts[length], 0
        need = np.array([length, 1, length * length], np.int64)
        while left:
            room = (keys >= need).all(axis=1) if len(keys) else np.zeros(0, bool)
            if room.any():
                after = (keys[room] - need).astype(float)
                if capacity.rule == "norm":
                    pick = int(np.argmin((after**2 * weights).sum(axis=1)))
                else:
                    pick = int(np.argmax((keys[room] * need * weights).sum(axis=1)))
                key = tuple(int(x) for x in keys[room][pick])
            else:
                # As many new sequences as these pieces fill; each takes one piece a turn, at any cost.
                fit = max(1, int((full // need).min()))
                new = -(-left // fit)
                key = tuple(int(x) for x in full)
                classes.setdefault(key, []).append([sequences, new])
                sequences += new
            took: list[list[int]] = []
            have = classes[key]
            while have and left:
                first, n = have.pop()
                m = min(n, left)
                if m < n:
                    have.append([first + m, n - m])
                runs.append((length, placed, first, m, int(full[0]) - key[0]))
                took.append([first, m])
                placed += m
                left -= m
            if not have:
                del classes[key]
            rest = tuple(int(x) for x in np.array(key) - need)
            if min(rest) > 0:
                classes.setdefault(rest, []).extend(took)
            keys = np.array(list(classes), np.int64).reshape(-1, 3)
    return np.array(runs, np.int64).reshape(-1, 5)


def pack_sequences(
    docs: DataFrame, tokenizer_path: str, capacity: Capacity = Capacity(), remembered: int = REMEMBERED, with_ids: bool = False
) -> DataFrame:
    """Every piece of every document with its sequence and its place there, ``with_ids`` also its token ids.

    ``remembered`` bounds the words whose ids a worker keeps: more take memory, fewer time.
    """
    spark = docs.sparkSession
    pieces = stored(tokenized_pieces(docs, tokenizer_path, capacity.max_tokens, remembered, with_ids), "pieces")
    carried = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    # At most max_tokens rows reach the driver, whatever the table's size.
    by_length = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    runs = plan_sequences({r.length: r.n for r in by_length}, capacity)
    plan = spark.sparkContext.broadcast(runs)

    tasks = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).select(
        *carried, (F.col("base") + F.col("nth")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        order = np.lexsort((runs[:, 1], runs[:, 0]))
        runs = runs[order]
        start = runs[:, 0].astype(float) * 2.0**40 + runs[:, 1]  # exact: below 2**53
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            run = runs[np.searchsorted(start, length.astype(float) * 2.0**40 + rank, "right") - 1]
            kept = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 4])],
                [*carried, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PACKED.replace("sequence_id", "ids binary, sequence_id") if with_ids else PACKED)


def write_sequences(packed: DataFrame, path: str) -> None:
    """Store whole sequences: sequence_id, its documents in order, and all token ids as one value.

    ``packed`` comes from :func:`pack_sequences` with ids. A sequence is a bounded number of tokens.
    """
    pieces = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(pieces.alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"]))
    whole.select("sequence_id", F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("pieces"), joined.alias("ids")).write.parquet(path)
