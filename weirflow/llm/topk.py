"""Exact top-k search by inner product, pruned with segment statistics, coarse to fine.

A vector is cut into segments; with a segment's mean m and deviation s over its w values,
the inner product over the segment is at most w * (m m' + s s') (Cauchy-Schwarz), which is
the lower bound on the distance in other words. Each task keeps the k best per query; a
candidate whose coarse bound is below the query's k-th score is dropped, then the same
with finer segments, query by query, and exact scores are computed for survivors. A block of
queries first meets a bounded sample of the candidates, so that no task starts without a k-th
score. Scores are integers and exact: floats are used only where every sum is below 2**53,
else Python integers.

How much is pruned lies in the data: among clusters most pairs are, among independent random
directions hardly any can be by such bounds, and the exact products of whole blocks, which
then are computed at once, are what the time goes into.

The candidates stay where they are: queries come in blocks of bounded bytes, each block
broadcast to one scan of the table. Each task returns k rows for each query.

Defined results: vectors that are null or hold null or non-finite values take no part, nor
do rows without an id; an empty vector scores zero with empty vectors. Only vectors of the
query's length are its candidates. Rows with the query's own id are no candidates of it.
Ties go to the smaller id. Repeated query rows each give their rows. Scores beyond 64 bits
are cut to the limit. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirflow.llm.common import scratch

SCALE = 64
_LEVELS = (4, 16)
_STEP = 2048
_EXACT = 2.0**53
#: Components beyond this are compared as Python integers and not by bounds.
_WILD = 1e150
#: Candidates that a block of queries meets first, at most.
SAMPLE = 1_024
_SEED_STEP = 128
#: Where fewer pairs than this part are left, they are looked at query by query.
_SPARSE = 0.25


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as floats: exact, as scaling by 64 only shifts the exponent. Too large ones become infinite."""
    with np.errstate(over="ignore"):
        return np.floor(SCALE * values)


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as Python integers, for any finite x."""
    one = lambda v: int(np.floor(SCALE * v)) if abs(v) < _EXACT else int(v) * SCALE
    return np.array([[one(v) for v in row] for row in values.tolist()], object).reshape(values.shape)


def _features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of segments, weighted so that a dot product bounds the score."""
    parts = []
    for part in np.array_split(x, min(segments, max(1, x.shape[1])), axis=1):
        w = np.sqrt(part.shape[1])
        mean = part.mean(axis=1) if part.shape[1] else np.zeros(len(x))
        deviation = part.std(axis=1) if part.shape[1] else np.zeros(len(x))
        parts += [w * mean, w * deviation]
    return np.stack(parts, axis=1)


class _Vectors:
    """Vectors of one length: as given, scaled, and their features."""

    def __init__(self, x: np.ndarray) -> None:
        self.x, self.w = x, _whole(x)
        self.wild = ~(np.abs(self.w) <= _WILD).all(axis=1)
        tame = np.where(self.wild[:, None], 0.0, self.w)
        self.features = [_features(tame, n) for n in _LEVELS]
        self.norm = np.linalg.norm(tame, axis=1)

    def largest(self, rows: np.ndarray) -> float:
        return np.abs(self.w[rows]).max(initial=0)


class _Block:
    """Queries of one length with their best candidates so far."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> None:
        self.numbers, self.ids, self.k = numbers, ids, k
        self.queries = _Vectors(x)
        #: Scores below these cannot enter: rounded down, and as they are.
        self.floor = np.full(len(ids), -np.inf)
        self.least = np.full(len(ids), None, object)
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
        self.computed = 0  # pairs whose exact score was computed

    def _exact(self, rows: np.ndarray, c: _Vectors, cols: np.ndarray) -> np.ndarray:
        self.computed += len(rows) * len(cols)
        q = self.queries
        if q.largest(rows) * c.largest(cols) * max(1, q.w.shape[1]) < _EXACT:
            return q.w[rows] @ c.w[cols].T
        limit = (1 << 63) - 1
        return np.clip(_integers(q.x[rows]) @ _integers(c.x[cols]).T, -limit - 1, limit)

    def _bounded(self, alive: np.ndarray, c: _Vectors) -> None:
        """Drop pairs whose bound is below the query's k-th score, level by level."""
        q = self.queries
        wild = q.wild[:, None] | c.wild[None, :]
        slack = 1e-9 * q.norm[:, None] * c.norm[None, :]
        for mine, theirs in zip(q.features, c.features, strict=True):
            if alive.mean() > _SPARSE:
                alive &= (mine @ theirs.T + slack >= self.floor[:, None]) | wild
                continue
            for i in np.flatnonzero(alive.any(axis=1)):
                at = np.flatnonzero(alive[i])
                alive[i, at] = (theirs[at] @ mine[i] + slack[i, at] >= self.floor[i]) | wild[i, at]

    def offer(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Take one step of candidates."""
        c = _Vectors(x)
        alive = self.ids[:, None] != ids[None, :]
        if np.isfinite(self.floor).any():
            self._bounded(alive, c)
        if not alive.any():
            return
        if alive.mean() > _SPARSE:
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            parts = [(rows, cols, alive[np.ix_(rows, cols)])]
        else:
            rows = np.flatnonzero(alive.any(axis=1))
            parts = [(np.array([i]), at, np.ones((1, len(at)), bool)) for i in rows for at in [np.flatnonzero(alive[i])]]
        found = [], [], []
        for rows, cols, wanted in parts:
            scores = self._exact(rows, c, cols)
            if scores.dtype == object:
                least = np.array([-(1 << 64) if v is None else v for v in self.least[rows]], object)
                enough = (scores >= least[:, None]).astype(bool)
            else:
                enough = scores >= self.floor[rows][:, None]
                if scores.shape[1] > self.k:
                    # Of one step no more than the k best of a query, and their ties, can enter.
                    able = np.where(wanted, scores, -np.inf)
                    enough &= able >= np.partition(able, -self.k, axis=1)[:, -self.k][:, None]
            i, j = np.nonzero(wanted & enough)
            for held, more in zip(found, (rows[i], ids[cols[j]], scores[i, j].astype(object)), strict=True):
                held.append(more)
        self._keep(*map(np.concatenate, found))

    def _keep(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q = np.concatenate([self.best[0], q])
        ids = np.concatenate([self.best[1], ids])
        scores = np.concatenate([self.best[2], scores.astype(object)])
        key = np.array([-int(s) for s in scores], object) if len(scores) else scores
        try:
            key = key.astype(np.int64)
        except OverflowError:
            key = np.unique(key, return_inverse=True)[1]
        order = np.lexsort((ids, key, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        kept = np.arange(len(q)) - first[q] < self.k
        self.best = q, ids, scores = q[kept], ids[kept], scores[kept]
        count = np.bincount(q, minlength=len(self.ids))
        last = np.cumsum(count) - 1
        full = np.flatnonzero(count == self.k)
        for i in full:
            self.least[i] = int(scores[last[i]])
            near = float(self.least[i])
            self.floor[i] = near if near <= self.least[i] else np.nextafter(near, -np.inf)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite
    )


def _by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    out = {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[int(n)] = at, flat[starts[at][:, None] + np.arange(n)[None, :]].reshape(len(at), int(n))
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of each query row.

    ``is_query`` is a condition on ``vec_id``. ``block_bytes`` bounds what is broadcast.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, id_col, vector_col)
    path = scratch(spark, "top-k")
    schema = "number bigint, query_id bigint, vec_id bigint, score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    drawn = usable.limit(SAMPLE).toArrow().combine_chunks()
    sample = {}
    if len(drawn):
        at_hand = drawn.column("vec_id").to_numpy()
        sample = {n: (at_hand[at], x) for n, (at, x) in _by_length(drawn.column("x").combine_chunks()).items()}

    def scan(block: list[tuple[int, int, list[float]]]) -> None:
        of_length = defaultdict(list)
        for number, vec_id, x in block:
            of_length[len(x)].append((number, vec_id, x))
        matrices = {}
        for n, rows in of_length.items():
            numbers, ids, xs = zip(*rows, strict=True)
            matrices[n] = np.array(numbers), np.array(ids), np.array(xs, float).reshape(len(xs), n)
            if n in sample:
                # What a sample already has gives each query a k-th score, which no task then starts without.
                first = _Block(*matrices[n], k)
                seen, x = sample[n]
                for i in range(0, len(seen), _SEED_STEP):  # small steps: this is the driver
                    first.offer(seen[i : i + _SEED_STEP], x[i : i + _SEED_STEP])
                matrices[n] += (first.floor, first.least)
        shared = spark.sparkContext.broadcast(matrices)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = {n: _Block(*m[:3], k) for n, m in shared.value.items()}
            for n, m in shared.value.items():
                if len(m) > 3:
                    blocks[n].floor, blocks[n].least = m[3].copy(), m[4].copy()
            for batch in batches:
                ids = batch.column("vec_id").to_numpy()
                for n, (at, x) in _by_length(batch.column("x")).items():
                    if n in blocks:
                        for i in range(0, len(at), _STEP):
                            blocks[n].offer(ids[at[i : i + _STEP]], x[i : i + _STEP])
            for b in blocks.values():
                q, ids, scores = b.best
                columns = [b.numbers[q], b.ids[q], ids, np.array([int(s) for s in scores], np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["number", "query_id", "vec_id", "score"]
                )

        found = usable.mapInArrow(search, schema)
        best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
        found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).drop("at").write.mode(
            "append"
        ).parquet(path)
        shared.unpersist()

    block, held = [], 0
    for number, row in enumerate(usable.where(is_query).toLocalIterator()):
        block.append((number, row.vec_id, row.x))
        held += 8 * len(row.x) + 64
        if held >= block_bytes:
            scan(block)
            block, held = [], 0
    if block:
        scan(block)
    ranks = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return spark.read.schema(schema).parquet(path).select(
        "query_id", F.row_number().over(ranks).cast("int").alias("rank"), "vec_id", "score"
    )
