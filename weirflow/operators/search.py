"""Exact similarity search over a stored collection.

The collection is scanned where it lies and never broadcast, collected or shuffled. One
query vector becomes a literal of a score expression. Many query vectors come in blocks of
bounded bytes, each broadcast to one scan; only the k best per query leave a partition, so
the volume shuffled is (partitions x queries x k), not all pairs.

Points of another length than the query are not comparable and never a hit. Points without
a score (a zero vector under cosine) rank last, with a NULL score.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weirflow.functions.variants import as_string, schema_kind
from weirflow.functions.vectors import dot, higher_is_better, norm, similarity
from weirflow.session import checkpoint_root

# Bytes of query vectors that one scan of the collection takes along.
BLOCK_BYTES = 8 << 20

# Scores held at once: bounds a task's memory.
_SCORES = 4 << 20


def _best_first(metric: str) -> Column:
    return F.desc_nulls_last("score") if higher_is_better(metric) else F.asc_nulls_last("score")


def knn(
    collection: DataFrame,
    query: Sequence[float],
    k: int = 5,
    metric: str = "cosine",
    id: str = "id",
    vector: str = "vector",
    digits: int = 6,
) -> DataFrame:
    """The k points most similar to one query vector, best first, ties by id.

    Vectors of another length than the query are not comparable and are left out.
    """
    target = F.array(*[F.lit(float(x)) for x in query])
    if metric == "cosine":
        # The query's own norm is known: one pass less over each vector.
        length = F.lit(float(np.linalg.norm(np.asarray(query, dtype="float64"))))
        score = F.try_divide(dot(F.col(vector), target), norm(F.col(vector)) * length)
    else:
        score = similarity(metric, F.col(vector), target)
    best = F.col("score").desc_nulls_last() if higher_is_better(metric) else F.col("score").asc_nulls_last()
    return (
        collection.where(F.size(vector) == len(query))
        .withColumn("score", F.round(score, digits))
        .orderBy(best, F.asc(id))
        .limit(k)
    )


def _scores(metric: str, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Matrix (queries x points) of scores, in double."""
    if metric == "dot":
        return queries @ points.T
    if metric == "cosine":
        norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(points, axis=1)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(norms > 0, (queries @ points.T) / norms, np.nan)
    if metric == "euclid":
        # Differences, not the dot product form: that one loses digits near zero.
        return np.stack([np.sqrt(((points - q) ** 2).sum(axis=1)) for q in queries])
    return np.stack([np.abs(points - q).sum(axis=1) for q in queries])


class _BestK:
    """The k best (score, id) of each query over the points seen so far."""

    def __init__(self, qids: np.ndarray, queries: np.ndarray, k: int, metric: str, digits: int):
        self.qids, self.queries, self.k = qids, queries, k
        self.metric, self.digits = metric, digits
        self.sign = -1.0 if higher_is_better(metric) else 1.0
        # Cost of the k-th best so far per query: worse points cannot enter any more.
        self.bound = np.full(len(qids), np.inf)
        self.best = pd.DataFrame({"row": [], "cost": [], "id": []})

    def add(self, ids: np.ndarray, points: np.ndarray) -> None:
        step = max(1, _SCORES // max(1, len(self.qids)))
        for start in range(0, len(ids), step):
            self._add(ids[start : start + step], points[start : start + step])

    def _add(self, ids: np.ndarray, points: np.ndarray) -> None:
        cost = self.sign * np.round(_scores(self.metric, self.queries, points), self.digits)
        cost[np.isnan(cost)] = np.inf
        bound = self.bound
        if cost.shape[1] >= self.k:
            bound = np.minimum(bound, np.partition(cost, self.k - 1, axis=1)[:, self.k - 1])
        rows, cols = np.nonzero(cost <= bound[:, None])
        if len(rows) == 0:
            return
        fresh = pd.DataFrame({"row": rows, "cost": cost[rows, cols], "id": ids[cols]})
        merged = pd.concat([self.best, fresh]) if len(self.best) else fresh
        merged = merged.sort_values(["row", "cost", "id"])
        place = merged.groupby("row").cumcount()
        self.best = merged[(place < self.k).to_numpy()]
        last = merged[(place == self.k - 1).to_numpy()]
        self.bound[last["row"].to_numpy(dtype="int64")] = last["cost"].to_numpy()

    def rows(self) -> pd.DataFrame:
        cost = self.best["cost"].to_numpy(dtype="float64")
        return pd.DataFrame(
            {
                "query_id": self.qids[self.best["row"].to_numpy(dtype="int64")],
                "id": self.best["id"].to_numpy(),
                "score": np.where(np.isfinite(cost), self.sign * cost, None),
            }
        )


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64")


def _keep_best(candidates: DataFrame, k: int, metric: str) -> DataFrame:
    """Final cut: at most k rows per query and partition reach this window."""
    order = Window.partitionBy("query_id").orderBy(_best_first(metric), F.asc("id"))
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def knn_many(
    collection: DataFrame,
    queries: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    id: str = "id",
    vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
    digits: int = 6,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The k most similar points for every query: ``query_id, rank, id, score``.

    Queries are fetched partition by partition and gathered in blocks of ``block_bytes``,
    so that the driver holds one block. A single block gives a lazy plan. Of more, each is
    broadcast to one scan of the collection, whose hits are stored in the shared folder
    before the next one is fetched. No pair of query and point ever becomes a row, and
    points never move.
    """
    spark = collection.sparkSession
    points = collection.select(F.col(id).alias("id"), F.col(vector).alias("v"))
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("q"))
    out = T.StructType(
        [
            T.StructField("query_id", asked.schema["query_id"].dataType),
            T.StructField("id", points.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def hits(block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(pd.DataFrame(block, columns=["query_id", "q"]))
        return _keep_best(points.mapInPandas(_scan_with(shared, k, metric, digits), out), k, metric)

    blocks = _blocks(asked, block_bytes)
    first, more = next(blocks, None), next(blocks, None)
    if first is None:
        return spark.createDataFrame([], out).selectExpr("query_id", "cast(0 as int) as rank", "id", "score")
    if more is None:
        return hits(first)
    path = f"{checkpoint_root(spark)}/weirflow/knn-{uuid.uuid4().hex}"
    for block in chain([first, more], blocks):
        hits(block).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _blocks(asked: DataFrame, block_bytes: int) -> Iterator[list]:
    """Queries in lists of at most ``block_bytes``, or of a single longer one."""
    block, held = [], 0
    for row in asked.where(F.col("q").isNotNull()).toLocalIterator():
        size = 8 * len(row.q) + 64
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.query_id, row.q))
        held += size
    if block:
        yield block


def _by_length(frame: pd.DataFrame, column: str) -> Iterator[tuple[int, pd.DataFrame]]:
    usable = frame[frame[column].notna()]
    yield from usable.groupby(usable[column].map(len))


def _scan_with(shared, k: int, metric: str, digits: int) -> Callable:
    """A scan that keeps the k best points for each query of a broadcast block."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {
            n: _BestK(part["query_id"].to_numpy(), _matrix(part["q"]), k, metric, digits)
            for n, part in _by_length(shared.value, "q")
        }
        for batch in batches:
            for n, part in _by_length(batch, "v"):
                if n in best:
                    best[n].add(part["id"].to_numpy(), _matrix(part["v"]))
        for b in best.values():
            yield b.rows()

    return scan


def format_hits(
    hits: DataFrame,
    fields: Sequence[str],
    payload: str = "payload_fields",
    metadata_prefix: str | None = None,
    digits: int = 4,
    order: Sequence[Column] = (),
    partition: Sequence[str] = (),
) -> DataFrame:
    """Rank, score and chosen payload fields ('N/A' when absent) of search results.

    With ``metadata_prefix`` the payload fields starting with it come along as a map.
    """

    def shown(v: Column) -> Column:
        return F.when(schema_kind(v) == "STRING", as_string(v)).otherwise(F.to_json(v))

    columns = [
        F.coalesce(shown(F.try_element_at(payload, F.lit(f))), F.lit("N/A")).alias(f)
        for f in fields
    ]
    if "rank" not in hits.columns:
        # Hits are the few rows of a finished search, one window over them is cheap.
        order = list(order) or [F.desc("score"), F.asc("id")]
        hits = hits.withColumn(
            "rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        )
    shaped = ["rank", F.round("score", digits).alias("score"), *columns]
    if metadata_prefix:
        named = F.map_filter(payload, lambda key, _: key.startswith(metadata_prefix))
        shaped.append(F.transform_values(named, lambda _, v: shown(v)).alias("metadata"))
    return hits.select(*partition, *shaped)


def embed(
    df: DataFrame,
    col: str,
    encoder: Callable[[pd.Series], Sequence[Sequence[float]]],
    out: str = "vector",
) -> DataFrame:
    """Add a vector column made by a user-supplied encoder, one Arrow batch at a time."""

    @F.pandas_udf("array<float>")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(x, dtype="float32") for x in encoder(text)])

    return df.withColumn(out, run(F.col(col)))
