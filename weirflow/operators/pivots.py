"""Exact top-k over a stored collection, pruned by distances to pivots.

Every point is stored under the nearest of a few pivots, its cell, and a cell's points lie in the
order of their distance to the pivot, in slices of some thousand. By the triangle inequality a point
whose distance to the pivot differs from the query's by more than the query's k-th best distance
cannot be among the k best. So a query reads the slice that fits it best, which bounds its k-th
best distance, and then just the slices whose range of distances lies within that bound.

Queries are rows of a table and stay that: they are joined with the directory of slices (a few
numbers each), dealt to the spans of slices they may need, and compared there with the slices in reach. Neither they nor points pass
the driver; it holds the pivots. A query costs the points of its slices, and results equal those
of a scan, ties included, whatever the pivots are: these, taken from a bounded sample, only
decide how much is pruned.

Euclidean and Manhattan distances obey the inequality; cosine is served by Euclidean distances of
vectors of length one, among which it has the same order. Vectors that are NULL, of another
length, not finite, or of length zero under cosine take no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.session import checkpoint_root
from weirflow.specs import SpecError

PIVOTS = 64
SLICE_POINTS = 1_024
#: Points that the pivots are chosen from, at most.
SAMPLE = 4_096
#: Queries that one task compares with one slice; with a span of slices four times as many.
BLOCK = 2_048
#: Points of a span: slices of a cell that a query is sent to as one.
SPAN_POINTS = 16_384
METRICS = ("euclid", "manhattan", "cosine")
#: Double sums of a distance are off by less than this part of it.
_SLACK = 1e-9

_SLICE = "cell int, low double, high double, n bigint, ids array<{}>, vectors binary"


@dataclass(frozen=True)
class PointIndex:
    """A stored collection at ``path``; pivots are rows of an array."""

    path: str
    metric: str
    dimension: int
    id_type: str
    pivots: np.ndarray


def _distances(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix (a x b) of distances, from differences."""
    out = np.empty((len(a), len(b)))
    for i, x in enumerate(a):
        gap = b - x
        out[i] = np.abs(gap).sum(axis=1) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=1))
    return out


def _usable(metric: str, dimension: int, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which vectors take part, those as rows, of length one for cosine)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.to_pylist()
    good = np.array([v is not None and len(v) == dimension and None not in v for v in values], bool)
    rows = np.array([values[i] for i in np.flatnonzero(good)], float).reshape(-1, dimension)
    sound = np.isfinite(rows).all(axis=1)
    if metric == "cosine":
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            scale = np.abs(rows).max(axis=1, initial=0)
            rows = rows / scale[:, None]
            rows = rows / np.sqrt((rows * rows).sum(axis=1))[:, None]
        sound &= np.isfinite(rows).all(axis=1)
    good[np.flatnonzero(good)[~sound]] = False
    return good, rows[sound]


def _choose(sample: np.ndarray, count: int, metric: str) -> np.ndarray:
    """Pivots far from each other: each next one is the point farthest from those before."""
    picked = [0]
    nearest = _distances(metric, sample[:1], sample)[0]
    while len(picked) < min(count, len(sample)):
        far = int(nearest.argmax())
        if nearest[far] == 0:
            break
        picked.append(far)
        nearest = np.minimum(nearest, _distances(metric, sample[far : far + 1], sample)[0])
    return sample[picked]


def index_points(
    points: DataFrame,
    path: str,
    dimension: int,
    metric: str = "euclid",
    id: str = "id",
    vector: str = "vector",
    pivots: int = PIVOTS,
    slice_points: int = SLICE_POINTS,
) -> PointIndex:
    """Store the collection in cells and slices. One shuffle, by cell and distance."""
    if metric not in METRICS:
        raise SpecError(f"unknown metric {metric!r}")
    if min(dimension, pivots, slice_points) < 1:
        raise SpecError("dimension, pivots and slice_points must be at least 1")
    spark = points.sparkSession
    narrow = points.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kind = narrow.schema["id"].dataType.simpleString()
    drawn = narrow.where(F.col("v").isNotNull()).select("v").limit(SAMPLE).toArrow()["v"]
    sample = _usable(metric, dimension, drawn)[1]
    chosen = _choose(sample, pivots, metric) if len(sample) else np.zeros((1, dimension))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                good, rows = _usable(metric, dimension, part.column(1))
                near = _distances(metric, chosen, rows)
                cell = near.argmin(axis=0) if len(rows) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).filter(pa.array(good)), pa.array([r.tobytes() for r in rows], pa.binary()),
                        pa.array(cell, pa.int32()), pa.array(near[cell, np.arange(len(rows))], pa.float64()),
                    ],
                    ["id", "v", "cell", "d"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted points to slices: runs of one cell, of a bounded length."""
        held: list[pa.RecordBatch] = []
        size, now = 0, None

        def close() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            d = t["d"].to_numpy()
            ids = pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t["id"].combine_chunks())
            blob = b"".join(t["v"].to_pylist())
            arrays = [pa.array([now], pa.int32()), *(pa.array([float(x)]) for x in (d.min(), d.max())), pa.array([len(t)]), ids, pa.array([blob], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["cell", "low", "high", "n", "ids", "vectors"])

        for batch in batches:
            cells = batch.column(2).to_numpy()
            start = 0
            while start < len(cells):
                if held and (cells[start] != now or size == slice_points):
                    yield close()
                    held.clear()
                    size = 0
                now = int(cells[start])
                end = start + int(np.searchsorted(cells[start:], now, "right"))
                end = min(end, start + slice_points - size)
                held.append(batch.slice(start, end - start))
                size, start = size + end - start, end
        if held:
            yield close()

    placed = narrow.mapInArrow(place, f"id {kind}, v binary, cell int, d double")
    # Equal distances of a copied point are spread by id.
    ordered = placed.repartitionByRange("cell", "d", "id").sortWithinPartitions("cell", "d", "id")
    slices = ordered.mapInArrow(cut, _SLICE.format(kind))
    # Numbered by what they hold, so that a task that is run again gives the same names.
    numbered = slices.withColumn("slice", F.xxhash64("cell", "low", "high", "ids"))
    numbered.write.partitionBy("cell").mode("overwrite").parquet(f"{path}/slices")
    shape = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))])
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(chosen)]
    spark.createDataFrame(rows, shape).coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")
    settings = spark.createDataFrame([(metric, dimension, kind)], "metric string, dimension int, id_type string")
    settings.coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    return PointIndex(path, metric, dimension, kind, chosen)


def open_index(spark: SparkSession, path: str) -> PointIndex:
    """A collection that :func:`index_points` stored."""
    metric, dimension, kind = spark.read.parquet(f"{path}/settings").first()
    rows = spark.read.parquet(f"{path}/pivots").orderBy("row").collect()
    return PointIndex(path, metric, dimension, kind, np.array([r.v for r in rows], float))


def _slices(spark: SparkSession, index: PointIndex) -> DataFrame:
    schema = f"slice bigint, {_SLICE.format(index.id_type)}"
    return spark.read.schema(schema).option("basePath", f"{index.path}/slices").parquet(f"{index.path}/slices")


def _asked(index: PointIndex, queries: DataFrame, query_id: str, query_vector: str) -> DataFrame:
    """(query, query_id, q, near): usable queries with their distances to all pivots.

    ``query`` tells rows apart, also those with one id.
    """
    kind = queries.schema[query_id].dataType.simpleString()
    narrow = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = _usable(index.metric, index.dimension, batch.column(1))
            near = _distances(index.metric, rows, index.pivots)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(good)), pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.array(list(near), pa.list_(pa.float64())),
                ],
                ["query_id", "q", "near"],
            )

    return narrow.mapInArrow(run, f"query_id {kind}, q binary, near array<double>")


def _bounded(spark: SparkSession, index: PointIndex, queries: DataFrame, k: int, query_id: str, query_vector: str, digits: int, path: str) -> DataFrame:
    """(query_id, h, q, near, bound), stored at ``path``: each query once, with a bound of its k-th best cost."""
    asked = _asked(index, queries, query_id, query_vector).dropDuplicates(["query_id", "q"])
    asked = asked.withColumn("h", F.unhex(F.sha2("q", 256)))
    directory = _slices(spark, index).select("slice", "cell", "low", "high", "n")
    # The slice that fits a query best, in the cell of its nearest pivot: with k points or as many as there
    # are, and of those the nearest by distance to the pivot.
    nearest = asked.withColumn("d", F.array_min("near")).withColumn("cell", F.array_position("near", F.col("d")).cast("int") - 1)
    fits = nearest.drop("near").join(directory, "cell").withColumn("fit", F.struct(-F.least("n", F.lit(k)), _gap(), "slice"))
    best = fits.groupBy("query_id", "h").agg(F.min_by(F.struct("q", "d", "slice", "cell"), "fit").alias("best"))
    alone = best.select("query_id", "h", "best.q", "best.d", F.lit(float("inf")).alias("bound"), "best.cell", F.col("best.slice").alias("unit"))
    # As k-th best costs, ties at that place are as good as one point.
    rank = F.row_number().over(Window.partitionBy("query_id", "h").orderBy("cost"))
    units = _slices(spark, index).withColumn("unit", F.col("slice"))
    first = _compared(index, alone, units, k, digits, BLOCK).withColumn("rank", rank).where(F.col("rank") <= k)
    last = F.when(F.count(F.lit(1)) >= k, F.max("cost")).otherwise(F.lit(float("inf")))
    bounds = first.groupBy("query_id", "h").agg(last.alias("bound"))
    known = asked.join(bounds, ["query_id", "h"], "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    known.select("query_id", "h", "q", "near", "bound").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _gap():
    """How far a distance ``d`` to the pivot lies outside the range of a slice or span."""
    return F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))


def _within(index: PointIndex, known: DataFrame, directory: DataFrame, digits: int) -> DataFrame:
    """Each query with the parts of the directory whose range of distances is within its reach."""
    by_cell = known.select("*", F.posexplode("near").alias("cell", "d")).drop("near")
    reach = _reach(index.metric, F.col("bound"), digits, F.sqrt) + _SLACK * (1 + F.col("d"))
    return by_cell.join(directory, "cell").where(_gap() <= reach)


def candidate_slices(
    spark: SparkSession, index: PointIndex, queries: DataFrame, k: int, query_id: str, query_vector: str, digits: int, path: str
) -> DataFrame:
    """(query_id, q, bound, slice, cell): the slices that may hold one of a query's k best points."""
    known = _bounded(spark, index, queries, k, query_id, query_vector, digits, f"{path}-queries")
    found = _within(index, known, _slices(spark, index).select("slice", "cell", "low", "high", "n"), digits)
    found.select("query_id", "q", "bound", "slice", "cell").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _reach(metric: str, cost, digits: int, sqrt):
    """The largest cost that may round to the same score as this one; for arrays and columns."""
    step = 10.0**-digits
    wide = sqrt(cost * cost + 2 * step) if metric == "cosine" else cost + step
    return wide * (1 + _SLACK) + _SLACK


def _compared(index: PointIndex, pairs: DataFrame, stored: DataFrame, k: int, digits: int, block: int) -> DataFrame:
    """(query_id, h, id, cost): for each pair of query and unit the k nearest points of the unit, within the bound.

    A unit is a slice, or a span of slices of one cell; of these a query is compared with those in its reach.
    """
    # A unit that many queries need is compared in several tasks.
    counts = pairs.groupBy("cell", "unit").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    copies = stored.join(counts, ["cell", "unit"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = pairs.join(counts, ["cell", "unit"]).withColumn("block", F.pmod(F.xxhash64("query_id", "h"), F.col("blocks")).cast("int"))
    metric, dimension = index.metric, index.dimension
    schema = T.StructType([*[pairs.schema[c] for c in ("query_id", "h")], T.StructField("id", stored.schema["ids"].dataType.elementType), T.StructField("cost", T.DoubleType())])

    def compare(key: tuple, asked: pa.Table, stored: pa.Table) -> pa.Table:
        ids = stored["ids"].combine_chunks().flatten() if len(stored) else None
        take_q, take_p, costs = [], [], []
        if ids is not None and len(asked):
            rows = np.frombuffer(b"".join(stored["vectors"].to_pylist()), float).reshape(-1, dimension)
            bounds = _reach(metric, asked["bound"].to_numpy(), digits, np.sqrt)
            low, high, n = (stored[c].to_numpy() for c in ("low", "high", "n"))
            far = asked["d"].to_numpy()
            for i, raw in enumerate(asked["q"].to_pylist()):
                gap = np.maximum(low - far[i], far[i] - high)
                near = gap <= bounds[i] + _SLACK * (1 + far[i])
                some = np.arange(len(rows)) if near.all() else np.flatnonzero(np.repeat(near, n))
                cost = _distances(metric, np.frombuffer(raw, float)[None, :], rows if near.all() else rows[some])[0]
                keep = np.flatnonzero(cost <= bounds[i])
                if len(keep) > k:
                    # What may tie with the k-th place stays: ids decide later.
                    least = np.partition(cost[keep], k - 1)[k - 1]
                    keep = keep[cost[keep] <= _reach(metric, least, digits, np.sqrt)]
                take_q.append(np.full(len(keep), i))
                take_p.append(some[keep])
                costs.append(cost[keep])
        at = pa.array(np.concatenate([*take_q, np.zeros(0, int)]).astype(np.int64))
        where = pa.array(np.concatenate([*take_p, np.zeros(0, int)]).astype(np.int64))
        some = ids.take(where) if ids is not None else pa.array([], stored.schema.field("ids").type.value_type)
        return pa.Table.from_arrays(
            [asked["query_id"].combine_chunks().take(at), asked["h"].combine_chunks().take(at), some, pa.array(np.concatenate([*costs, np.zeros(0)]))],
            ["query_id", "h", "id", "cost"],
        )

    # Both sides know the counts; under names of its own a side's keys are its own.
    copies = copies.select(*[F.col(c).alias(c) for c in ("cell", "unit", "block", "low", "high", "n", "ids", "vectors")])
    dealt = dealt.select("cell", "unit", "block", "query_id", "h", "q", "d", "bound")
    keys = ["cell", "unit", "block"]
    return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(compare, schema)


def _spans(spark: SparkSession, index: PointIndex) -> DataFrame:
    """(slice, cell, unit, low, high): a cell's slices in the order of their distances, in spans of some SPAN_POINTS."""
    before = F.sum("n").over(Window.partitionBy("cell").orderBy("low", "high", "slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    directory = _slices(spark, index).select("slice", "cell", "low", "high", "n")
    return directory.withColumn("unit", F.floor(before / SPAN_POINTS).cast("bigint"))


def search_points(
    spark: SparkSession,
    index: PointIndex,
    queries: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vector: str = "vector",
    digits: int = 6,
    work: str | None = None,
) -> DataFrame:
    """The k nearest points for every query: ``query_id, rank, id, score``, as knn_many gives them.

    Scores are rounded to ``digits`` before they are ranked, ties by id; rows of queries that are
    equal are answered once. ``work`` is a folder for
    the queries with their bounds, by default below the session's checkpoint folder.
    """
    if k < 1:
        raise SpecError("k must be at least 1")
    place = work or f"{checkpoint_root(spark)}/weirflow/bounds-{uuid.uuid4().hex}"
    known = _bounded(spark, index, queries, k, query_id, query_vector, digits, place)
    # A vector travels once for each span, not for each slice, and results carry its digest only.
    spans = _spans(spark, index)
    directory = spans.groupBy("cell", "unit").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = _within(index, known, directory, digits).select("query_id", "h", "q", "d", "bound", "cell", "unit")
    stored = _slices(spark, index).join(spans.select("slice", "cell", "unit"), ["cell", "slice"])
    found = _compared(index, pairs, stored, k, digits, 4 * BLOCK)
    score = F.lit(1.0) - F.col("cost") * F.col("cost") / 2 if index.metric == "cosine" else F.col("cost")
    scored = found.withColumn("score", F.round(score, digits))
    best = F.desc("score") if index.metric == "cosine" else F.asc("score")
    order = Window.partitionBy("query_id", "h").orderBy(best, F.asc("id"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
