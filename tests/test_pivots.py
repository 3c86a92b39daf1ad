"""Pivot-pruned search against a scan."""

import numpy as np
import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from weirflow.operators.pivots import candidate_slices, index_points, open_index, search_points
from weirflow.operators.search import knn_many
from weirflow.specs import SpecError

POINTS = "id bigint, vector array<double>"


def rows(df):
    return sorted((r.query_id, r["rank"], r.id, None if r.score is None else round(r.score, 5)) for r in df.collect())


def frame(spark, matrix, start=0, name="id"):
    return spark.createDataFrame([(start + i, [float(x) for x in v]) for i, v in enumerate(matrix)], POINTS.replace("id", name, 1))


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 12)) * 10
    points = np.concatenate([c + rng.normal(size=(250, 12)) * 0.5 for c in centres])
    points = np.concatenate([points, points[:200], np.repeat(points[:1], 60, axis=0)])
    return rng.permutation(points), centres + rng.normal(size=centres.shape) * 0.3


@pytest.mark.parametrize("metric", ["euclid", "manhattan", "cosine"])
def test_equals_a_scan(spark, clustered, tmp_path, metric):
    points, queries = clustered
    collection, asked = frame(spark, points), frame(spark, queries, name="query_id")
    index_points(collection.repartition(5), str(tmp_path), 12, metric, pivots=16, slice_points=100)
    index = open_index(spark, str(tmp_path))
    got = search_points(spark, index, asked, 10)
    assert got.columns == ["query_id", "rank", "id", "score"]
    assert rows(got) == rows(knn_many(collection, asked, 10, metric))


def test_few_points_are_read(spark, clustered, tmp_path):
    points, queries = clustered
    index = index_points(frame(spark, points), str(tmp_path / "i"), 12, pivots=40, slice_points=64)
    asked = frame(spark, queries, name="query_id")
    pairs = candidate_slices(spark, index, asked, 10, "query_id", "vector", 6, str(tmp_path / "pairs"))
    sizes = spark.read.parquet(str(tmp_path / "i" / "slices")).select("slice", "n")
    compared = pairs.join(sizes, "slice").agg(F.sum("n")).first()[0]
    assert compared < 0.15 * len(points) * len(queries)
    # One query reads the cells around it: others are not opened.
    one = pairs.where("query_id = 0").select("cell").distinct().count()
    assert one <= 4


def test_no_vector_passes_the_driver(spark, clustered, tmp_path):
    points, queries = clustered
    index = index_points(frame(spark, points[:500]), str(tmp_path), 12, pivots=8, slice_points=50)
    plan = plan_of(search_points(spark, index, frame(spark, queries[:3], name="query_id"), 3))
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_odd_vectors(spark, tmp_path):
    data = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0]), (5, [float("nan"), 0.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [float("inf"), 0.0]), (9, [3.0, 4.0])]
    points = spark.createDataFrame(data, POINTS)
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (4, [0.0, 0.0])], "query_id bigint, vector array<double>")
    index = index_points(points, str(tmp_path / "e"), 2)
    assert rows(search_points(spark, index, asked, 3)) == [(1, 1, 2, 0.0), (1, 2, 7, 0.0), (1, 3, 1, 1.0), (4, 1, 1, 0.0), (4, 2, 2, 1.0), (4, 3, 7, 1.0)]
    index = index_points(points, str(tmp_path / "c"), 2, "cosine")
    assert rows(search_points(spark, index, asked, 9)) == [(1, 1, 2, 1.0), (1, 2, 7, 1.0), (1, 3, 9, 0.6)]
    empty = index_points(points.limit(0), str(tmp_path / "n"), 2)
    assert search_points(spark, empty, asked, 3).count() == 0
    assert search_points(spark, index, asked.limit(0), 3).count() == 0
    for bad in ({"metric": "dot"}, {"pivots": 0}, {"slice_points": 0}):
        with pytest.raises(SpecError):
            index_points(points, str(tmp_path / "x"), 2, **bad)
    with pytest.raises(SpecError):
        search_points(spark, index, asked, 0)


def test_near_ties_are_ranked_by_rounded_score(spark, tmp_path):
    """Points closer than the sixth digit to each other: ids decide, also across slices."""
    rng = np.random.default_rng(2)
    points = np.concatenate([np.zeros((300, 3)), rng.normal(size=(300, 3)) * 1e-7, rng.normal(size=(300, 3))])
    order = rng.permutation(len(points))
    collection, asked = frame(spark, points[order]), frame(spark, np.array([[1.0, 2.0, 2.0], [0, 0, 0]]), name="query_id")
    index = index_points(collection, str(tmp_path), 3, pivots=5, slice_points=20)
    assert rows(search_points(spark, index, asked, 25)) == rows(knn_many(collection, asked, 25, "euclid"))


def test_many_queries_for_one_slice(spark, tmp_path, monkeypatch):
    from weirflow.operators import pivots

    monkeypatch.setattr(pivots, "BLOCK", 7)
    rng = np.random.default_rng(3)
    points, queries = rng.normal(size=(400, 4)), rng.normal(size=(90, 4)) * 0.01
    collection, asked = frame(spark, points), frame(spark, queries, name="query_id")
    index = index_points(collection, str(tmp_path), 4, pivots=4, slice_points=64)
    assert rows(search_points(spark, index, asked, 6)) == rows(knn_many(collection, asked, 6, "euclid"))


def test_queries_travel_by_span(spark, tmp_path, monkeypatch):
    """What is dealt grows with spans, not with slices; several spans of a cell give the scan's rows."""
    from weirflow.operators import pivots

    real, dealt = pivots._compared, []
    monkeypatch.setattr(pivots, "_compared", lambda index, pairs, *rest: (dealt.append(pairs), real(index, pairs, *rest))[1])
    rng = np.random.default_rng(6)
    points, queries = rng.normal(size=(900, 16)), rng.normal(size=(20, 16))
    collection, asked = frame(spark, points), frame(spark, queries, name="query_id")
    index = index_points(collection, str(tmp_path), 16, pivots=3, slice_points=10)
    want = rows(knn_many(collection, asked, 5, "euclid"))
    assert rows(search_points(spark, index, asked, 5)) == want
    assert dealt[-1].count() <= 3 * len(queries)
    monkeypatch.setattr(pivots, "SPAN_POINTS", 64)
    assert rows(search_points(spark, index, asked, 5)) == want
