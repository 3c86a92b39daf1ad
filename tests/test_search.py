from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from helpers import column, plan_of
from pyspark.sql import functions as F

from weirflow import CollectionSpec
from weirflow.operators import search
from weirflow.sinks import catalog_frame

METRICS = ["cosine", "dot", "euclid", "manhattan"]


def brute(points, q, k, metric):
    """The answer by full sort: [(id, score)]."""
    rows = []
    for i, p in points:
        p, v = np.asarray(p, "float64"), np.asarray(q, "float64")
        if metric == "cosine":
            n = np.linalg.norm(p) * np.linalg.norm(v)
            if n == 0:
                continue
            s = p @ v / n
        elif metric == "dot":
            s = p @ v
        elif metric == "euclid":
            s = np.sqrt(((p - v) ** 2).sum())
        else:
            s = np.abs(p - v).sum()
        rows.append((i, round(float(s), 6)))
    sign = -1 if metric in ("cosine", "dot") else 1
    return sorted(rows, key=lambda r: (sign * r[1], r[0]))[:k]


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(3)
    points = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(400)]
    # A third of the collection is the same vector; one vector is zero.
    points += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.0]) for i in range(200)]
    points += [(5000, [0.0] * 6)]
    queries = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(25)]
    pdf = spark.createDataFrame(points, "id bigint, vector array<float>").repartition(5)
    qdf = spark.createDataFrame(queries, "query_id bigint, vector array<float>")
    return points, queries, pdf, qdf


@pytest.mark.parametrize("metric", METRICS)
def test_one_query(world, metric):
    points, queries, pdf, _ = world
    got = [(r.id, r.score) for r in search.knn(pdf, queries[0][1], 7, metric).collect()]
    assert got == brute(points, queries[0][1], 7, metric)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_many_queries(world, metric, block_bytes):
    points, queries, pdf, qdf = world
    got = search.knn_many(pdf, qdf, 9, metric, block_bytes=block_bytes)
    plan = plan_of(got)
    assert not any(x in plan for x in ("NestedLoop", "Cartesian", "Generate", "explode"))
    by_query = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.id, round(r.score, 6)))
    assert by_query == {i: brute(points, q, 9, metric) for i, q in queries}


def test_wide_ids_and_other_lengths(spark):
    big = Decimal(2**64 - 1)
    pdf = spark.createDataFrame(
        [(big, [1.0, 0.0]), (Decimal(2), [1.0, 0.0]), (Decimal(3), [1.0])],
        "id decimal(20,0), vector array<float>",
    )
    qdf = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vector array<float>")
    got = [(r.query_id, r.rank, r.id) for r in search.knn_many(pdf, qdf, 5).orderBy("rank").collect()]
    assert got == [("q", 1, Decimal(2)), ("q", 2, big)]
    assert [r.id for r in search.knn(pdf, [2.0, 0.0], 5).collect()] == [Decimal(2), big]
    assert search.knn_many(pdf, qdf.limit(0), 5).count() == 0


def test_points_without_a_score_come_last(spark):
    pdf = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0])], "id bigint, vector array<float>")
    qdf = spark.createDataFrame([(7, [1.0, 0.0])], "query_id bigint, vector array<float>")
    want = [(2, 0.707107), (1, None), (3, None)]
    assert [(r.id, r.score) for r in search.knn(pdf, [1.0, 0.0], 5).collect()] == want
    got = search.knn_many(pdf, qdf, 5).orderBy("rank").collect()
    assert [(r.id, None if r.score is None or r.score != r.score else round(r.score, 6)) for r in got] == want
    assert [r.id for r in search.knn_many(pdf, qdf, 2).orderBy("rank").collect()] == [2, 1]


def test_single_query_plan(world):
    _, queries, pdf, _ = world
    plan = plan_of(search.knn(pdf, queries[0][1], 3))
    assert "TakeOrderedAndProject" in plan


def test_format_hits(spark):
    hits = spark.sql(
        """select 1 id, 0.98765432D score, map('text', parse_json('"hi"'), 'n', parse_json('3'),
           '_msg_topic', parse_json('"/a/b"')) payload_fields
           union all select 2, 0.5D, map('x', parse_json('1'))"""
    )
    got = search.format_hits(hits, ["text", "n"], metadata_prefix="_msg_").orderBy("rank").collect()
    assert tuple(got[0]) == (1, 0.9877, "hi", "3", {"_msg_topic": "/a/b"})
    assert tuple(got[1]) == (2, 0.5, "N/A", "N/A", {})


def test_embed_hook(spark):
    def encoder(text: pd.Series):
        return [[float(len(t)), 1.0] for t in text]

    df = spark.createDataFrame([("ab",), ("abc",)], "text string")
    assert column(search.embed(df, "text", encoder), F.col("vector")) == [[2.0, 1.0], [3.0, 1.0]]


def test_collections(spark):
    catalog = catalog_frame(spark, [CollectionSpec("b", 4, "dot"), CollectionSpec("a", 2)])
    from weirflow.operators.stats import collection_info, list_collections

    assert [r.name for r in list_collections(catalog).collect()] == ["a", "b"]
    points = spark.createDataFrame([([1.0, 2.0],), ([1.0, 3.0],)], "vector array<float>")
    row = collection_info(points, catalog, "a").first()
    assert tuple(row) == ("a", 2, 2, 2, "cosine")
