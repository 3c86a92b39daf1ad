"""Plans: what is pruned, pushed down, computed once, and kept off one task."""

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from weirflow import CollectionSpec, FieldMapping, Route
from weirflow.operators import search, stats
from weirflow.operators.once import fence, with_once
from weirflow.operators.points import to_points
from weirflow.operators.project import good_rows, project_fields
from weirflow.operators.routing import on_unrouted_rows, route_exact, route_wildcard
from weirflow.operators.validate import check_schema
from weirflow.plans import inputs
from weirflow.sinks import latest_by_key


def physical(df) -> str:
    plan = plan_of(df)
    return plan[plan.index("== Physical Plan ==") :]


@pytest.fixture
def messages(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(100).select(
        F.concat(F.lit("/t/"), (F.col("id") % 3).cast("string")).alias("topic"),
        F.to_json(F.struct((F.col("id") % 50).alias("k"))).alias("payload"),
        F.lit("unused").alias("noise"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_scan_and_parsing_stays_single(messages):
    typed = project_fields(messages, [FieldMapping("k", "k", "Int64", False)], keep=["topic"])
    good = good_rows(typed).where("topic = '/t/1' AND k > 10")
    plan = physical(good)
    assert "EqualTo(topic,/t/1)" in plan and "noise" not in plan.split("ReadSchema")[1]
    assert sum("parseJson(" in line for line in plan.splitlines()) == 1
    assert "Exchange" not in plan
    assert good.count() == sum(1 for i in range(100) if i % 3 == 1 and i % 50 > 10)


def test_checked_rows_parse_once(messages):
    checked = check_schema(messages, {"type": "object", "properties": {"k": {"maximum": 20}}})
    plan = physical(good_rows(checked).select("topic"))
    assert sum("parseJson(" in line for line in plan.splitlines()) == 1


def test_fence_keeps_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert sorted(map(tuple, fence(df, ["b"]).collect())) == [(1, None), (2, "x")]
    made = with_once(df, c=F.col("a") + 1, d=F.upper("b"))
    assert made.columns == ["a", "b", "c", "d"]
    assert sorted(map(tuple, made.where("c > 2").collect())) == [(2, "x", 3, "X")]


def test_listed_routes_need_no_join(messages):
    routed = on_unrouted_rows(route_wildcard(messages, [Route("/t/+", "/x/y")]), "topic", "drop")
    assert "Join" not in physical(routed) and "Exchange" not in physical(routed)


def test_exact_routes_do_not_move_messages(messages):
    plan = physical(route_exact(messages, [Route("/t/1", "/x/y")]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_aggregates_combine_before_the_shuffle(messages):
    plan = physical(stats.count_by(messages, "topic"))
    assert plan.count("HashAggregate") == 2 and "noise" not in plan.split("ReadSchema")[1]


def test_latest_by_key_cuts_before_the_shuffle(messages):
    plan = physical(latest_by_key(messages, ["topic"], ["payload"]))
    partial = plan.rindex("WindowGroupLimit")
    assert plan.index("Exchange") < partial  # the tree prints the later stage first


def test_search_scores_once_and_keeps_a_heap(spark, sf):
    points = inputs.table(spark, sf, "embeddings").withColumnsRenamed({"vec_id": "id", "embedding": "vector"})
    plan = physical(search.knn(points, [0.5] * 64, 5))
    assert "TakeOrderedAndProject" in plan
    assert sum("zip_with(" in line for line in plan.splitlines()) == 1
    assert "label" not in physical(search.knn(points.select("id", "vector"), [0.5] * 64, 5)).split("ReadSchema")[1]


def test_points_are_one_pass(spark, sf):
    messages = inputs.vector_messages(inputs.table(spark, sf, "embeddings"))
    plan = physical(good_rows(to_points(messages, CollectionSpec("c", 64), keep=("vec_id",))))
    # Payloads of any depth stay in the JVM, and are parsed once.
    assert "Exchange" not in plan and "Python" not in plan
    assert sum("parseJson(" in line for line in plan.splitlines()) == 1
