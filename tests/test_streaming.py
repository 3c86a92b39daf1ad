"""The same operators over a stream give the rows they give over a batch."""

import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weirflow import CollectionSpec, FieldMapping, Route
from weirflow.operators.limit import rate_limit
from weirflow.operators.points import to_points
from weirflow.operators.project import good_rows, project_fields
from weirflow.operators.routing import route_wildcard
from weirflow.operators.validate import check_schema
from weirflow.plans import inputs
from weirflow.sinks import fan_out, read_latest, write_batch
from weirflow.sinks.fanout import table_writer
from weirflow.sources import from_device_publishes, read_table
from weirflow.streaming import (
    counters,
    observed,
    partition_by_key,
    rate_limit_stream,
    read_stream,
    run_stream,
    run_with_retries,
)


@pytest.fixture(scope="module")
def landed(spark, sf, tmp_path_factory):
    """Events landed in several files one after the other, as a folder a stream follows."""
    path = str(tmp_path_factory.mktemp("landed") / "events")
    events = inputs.table(spark, sf, "events")
    quarter = F.ntile(4).over(Window.orderBy("ts", "event_id"))
    parts = events.withColumn("part", quarter).persist()
    for i in range(1, 5):
        parts.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)  # files are taken in the order of their change times
    parts.unpersist()
    return path, events.schema


def drain(df, tmp_path, name):
    """Run a stream to its end and return what it stored."""
    out = str(tmp_path / name)
    query = run_stream(df, lambda rows, i: write_batch(rows, out, i), name, checkpoint=str(tmp_path / f"{name}-c"))
    query.awaitTermination()
    return df.sparkSession.read.parquet(out).drop("batch_id")


def same(a, b):
    key = [str(tuple(r)) for r in a.collect()]
    other = [str(tuple(r)) for r in b.select(*a.columns).collect()]
    return sorted(key) == sorted(other) and len(key) > 0


def shapes():
    mappings = [FieldMapping("k", "k", "Int64", False), FieldMapping("k", "t", "Utf8")]
    routes = [Route("/events/+", "/one/all"), Route("#", "/one/rest")]
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 50}}}
    return {
        "route": lambda e: route_wildcard(inputs.messages(e), routes).select("topic", "to"),
        "typed": lambda e: project_fields(inputs.messages(e), mappings, keep=["topic"]).withColumn(
            "_errors", F.to_json("_errors")
        ),
        "checked": lambda e: check_schema(inputs.messages(e), schema).select("payload", F.to_json("_errors").alias("e")),
        "devices": lambda e: from_device_publishes(inputs.device_publishes(e), [Route("sensors/#", "/iot/s")]).select(
            "topic", "key", "payload", "publish_time_us", F.to_json("attributes").alias("attributes")
        ),
        "points": lambda e: to_points(inputs.messages(e), CollectionSpec("c", 2)).select("id", F.to_json("_errors").alias("e")),
    }


@pytest.mark.parametrize("name", list(shapes()))
def test_stream_equals_batch(spark, sf, landed, tmp_path, name):
    path, schema = landed
    shape = shapes()[name]
    stream = drain(shape(read_stream(spark, path, schema, max_files=1)), tmp_path, name)
    assert same(shape(inputs.table(spark, sf, "events")), stream)


def test_limiter_stream_equals_batch(spark, sf, landed, tmp_path):
    path, schema = landed
    args = dict(key=["event_type"], ts="ts", id="event_id", rate=1, burst=2, per_seconds=14_400)
    stream = drain(rate_limit_stream(read_stream(spark, path, schema, max_files=1), **args), tmp_path, "limit")
    batch = rate_limit(inputs.table(spark, sf, "events"), **args)
    assert same(batch, stream)
    assert 0 < batch.where("allowed").count() < batch.count()


def test_fan_out_stream(spark, landed, tmp_path):
    path, schema = landed
    types = ["click", "error", "purchase", "signup", "view"]
    routes = [Route(f"/events/{t}", str(tmp_path / t)) for t in types]
    messages = inputs.messages(read_stream(spark, path, schema, max_files=2))
    shape = lambda route, df: good_rows(project_fields(df, [FieldMapping("k", "k", "Int64")], keep=["topic"]))

    def sink(df, batch_id):
        fan_out(df, routes, table_writer(shape, batch_id), batch_id, log_path=str(tmp_path / "log"))

    run_stream(messages, sink, "fan", checkpoint=str(tmp_path / "c")).awaitTermination()
    total = sum(read_table(spark, r.to).count() for r in routes)
    log = read_table(spark, str(tmp_path / "log"))
    assert total == spark.read.parquet(path).count() == log.agg(F.sum("rows")).first()[0]
    assert log.select("batch_id").distinct().count() == 2


def test_counters_of_a_stream(spark, landed, tmp_path):
    path, schema = landed
    events = observed(read_stream(spark, path, schema, max_files=1), "rows", F.col("event_id") % 10 == 0)
    query = run_stream(events, lambda df, i: df.write.format("noop").mode("append").save(), "seen", checkpoint=str(tmp_path / "c"))
    query.awaitTermination()
    table = spark.read.parquet(path)
    want = {"processed": table.count(), "failed": table.where("event_id % 10 = 0").count()}
    assert counters(query, "rows") == want


def test_upsert_stream(spark, landed, tmp_path):
    path, schema = landed
    out = str(tmp_path / "t")
    events = read_stream(spark, path, schema, max_files=1).select("user_id", "event_id", "value")
    run_stream(events, lambda df, i: write_batch(df, out, i), "up", checkpoint=str(tmp_path / "c")).awaitTermination()
    got = read_latest(spark, out, ["user_id"], ["event_id"])
    everything = spark.read.parquet(path)
    want = everything.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert same(want, got)


def test_failed_batch_runs_again(spark, landed, tmp_path):
    path, schema = landed
    out, tries = str(tmp_path / "t"), []

    def sink(df, batch_id):
        write_batch(df.select("event_id"), out, batch_id)
        tries.append(batch_id)
        if len(tries) in (2, 3):
            raise OSError("store went away")

    def start():
        return run_stream(read_stream(spark, path, schema, max_files=1), sink, "again", checkpoint=str(tmp_path / "c"))

    run_with_retries(start, backoff_seconds=0.01)
    assert tries == [0, 1, 1, 1, 2, 3]
    assert spark.read.parquet(out).count() == spark.read.parquet(path).count()


def test_fatal_error_is_not_retried(spark, landed, tmp_path):
    path, schema = landed
    starts = []

    def start():
        starts.append(1)
        df = read_stream(spark, path, schema).select(F.raise_error(F.lit("bad row")).cast("string").alias("x"))
        return run_stream(df, lambda rows, i: rows.collect(), "fatal", checkpoint=str(tmp_path / "c"))

    with pytest.raises(Exception, match="bad row"):
        run_with_retries(start, backoff_seconds=0.01)
    assert len(starts) == 1


def test_default_checkpoint_and_partitions(spark, landed):
    path, schema = landed
    seen = []
    run_stream(read_stream(spark, path, schema), lambda df, i: seen.append(df.count()), "ckpt-default").awaitTermination()
    assert sum(seen) == spark.read.parquet(path).count()
    df = spark.range(100).withColumn("key", F.col("id") % 7)
    parts = partition_by_key(df, 5).withColumn("p", F.spark_partition_id())
    assert parts.groupBy("key").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
    assert partition_by_key(df, 0) is df
