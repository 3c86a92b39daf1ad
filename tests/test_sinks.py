import pytest
from helpers import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow import CollectionSpec, Route, SpecError
from weirflow.operators import stats
from weirflow.sinks import (
    catalog_frame,
    ensure_collection,
    ensure_table,
    fan_out,
    insert_documents,
    new_documents,
    read_latest,
    storage_conf,
    storage_root,
    upsert_by_key,
    write_append,
    write_batch,
    write_overwrite,
    write_partitioned,
)
from weirflow.sinks.fanout import FanOutError, table_writer
from weirflow.sinks.tables import without_key
from weirflow.sources import read_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    write_append(df, path)
    write_append(df, path)
    assert read_table(spark, path).count() == 6
    write_overwrite(df, path)
    assert read_table(spark, path).count() == 3


def test_repeated_batch_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch_id in (0, 1, 1):
        write_batch(spark.range(3), path, batch_id)
    assert read_table(spark, path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 3), (1, 3)]


def test_ensure_table(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert ensure_table(spark, path, schema).count() == 0
    write_append(spark.createDataFrame([(1, "x")], schema), path)
    assert rows(ensure_table(spark, path, schema)) == [(1, "x")]
    with pytest.raises(SpecError, match="column c"):
        ensure_table(spark, path, schema.add("c", T.LongType()))
    with pytest.raises(Exception, match="(?i)nosuchformat"):
        ensure_table(spark, path, schema, "nosuchformat")


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id bigint, v string, seq bigint")
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 3), (2, "z", 2), (3, "n", 1)], "id bigint, v string, seq bigint")
    got = upsert_by_key(target, batch, ["id"], ["seq"])
    assert rows(got) == [(1, "a", 0), (2, "y", 3), (3, "n", 1)]
    assert "WindowGroupLimit" in plan_of(got)


def test_upsert_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id bigint, v string, seq bigint"
    write_batch(spark.createDataFrame([(1, "a", 5), (2, "b", 5)], schema), path, 0)
    write_batch(spark.createDataFrame([(2, "c", 1), (2, "d", 2)], schema), path, 1)
    assert rows(read_latest(spark, path, ["id"], ["seq"]).select("id", "v", "seq")) == [(1, "a", 5), (2, "d", 2)]


def test_insert_documents(spark):
    schema = "id string, doc string, seq bigint"
    target = spark.createDataFrame([("t:1", "old", 0)], schema)
    batch = spark.createDataFrame([("t:1", "new", 1), ("t:2", "p", 1), ("t:2", "q", 2), (None, "n", 1), (None, "n", 2)], schema)
    first = insert_documents(target, batch, "t", ["seq"])
    kept = {r.id: r.doc for r in first.collect()}
    assert kept["t:1"] == "old" and kept["t:2"] == "p" and len(kept) == 4
    assert all(i.startswith("t:") for i in kept)
    last = {r.id: r.doc for r in insert_documents(target, batch, "t", ["seq"], on_conflict="keep_last").collect()}
    assert last["t:1"] == "new" and last["t:2"] == "q" and len(last) == 4
    assert new_documents(target, batch, "t", ["seq"]).count() == 3
    with pytest.raises(SpecError):
        insert_documents(target, batch, "t", ["seq"], on_conflict="merge")


def test_collections(spark):
    empty = catalog_frame(spark, [CollectionSpec("a", 4)])
    grown = ensure_collection(empty, CollectionSpec("b", 8, "dot"))
    assert rows(grown) == [("a", 4, "cosine"), ("b", 8, "dot")]
    assert ensure_collection(grown, CollectionSpec("b", 8, "dot")).count() == 2
    with pytest.raises(SpecError, match="dimension 8"):
        ensure_collection(grown, CollectionSpec("b", 9, "dot"))
    with pytest.raises(SpecError, match="may not be made"):
        ensure_collection(grown, CollectionSpec("c", 8, auto_create=False))


def test_storage_conf():
    s3 = storage_conf("s3", region="r", endpoint="http://h:9000", allow_http=True)
    assert s3["fs.s3a.endpoint"] == "http://h:9000" and s3["fs.s3a.connection.ssl.enabled"] == "false"
    assert "fs.s3a.endpoint" not in storage_conf("s3", region="r")
    assert storage_conf("gcs", project="p") == {"fs.gs.project.id": "p"}
    assert storage_conf("azure", account="a", container="c") == {"fs.azure.account.auth.type.a.dfs.core.windows.net": "SharedKey"}
    assert storage_root("azure", account="a", container="c") == "abfss://c@a.dfs.core.windows.net"


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("/a/x", "1"), ("/a/x", "2"), ("/a/y", "3"), ("/a/none", "4")], "topic string, payload string")


def test_fan_out(spark, batch, tmp_path):
    x, y, log_path = (str(tmp_path / n) for n in ("x", "y", "log"))
    routes = [Route("/a/x", x), Route("/a/y", y), Route("/a/quiet", str(tmp_path / "q"))]
    write = table_writer(lambda route, df: df.select("payload"), batch_id=7)
    with pytest.raises(SpecError, match="No route"):
        fan_out(batch, routes, write)
    assert not (tmp_path / "x").exists()
    aside = []
    for _ in range(2):
        log = fan_out(
            batch, routes, write, 7, "quarantine",
            quarantine=lambda df: aside.append([r.payload for r in df.collect()]), log_path=log_path,
        )
    assert rows(read_table(spark, x).select("payload")) == [("1",), ("2",)]
    assert rows(read_table(spark, y).select("payload")) == [("3",)]
    assert read_table(spark, str(tmp_path / "q")).count() == 0 and aside == [["4"], ["4"]]
    assert rows(log.select("topic", "rows", "error")) == [("/a/x", 2, None), ("/a/y", 1, None)]
    assert read_table(spark, log_path).count() == 4
    assert fan_out(batch, routes, write, 8, "drop").count() == 2


def test_fan_out_errors(spark, batch, tmp_path):
    def write(target, parts):
        if target == "x":
            raise OSError("disk gone " + "and " * 300 + "again")
        for _, df in parts:
            df.write.parquet(target)

    routes = [Route("/a/x", "x"), Route("/a/y", str(tmp_path / "y"))]
    with pytest.raises(FanOutError, match="disk gone") as info:
        fan_out(batch, routes, write, 3, "drop")
    assert (tmp_path / "y").exists()  # the other route was written
    errors = {r.to: r.error for r in stats.route_last_error(info.value.log).collect()}
    assert errors["x"].endswith("again") and errors[str(tmp_path / "y")] is None


@pytest.mark.parametrize("parallel", [1, 4])
def test_topics_share_a_table(spark, batch, tmp_path, parallel):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    routes = [Route("/a/x", one), Route("/a/y", one), Route("/a/none", two)]
    declared = T.StructType([T.StructField("payload", T.StringType())])
    write = table_writer(lambda route, df: df.select("payload"), 3, declared=declared)
    for _ in range(2):
        log = fan_out(batch, routes, write, 3, parallel=parallel)
        assert rows(read_table(spark, one).select("payload")) == [("1",), ("2",), ("3",)]
    assert rows(log.select("topic", "rows")) == [("/a/none", 1), ("/a/x", 2), ("/a/y", 1)]
    # A repeat that brings less, or nothing, replaces what was stored.
    fan_out(batch.where("topic = '/a/y'"), routes, write, 3, parallel=parallel)
    assert rows(read_table(spark, one).select("payload")) == [("3",)]
    assert read_table(spark, two).select("payload").count() == 0
    fan_out(batch.limit(0), routes, write, 3, parallel=parallel)
    assert read_table(spark, one).count() == 0
    wrong = table_writer(lambda route, df: df.select(F.lit(1).alias("payload")), 4, declared=declared)
    with pytest.raises(FanOutError, match="column payload"):
        fan_out(batch, routes, wrong, 4)


def test_rows_without_a_key(spark):
    target = spark.createDataFrame([(1, "a", 0)], "id bigint, v string, seq bigint")
    batch = spark.createDataFrame([(None, "x", 1), (None, "y", 2), (2, "z", 1)], "id bigint, v string, seq bigint")
    with pytest.raises(Exception, match="row without id"):
        upsert_by_key(target, batch, ["id"], ["seq"]).collect()
    assert without_key(batch, ["id"]).count() == 2
    assert rows(upsert_by_key(target, batch.where("id IS NOT NULL"), ["id"], ["seq"])) == [(1, "a", 0), (2, "z", 1)]


def test_partitioned_write(spark, batch, tmp_path):
    path = str(tmp_path / "t")
    routes = [Route("/a/x", "one"), Route("/a/y", "two")]
    for _ in range(2):
        write_partitioned(batch, routes, path, batch_id=4)
    assert rows(read_table(spark, path).groupBy("to").count()) == [("one", 2), ("two", 1)]
    write_partitioned(batch, routes, str(tmp_path / "u"))
    assert read_table(spark, str(tmp_path / "u")).where("to = 'one'").count() == 2


def test_log_statistics(spark):
    log = spark.createDataFrame(
        [
            (0, "/a/x", "x", 10, None, 100, None),
            (1, "/a/x", "x", 30, None, 300, "boom"),
            (2, "/a/x", "x", 20, None, 200, None),
            (0, "/a/y", "y", 5, None, 50, None),
            (1, "/a/y", "y", 5, None, 60, "late"),
        ],
        stats.BATCH_LOG,
    )
    per_route = stats.log_stats(log)
    assert rows(per_route) == [("x", 30, 2), ("y", 5, 1)]
    assert rows(stats.route_totals(per_route)) == [(35, 3, 2)]
    assert rows(stats.route_last_error(log)) == [("x", 2, None), ("y", 1, "late")] or {
        r.to: r.error for r in stats.route_last_error(log).collect()
    } == {"x": None, "y": "late"}
    x = {r.to: r for r in stats.batch_profile(log).collect()}["x"]
    assert (x.batches, x.min_rows, x.max_rows, x.avg_rows, x.median_rows, x.p95_ms) == (3, 10, 30, 20.0, 20, 300)


def test_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "v string")
    assert [tuple(r) for r in stats.value_counts(df, "v").collect()] == [("b", 2), ("a", 1)]
    assert stats.total_count(df).first().n == 3
    assert [r.v for r in stats.first_rows(df, 2, "v").collect()] == ["a", "b"]
    assert [tuple(r) for r in stats.table_columns(df).collect()] == [(0, "v", "string")]
    quality = stats.quality_stats(df, F.col("v") == "a").first()
    assert (quality.processed, quality.failed) == (3, 1)
    routes = spark.createDataFrame(
        [(0, "/a/x", 1, False), (1, "/a/x", 4, True), (2, "/a/y", 0, False)],
        "idx int, to string, partitions int, reliable boolean",
    )
    assert rows(stats.topic_properties(routes)) == [("/a/x", 4, True), ("/a/y", 0, False)]
