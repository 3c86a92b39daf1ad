"""Upserts in place: only touched buckets are rewritten, and only by commits."""

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from weirflow.sinks import KeyedTable, buckets, compact_buckets, read_buckets, upsert_buckets
from weirflow.specs import SpecError

ROWS = "id bigint, seq bigint, note string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batch(spark, *values):
    return spark.createDataFrame([(i, s, f"{i}-{s}") for i, s in values], ROWS)


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in path.rglob("*.parquet") if p.is_file()}


@pytest.fixture
def table(tmp_path):
    return KeyedTable(str(tmp_path / "t"), ["id"], ["seq"], buckets=8)


def test_upsert_and_replay(spark, table):
    assert upsert_buckets(table, batch(spark, *[(i, 0) for i in range(50)], (3, 2), (3, 1)), 0) == list(range(8))
    assert len(upsert_buckets(table, batch(spark, (7, 5), (99, 1)), 1)) <= 2
    want = {i: 0 for i in range(50)} | {3: 2, 7: 5, 99: 1}
    assert rows(read_buckets(spark, table)) == [(i, s, f"{i}-{s}") for i, s in sorted(want.items())]
    for again in (0, 1):
        assert upsert_buckets(table, batch(spark, (7, 100)), again) == []
    assert len(rows(read_buckets(spark, table))) == 51


def test_one_percent_rewrites_its_buckets_only(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["id"], ["seq"], buckets=100, bucket=F.col("id") % 100)
    start = spark.range(20_000).selectExpr("id", "0L AS seq", "'a' AS note")
    upsert_buckets(table, start, 0)
    before = files(tmp_path / "t" / "rows")
    touched = upsert_buckets(table, start.where("id % 100 = 42").withColumn("seq", F.lit(1).cast("bigint")), 1)
    after = files(tmp_path / "t" / "rows")
    assert touched == [42]
    assert {k: v for k, v in after.items() if k in before} == before
    assert {str(k.parts[0]) for k in after.keys() - before.keys()} == {"bucket=42"}
    read = read_buckets(spark, table)
    assert read.agg(F.sum("seq"), F.count("*")).first() == (200, 20_000)
    plan = plan_of(read)
    assert "Window" not in plan and "Exchange" not in plan and "Join" not in plan
    # One file for each bucket: the version that was replaced is not read.
    assert len(read.inputFiles()) == 100 and not any("bucket=42/version=0" in f for f in read.inputFiles())


def test_failed_batch_changes_nothing(spark, table, monkeypatch):
    upsert_buckets(table, batch(spark, (1, 1), (2, 1)), 0)
    before = rows(read_buckets(spark, table))

    def fail(*_):
        raise OSError("store went away")

    with monkeypatch.context() as m:
        m.setattr(buckets, "_commit", fail)
        with pytest.raises(OSError):
            upsert_buckets(table, batch(spark, (1, 2), (3, 2)), 1)
    assert rows(read_buckets(spark, table)) == before
    upsert_buckets(table, batch(spark, (1, 3)), 1)
    assert rows(read_buckets(spark, table)) == [(1, 3, "1-3"), (2, 1, "2-1")]


def test_compaction(spark, table, tmp_path):
    for n in range(6):
        upsert_buckets(table, batch(spark, (1, n), (n + 10, n)), n)
    want = rows(read_buckets(spark, table))
    assert compact_buckets(spark, table, keep=2) > 0
    assert rows(read_buckets(spark, table)) == want
    assert len(list((tmp_path / "t" / "commits").glob("batch_id=*"))) == 2
    named = {(b, v) for b, v in buckets.current_versions(spark, table)[1].items()}
    compact_buckets(spark, table)
    left = {tuple(int(x.split("=")[1]) for x in p.parts[-2:]) for p in (tmp_path / "t" / "rows").glob("bucket=*/version=*")}
    assert left == named and rows(read_buckets(spark, table)) == want
    upsert_buckets(table, batch(spark, (1, 50)), 6)
    assert (1, 50, "1-50") in rows(read_buckets(spark, table))
    assert compact_buckets(spark, KeyedTable(str(tmp_path / "none"), ["id"])) == 0


def test_odd_batches(spark, table, tmp_path):
    with pytest.raises(SpecError, match="no table"):
        read_buckets(spark, table)
    assert upsert_buckets(table, batch(spark), 0) == []
    assert rows(read_buckets(spark, table)) == []
    with pytest.raises(Exception, match="row without id"):
        upsert_buckets(table, batch(spark).union(spark.createDataFrame([(None, 1, "x")], ROWS)), 1)
    with pytest.raises(SpecError, match="column note"):
        upsert_buckets(table, spark.createDataFrame([(1, 1)], "id bigint, seq bigint"), 1)
    upsert_buckets(table, batch(spark, (1, 1), (1, 1)), 1)
    with pytest.raises(SpecError, match="has 8 buckets"):
        upsert_buckets(KeyedTable(table.path, ["id"], ["seq"], buckets=4), batch(spark, (1, 2)), 2)
    with pytest.raises(SpecError, match="own"):
        upsert_buckets(table, batch(spark, (1, 2)).withColumn("bucket", F.lit(1)), 2)
    wide = KeyedTable(str(tmp_path / "w"), ["id"], ["seq"], buckets=2, bucket=F.col("id"))
    with pytest.raises(SpecError, match="run from 0 to 1"):
        upsert_buckets(wide, batch(spark, (5, 1)), 0)
    for bad in ({"key": []}, {"key": ["id"], "buckets": 0}, {"key": ["id"], "files": 0}):
        with pytest.raises(SpecError):
            KeyedTable("p", **bad)


def test_many_files_and_two_keys(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["id", "note"], ["seq"], buckets=2, files=3)
    start = spark.range(300).selectExpr("id % 30 AS id", "id AS seq", "CAST(id % 2 AS STRING) AS note")
    upsert_buckets(table, start, 0)
    want = rows(start.groupBy("id", "note").agg(F.max("seq").alias("seq")).select("id", "seq", "note"))
    assert rows(read_buckets(spark, table)) == want
    assert len(files(tmp_path / "t" / "rows")) > 2


def test_stream_into_buckets(spark, sf, tmp_path):
    from weirflow.streaming import read_stream, run_stream

    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_id", "value")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
    table = KeyedTable(str(tmp_path / "t"), ["user_id"], ["event_id"], buckets=16)
    stream = read_stream(spark, str(tmp_path / "landed"), events.schema, max_files=1)
    run_stream(stream, lambda df, n: upsert_buckets(table, df, n), "buckets", checkpoint=str(tmp_path / "c")).awaitTermination()
    got = read_buckets(spark, table)
    assert got.count() == events.select("user_id").distinct().count() == got.select("user_id").distinct().count()
