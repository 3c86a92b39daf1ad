"""Time-bucketed tables, and statistics from sketches."""

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from weirflow.operators.sketches import figures_of, merge_sketches, read_sketches, sketch, store_sketches
from weirflow.plans import inputs
from weirflow.sinks import read_timed, write_timed
from weirflow.sinks.timed import BUCKET, buckets_of
from weirflow.specs import SpecError


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_range_reads_its_buckets_only(spark, sf, tmp_path, unit):
    path = str(tmp_path / "t")
    events = inputs.table(spark, sf, "events")
    if unit == "hour":
        events = events.where("ts < TIMESTAMP_NTZ '2024-01-02 06:00:00'")
    write_timed(events, path, "ts", unit, spread=1)
    low, high = events.agg(F.percentile_approx(F.unix_seconds(F.col("ts").cast("timestamp")), [0.4, 0.5])).first()[0]
    start, end = (r[0] for r in spark.createDataFrame([(low,), (high,)], "s bigint").select(F.timestamp_seconds("s").cast("string")).collect())
    got = read_timed(spark, path, "ts", start, end, unit)
    want = events.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
    assert got.columns == events.columns and rows(got) == rows(want) and 0 < want.count() < events.count()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan_of(got)
    assert rows(read_timed(spark, path, "ts", unit=unit)) == rows(events)
    assert rows(read_timed(spark, path, "ts", end=start, unit=unit)) == rows(events.where(F.col("ts") < F.lit(start).cast("timestamp_ntz")))


def test_edges_and_rows_without_time(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(1, "2024-02-29 23:59:59.999999"), (2, "2024-03-01 00:00:00"), (3, None), (4, "2024-03-02 00:00:00"), (5, "1999-12-31 00:00:00")]
    df = spark.createDataFrame(data, "id int, at string").select("id", F.to_timestamp("at").alias("at"))
    for n in (0, 1, 1):  # the second batch is stored twice
        write_timed(df.withColumn("id", F.col("id") + 10 * n), path, "at", batch_id=n)
    ids = lambda *r: sorted(x.id for x in read_timed(spark, path, "at", *r).collect())
    assert ids("2024-03-01", "2024-03-02") == [2, 12]
    assert ids("2024-02-29 23:59:59.999999", "2024-03-02 00:00:00.000001") == [1, 2, 4, 11, 12, 14]
    assert ids("2024-03-01", "2024-03-01") == []
    assert ids(None, "2000-01-01") == [5, 15] and ids("2024-03-02") == [4, 14]
    assert ids() == [1, 2, 3, 4, 5, 11, 12, 13, 14, 15]
    assert buckets_of(spark, path) == ["d1999-12-31", "d2024-02-29", "d2024-03-01", "d2024-03-02", "none"]
    with pytest.raises(SpecError):
        write_timed(df, path, "at", "week")
    with pytest.raises(SpecError):
        read_timed(spark, path, "at", "soon")
    with pytest.raises(SpecError):
        write_timed(df.withColumn(BUCKET, F.lit(1)), path, "at")


def test_files_of_a_bucket_are_few(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(10_000).repartition(16).select("id", F.timestamp_seconds(F.col("id") * 30).alias("at"))
    write_timed(df, str(path), "at", spread=2)
    assert all(len(list(b.glob("*.parquet"))) <= 2 for b in path.glob(f"{BUCKET}=*"))
    assert len(list(path.glob(f"{BUCKET}=*"))) == 4


# -- sketches ----------------------------------------------------------------------------


def exact(df, by):
    q = lambda s: F.expr(f"percentile_disc({s}) WITHIN GROUP (ORDER BY v)")
    return {
        r.g: r for r in df.groupBy(by).agg(F.count("*").alias("n"), F.count_distinct("u").alias("u"), F.sum("v").alias("s"), F.min("v").alias("low"),
        F.max("v").alias("high"), q(0.5).alias("p50"), q(0.95).alias("p95")).collect()
    }


def test_small_groups_are_exact(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(900).selectExpr("id % 9 AS g", "id * 7919 % 101 AS v", "id % 37 AS u", "id % 5 AS b")
    for b in range(5):
        store_sketches(df.where(F.col("b") == b), path, b, ["g"], ["u"], ["v"])
    store_sketches(df.where("b = 4"), path, 4, ["g"], ["u"], ["v"])  # a repeat
    for merged, want in ((read_sketches(spark, path, ["g"]), df), (read_sketches(spark, path, ["g"], 1, 2), df.where("b in (1, 2)"))):
        got = {r.g: r for r in figures_of(merged, ["g"], {"p50": 0.5, "p95": 0.95}).collect()}
        assert got.keys() == exact(want, "g").keys()
        for g, w in exact(want, "g").items():
            r = got[g]
            assert (r.n, r.u_distinct, r.v_sum, r.v_min, r.v_max, r.v_p50, r.v_p95) == tuple(w)[1:]


def test_stated_errors(spark):
    n = 300_000
    df = spark.range(n).selectExpr("id % 2 AS g", "id * 7919 % 300007 AS v", "id DIV 3 AS u", "id % 20 AS b")
    whole = merge_sketches(sketch(df, ["g", "b"], ["u"], ["v"]), ["g"])
    got = {r.g: r for r in figures_of(whole, ["g"], {"p50": 0.5, "p95": 0.95}).collect()}
    for g, w in exact(df, "g").items():
        r = got[g]
        assert (r.n, r.v_sum, r.v_min, r.v_max) == (w.n, w.s, w.low, w.high)
        assert abs(r.u_distinct / w.u - 1) < 3 * 0.016
        for share, x in ((0.5, r.v_p50), (0.95, r.v_p95)):
            assert abs(df.where((F.col("g") == g) & (F.col("v") <= x)).count() / w.n - share) < 0.007


def test_odd_logs(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None), (1, 5, "a"), (2, None, None)], "g int, v int, u string")
    got = {r.g: tuple(r)[1:] for r in figures_of(sketch(df, ["g"], ["u"], ["v"]), ["g"], {"p50": 0.5}).collect()}
    assert got == {1: (2, 1, 5, 5, 5, 5), 2: (1, 0, None, None, None, None)}
    assert sketch(df.limit(0), ["g"], ["u"], ["v"]).count() == 0
    with pytest.raises(SpecError):
        sketch(df, ["g"], ["v"], ["v"])
    with pytest.raises(SpecError):
        read_sketches(spark, str(tmp_path / "none"), ["g"])


def test_statistics_read_sketches_only(spark, sf, tmp_path):
    """The log is read once, when its batch is stored."""
    path = str(tmp_path / "s")
    store_sketches(inputs.table(spark, sf, "events").withColumn("v", F.col("event_id") % 100), path, 0, ["event_type"], ["user_id"], ["v"])
    plan = plan_of(figures_of(read_sketches(spark, path, ["event_type"]), ["event_type"], {"p50": 0.5}))
    assert "events.parquet" not in plan and path in plan
