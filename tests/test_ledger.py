"""Ledger, retries, dead letters, lasting counters and batches of bounded size."""

import pytest
from pyspark.sql import functions as F

from weirflow import FieldMapping, Route
from weirflow.operators.project import good_rows, project_fields
from weirflow.sinks import Ledger, Retry, fan_out, write_batch
from weirflow.sinks.fanout import FanOutError, table_writer
from weirflow.sinks.ledger import attempt, conditions, is_fatal
from weirflow.specs import SpecError
from weirflow.streaming import (
    Landing,
    batch_log,
    counted,
    counter_totals,
    read_stream,
    run_batches,
    run_stream,
    run_with_retries,
    stored_counts,
)
from weirflow.streaming.batches import cut


@pytest.fixture
def messages(spark):
    rows = [(f"/t/{i % 3}", f'{{"k": {i}}}') for i in range(30)]
    return spark.createDataFrame(rows, "topic string, payload string")


def shape(_, rows):
    return good_rows(project_fields(rows, [FieldMapping("k", "k", "Int64")], keep=["topic"]))


def writer_that_fails(batch_id, errors, seen):
    """The table writer, raising the errors that are listed for a target first."""
    inner = table_writer(shape, batch_id)

    def write(target, parts):
        seen.append(target)
        left = errors.get(target, [])
        if left:
            raise left.pop(0)
        inner(target, parts)

    return write


def raised(df):
    with pytest.raises(Exception) as caught:  # noqa: PT011 - any
        df.collect()
    return caught.value


def test_errors_are_told_by_condition(spark):
    stop = raised(spark.range(1).select(F.raise_error(F.lit("no"))))
    assert "USER_RAISED_EXCEPTION" in conditions(stop) and is_fatal(stop)
    wrapped = RuntimeError("batch")
    wrapped.__cause__ = stop
    assert is_fatal(wrapped) and is_fatal(SpecError("x"))
    assert is_fatal(raised(spark.sql("SELECT CAST('x' AS INT) / id FROM range(1)")))
    with pytest.raises(Exception) as missing:  # noqa: PT011
        spark.table("no_such_table")
    assert is_fatal(missing.value)
    # Texts do not count.
    assert not is_fatal(OSError("SpecError AnalysisException USER_RAISED_EXCEPTION"))


def test_attempts():
    tries = []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("away")

    assert attempt(work, Retry(5, 0)) == (3, None)
    n, error = attempt(lambda: (_ for _ in ()).throw(OSError("gone")), Retry(2, 0))
    assert n == 2 and isinstance(error, OSError)
    assert attempt(lambda: (_ for _ in ()).throw(SpecError("bad")), Retry(9, 0))[0] == 1
    with pytest.raises(SpecError):
        Retry(0)


def test_a_retry_writes_only_what_failed(spark, messages, tmp_path):
    routes = [Route(f"/t/{i}", str(tmp_path / f"t{i % 2}")) for i in range(3)]
    ledger, seen = Ledger(str(tmp_path / "ledger")), []
    write = writer_that_fails(7, {routes[1].to: [OSError("a"), OSError("b")]}, seen)
    with pytest.raises(FanOutError):
        fan_out(messages, routes, write, 7, ledger=ledger, retry=Retry(2, 0))
    assert sorted(seen) == sorted([routes[0].to, routes[1].to, routes[1].to])
    assert ledger.done(spark, 7) == {routes[0].to}
    seen.clear()
    fan_out(messages, routes, write, 7, ledger=ledger)
    assert seen == [routes[1].to]
    seen.clear()
    assert fan_out(messages, routes, write, 7, ledger=ledger).count() == 0
    assert seen == [] and ledger.done(spark, 8) == set()
    assert [spark.read.parquet(r.to).count() for r in routes[:2]] == [20, 10]
    entries = {r.target: (r.batch_id, r.state, r.attempts) for r in ledger.entries(spark).collect()}
    assert entries == {routes[0].to: (7, "stored", 1), routes[1].to: (7, "stored", 1)}


def test_bad_rows_are_set_aside(spark, messages, tmp_path):
    routes = [Route(f"/t/{i}", str(tmp_path / f"t{i}")) for i in range(3)]
    ledger, dead = Ledger(str(tmp_path / "ledger")), str(tmp_path / "dead")
    write = writer_that_fails(0, {routes[2].to: [SpecError("column k is a string")]}, [])
    log = fan_out(
        messages, routes, write, 0, ledger=ledger, retry=Retry(3, 0), dead_letter=lambda rows, n: write_batch(rows, dead, n)
    )
    assert log.where("error IS NOT NULL").count() == 1
    letters = spark.read.parquet(dead)
    assert letters.count() == 10 and letters.select("_target", "_error").distinct().collect() == [
        (routes[2].to, "SpecError: column k is a string")
    ]
    assert ledger.entries(spark).where("state = 'dead'").select("target").collect() == [(routes[2].to,)]
    # An error that may pass is no dead letter.
    write = writer_that_fails(1, {routes[2].to: [OSError("away")] * 2}, [])
    with pytest.raises(FanOutError):
        fan_out(messages, routes, write, 1, ledger=ledger, retry=Retry(2, 0), dead_letter=lambda *_: None)


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "landed")
    for k in range(5):
        spark.range(k * 100, k * 100 + 100).withColumn("bad", F.col("id") % 10 == 0).coalesce(1).write.mode("append").parquet(path)
    return path


def test_sink_errors_are_judged_by_their_kind(spark, landed, tmp_path):
    tries = []

    def sink(df, batch_id):
        tries.append(batch_id)
        if len(tries) == 1:
            raise OSError("SpecError: this text says nothing")
        if len(tries) == 3:
            raise SpecError("no such column")

    def start():
        return run_stream(read_stream(spark, landed, "id bigint", max_files=1), sink, "kinds", checkpoint=str(tmp_path / "c"))

    with pytest.raises(Exception, match="no such column"):
        run_with_retries(start, backoff_seconds=0.01)
    assert tries == [0, 0, 1]


def test_counts_outlive_restarts(spark, landed, tmp_path):
    counts, out, tries = str(tmp_path / "counts"), str(tmp_path / "out"), []

    def store(df, batch_id):
        write_batch(df, out, batch_id)
        tries.append(batch_id)
        if len(tries) == 2:
            raise OSError("away")

    def start():
        sink = counted(store, counts, F.col("bad"))
        return run_stream(read_stream(spark, landed, "id bigint, bad boolean", max_files=1), sink, "counts", checkpoint=str(tmp_path / "c"))

    assert counter_totals(spark, counts).first() == (0, 0, 0)
    run_with_retries(start, backoff_seconds=0.01)
    assert tries == [0, 1, 1, 2, 3, 4]
    assert counter_totals(spark, counts).first() == (5, 500, 50)
    # A sink that reads nothing is counted as well.
    counted(lambda df, n: None, counts, F.col("bad"))(spark.range(7).withColumn("bad", F.lit(None).cast("boolean")), 99)
    assert stored_counts(spark, counts).where("batch_id = 99").first() == (99, 7, 7)


def test_sums_over_many_batches(spark, tmp_path):
    """Far more batches than a query's progress keeps."""
    counts = str(tmp_path / "counts")
    rows = spark.range(500).selectExpr("id AS batch_id", "10L AS processed", "1L AS failed")
    rows.repartition(8).write.partitionBy("batch_id").parquet(counts)
    df = spark.range(3).withColumn("bad", F.lit(False))
    for again in (500, 500):
        counted(lambda d, n: d.count(), counts, F.col("bad"))(df, again)
    assert counter_totals(spark, counts).first() == (501, 5003, 500)


def test_cut():
    files = [("a", 0, 5, 10), ("b", 2, 4, 20), ("c", 0, 9, 30)]
    assert cut(files, 6, 100, 50) == [
        [("a", 0, 4, 10), ("b", 2, 2, 20)],
        [("b", 3, 3, 20), ("c", 0, 4, 30)],
    ]
    assert cut(files, 6, 20, 50)[2:] == [[("c", 5, 8, 30)]]
    assert cut(files, 100, 41, 50) == [] and len(cut(files, 100, 40, 50)) == 1
    assert cut([], 5, 0, 0) == []


def test_batches_by_rows_and_time(spark, landed, tmp_path):
    landing = Landing(landed, spark.read.parquet(landed).schema, str(tmp_path / "state"), 130, 3600)
    out, clock = str(tmp_path / "out"), [0.0]
    fails = [2]

    def sink(df, n):
        write_batch(df, out, n)
        if n in fails:
            fails.remove(n)
            raise OSError("away")

    import time

    clock[0] = time.time() * 1000
    with pytest.raises(OSError):
        run_batches(spark, landing, sink, lambda: clock[0])
    assert run_batches(spark, landing, sink, lambda: clock[0]) == [2]  # as planned, then the rest waits
    assert run_batches(spark, landing, sink, lambda: clock[0]) == []
    spark.range(1000, 1045).withColumn("bad", F.lit(False)).coalesce(1).write.mode("append").parquet(landed)
    assert run_batches(spark, landing, sink, lambda: clock[0]) == [3]
    assert run_batches(spark, landing, sink, lambda: clock[0]) == []
    clock[0] += 3700 * 1000
    assert run_batches(spark, landing, sink, lambda: clock[0]) == [4]
    log = {r.batch_id: (r.rows, r.full) for r in batch_log(spark, landing).collect()}
    assert log == {0: (130, True), 1: (130, True), 2: (130, True), 3: (130, True), 4: (25, False)}
    stored = spark.read.parquet(out)
    assert stored.count() == 545 and stored.select("id").distinct().count() == 545
    sizes = {r.batch_id: r.n for r in stored.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert sizes == {k: v[0] for k, v in log.items()}


def test_batches_of_nothing(spark, tmp_path):
    schema = spark.range(1).schema
    landing = Landing(str(tmp_path / "none"), schema, str(tmp_path / "state"), 5, 0)
    assert run_batches(spark, landing, lambda *_: None) == [] and batch_log(spark, landing).count() == 0
    for bad in ((0, 1), (1, -1)):
        with pytest.raises(SpecError):
            Landing("p", schema, "s", *bad)
