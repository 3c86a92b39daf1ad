"""Limits over streams: several rates, both kinds, state that goes, admission with two limits."""

import random
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weirflow import AdmissionSpec, Endpoint, RateLimit
from weirflow.operators.admit import admit_requests
from weirflow.operators.keyed_limit import Limiter, decide_window
from weirflow.operators.limit import NANOS, rate_limit, rate_limit_window
from weirflow.plans import inputs
from weirflow.sinks import write_batch
from weirflow.sources import from_http_requests
from weirflow.specs import SpecError
from weirflow.streaming import rate_limit_stream, read_stream, run_stream, window_limit_stream


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Every partition of keyed state costs a worker in every micro-batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def drain(df, tmp_path, name):
    out = str(tmp_path / name)
    run_stream(df, lambda rows, i: write_batch(rows, out, i), name, checkpoint=str(tmp_path / f"{name}-c")).awaitTermination()
    return df.sparkSession.read.parquet(out).drop("batch_id")


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def land(df, path, order, pieces=3):
    """The rows as files in the order of time."""
    n = df.count()
    placed = df.withColumn("_at", F.row_number().over(Window.orderBy(*order)))
    for k in range(pieces):
        placed.where((F.col("_at") > n * k // pieces) & (F.col("_at") <= n * (k + 1) // pieces)).drop("_at").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


@pytest.fixture(scope="module")
def landed(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "e")
    events = inputs.table(spark, sf, "events")
    land(events, path, ["ts", "event_id"])
    return path, events


def test_many_rates_in_one_stream(spark, landed, tmp_path):
    path, events = landed
    rate = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 3).otherwise(2)
    args = dict(key=["event_type"], ts="ts", id="event_id", rate=rate, burst=F.length("event_type") - 2, per_seconds=20_000)
    stream = drain(rate_limit_stream(read_stream(spark, path, events.schema, max_files=1), **args, keep=["props"]), tmp_path, "rates")
    batch = rate_limit(events, **args)
    assert rows(stream, "event_id", "allowed") == rows(batch, "event_id", "allowed")
    assert 0 < batch.where("allowed").count() < batch.count()
    assert "props" in stream.columns and stream.where("props IS NULL").count() == 0


def test_windows_of_a_stream(spark, landed, tmp_path):
    path, events = landed
    args = dict(key=["event_type"], ts="ts", id="event_id")
    stream = drain(window_limit_stream(read_stream(spark, path, events.schema, max_files=1), **args, rps=2, seconds=3600), tmp_path, "windows")
    batch = rate_limit_window(events, **args, rps=2, unit="hour")
    assert rows(stream, "event_id", "allowed") == rows(batch, "event_id", "allowed")
    assert 0 < batch.where("allowed").count() < batch.count()


def test_state_goes_when_it_has_no_effect(spark, tmp_path):
    """A thousand keys, one event each, and one that comes all the time: state stays for what is full of use."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 10)
    events = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, "all").otherwise(F.concat(F.lit("k"), "id")).alias("who"), at.alias("ts"))
    land(events, str(tmp_path / "e"), ["ts", "id"], 5)
    args = dict(key=["who"], ts="ts", id="id", rate=1, burst=2, per_seconds=30)
    stream = rate_limit_stream(read_stream(spark, str(tmp_path / "e"), events.schema, max_files=1), **args, late="1 minute")
    out = str(tmp_path / "out")
    query = run_stream(stream, lambda df, i: write_batch(df, out, i), "gone", checkpoint=str(tmp_path / "c"))
    query.awaitTermination()
    assert rows(spark.read.parquet(out), "id", "allowed") == rows(rate_limit(events, **args), "id", "allowed")
    left = query.recentProgress[-1].stateOperators[0].numRowsTotal
    assert left < 60  # one row of state a key, and one for its timer
    with pytest.raises(SpecError):
        rate_limit_stream(stream, ["allowed"], "ts", "id", 1, 1, ttl_seconds=5, late="1 minute")


def test_events_without_time_and_repeats(spark, tmp_path):
    data = [(1, "a", None), (2, "a", "2024-01-01 00:00:00"), (3, None, "2024-01-01 00:00:00"), (4, "a", "2024-01-01 00:00:00"), (5, "a", None)]
    events = spark.createDataFrame(data, "id bigint, who string, at string").select("id", "who", F.to_timestamp("at").alias("ts"))
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = rate_limit_stream(read_stream(spark, str(tmp_path / "e"), events.schema), ["who"], "ts", "id", 1, 1)
    got = {r.id: r.allowed for r in drain(stream, tmp_path, "odd").collect()}
    assert got == {1: None, 2: True, 3: True, 4: False, 5: None}


def test_window_state():
    times = np.array([5, 6, 12, 13, 13, 13, 27]) * NANOS
    at, used, allowed = decide_window(-(2**62), 0, times, 10 * NANOS, 2)
    assert allowed.tolist() == [True, True, True, True, False, False, True] and (at, used) == (2, 1)
    at, used, allowed = decide_window(2, 1, np.array([3, 21, 22, 30]) * NANOS, 10 * NANOS, 2)
    assert allowed.tolist() == [True, False, False, True] and (at, used) == (3, 1)


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Handle:
    def __init__(self):
        self.state = _Value()

    def getValueState(self, *_):
        return self.state


def test_a_million_rows_of_one_key():
    """A hot key's micro-batch leaves in slices and takes some 100 bytes an event."""
    n = 1_000_000
    rng = np.random.default_rng(3)
    times = rng.permutation(n).astype(np.int64) * 1000
    limiter = Limiter("bucket", "id", ["id"], None, False)
    limiter.init(_Handle())

    def chunks():
        for a in range(0, n, 10_000):
            yield pd.DataFrame(
                {"t": times[a : a + 10_000], "skip": False, "period": 5000, "tokens": 3, "id": np.arange(a, a + 10_000)}
            )

    tracemalloc.start()
    seen, allowed, largest = 0, 0, 0
    for part in limiter.handleInputRows(("k",), chunks(), None):
        seen, allowed, largest = seen + len(part), allowed + int(part["allowed"].sum()), max(largest, len(part))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and largest <= 10_000 and peak < 120 * n
    assert allowed == pytest.approx(n / 5 + 2, abs=2)


# -- admission -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def requests(spark, tmp_path_factory):
    rng = random.Random(4)
    data, at = [], 1_700_000_000_000_000
    for i in range(600):
        at += rng.randrange(0, 120_000)
        headers = {"X-Forwarded-For": f"10.0.0.{rng.randrange(6)}"} if rng.random() < 0.9 else {"Host": "h"}
        if rng.random() < 0.95:
            headers["X-API-Key"] = "s3cret" if rng.random() < 0.95 else "no"
        path = rng.choice(["/in/a", "/in/a", "/in/b", "/in/c", "/out"])
        body = b"x" * rng.choice([2, 5, 40])
        data.append((i, path, headers, body, None if rng.random() < 0.01 else at))
    df = spark.createDataFrame(data, "request_id bigint, path string, headers map<string,string>, body binary, us bigint")
    df = df.withColumn("received_at", F.timestamp_micros("us")).drop("us")
    path = str(tmp_path_factory.mktemp("requests") / "r")
    land(df, path, [F.col("received_at").asc_nulls_first(), "request_id"])
    return path, spark.read.parquet(path)


def spec(limiter, same=False):
    b = RateLimit(8, 3, per_ip=True, per_ip_rps=2)
    return AdmissionSpec(
        [
            Endpoint("/in/a", "/t/a", rate_limit=b if same else RateLimit(9, 5, per_ip=True, per_ip_rps=3)),
            Endpoint("/in/b", "/t/b", rate_limit=b),
            Endpoint("/in/c", "/t/c"),
        ],
        auth="apikey",
        header="X-API-Key",
        secret="s3cret",
        max_body_size=30,
        limiter=limiter,
    )


@pytest.mark.parametrize("limiter,same", [("bucket", False), ("window", True)])
def test_admission_of_a_stream(spark, requests, tmp_path, limiter, same):
    path, table = requests
    want = admit_requests(table, spec(limiter, same))
    stream = admit_requests(read_stream(spark, path, table.schema, max_files=1), spec(limiter, same))
    assert stream.columns == want.columns
    got = drain(stream, tmp_path, "admitted")
    assert rows(got, "request_id", "path", "body", "to", "status", "error") == rows(want, "request_id", "path", "body", "to", "status", "error")
    errors = {(r.error or "").split(":")[0] for r in want.select("error").distinct().collect()}
    assert {"Rate limit exceeded for endpoint", "Rate limit exceeded for IP", "Request time is missing", "Endpoint not found"} <= errors
    assert rows(got, "request_id", F.to_json("headers")) == rows(table, "request_id", F.to_json("headers"))


def test_messages_of_a_stream_and_replay(spark, requests, tmp_path):
    """A batch that fails after its limits were used up gives the same verdicts when it is run again."""
    path, table = requests
    want = from_http_requests(table, spec("bucket"), keep=["request_id"])
    stream = from_http_requests(read_stream(spark, path, table.schema, max_files=1), spec("bucket"), keep=["request_id"])
    out, tries = str(tmp_path / "out"), []

    def sink(df, n):
        write_batch(df, out, n)
        tries.append(n)
        if len(tries) in (2, 4):
            raise OSError("away")

    from weirflow.streaming import run_with_retries

    run_with_retries(lambda: run_stream(stream, sink, "replay", checkpoint=str(tmp_path / "c")), backoff_seconds=0.01)
    assert tries == [0, 1, 1, 2, 2]
    got = spark.read.parquet(out)
    for columns in (["request_id", "topic", "publish_time_us"], ["request_id", F.col("payload").cast("string")]):
        assert rows(got, *columns) == rows(want, *columns)
    assert 0 < want.count() < table.count()
