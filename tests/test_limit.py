import random
from datetime import datetime, timedelta

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from weirflow import AdmissionSpec, Endpoint, RateLimit, SpecError
from weirflow.functions.headers import canonical_ip, client_ip, is_ip, normalize_headers
from weirflow.operators import limit
from weirflow.operators.admit import admit_requests, check_body_size, flag_content_type
from weirflow.operators.limit import BucketMap, _cut_by_count, decide, rate_limit, rate_limit_window
from weirflow.sources import from_http_requests

START = datetime(2024, 1, 1)


def test_bucket_map_equals_running_the_bucket():
    """The pieces of a run of events give the outgoing tat for any incoming one."""
    rng = random.Random(11)
    for _ in range(300):
        period, burst, start = rng.randint(1, 9), rng.randint(1, 5), 1000
        t, times = start, []
        for _ in range(rng.randint(0, 40)):
            t += rng.choice([0, 0, 1, 1, 2, period, period * burst, 3 * period * burst])
            times.append(t)
        bucket = BucketMap(start, period, burst)
        bucket.feed(times)
        assert len(bucket.pieces) <= 3 * burst + 2
        for tat in range(start - 5, start + burst * period + 1):
            want, _ = decide(max(tat, start), times, period, burst)
            assert bucket.apply(tat) == want


def one_pass(events, period_us, burst):
    """(key, t_us, id) in order -> allowed ids."""
    tat, allowed = {}, set()
    for key, t, i in sorted(events, key=lambda e: (e[1], e[2])):
        x = tat.get(key, -(10**18))
        if x - t <= (burst - 1) * period_us:
            tat[key] = max(x, t) + period_us
            allowed.add(i)
    return allowed


@pytest.fixture(scope="module")
def events(spark):
    """One key holds most events; pauses, bursts and equal times occur."""
    rng = random.Random(5)
    rows, t = [], 0
    for i in range(6000):
        t += rng.choice([0, 0, 40_000, 90_000, 200_000] + ([9_000_000] if i % 500 == 0 else []))
        key = "hot" if rng.random() < 0.7 else f"k{rng.randint(0, 9)}"
        rows.append((key, t, i))
    df = spark.createDataFrame(
        [(k, START + timedelta(microseconds=t), i) for k, t, i in rows],
        "key string, ts timestamp, id bigint",
    ).repartition(6)
    return rows, df


@pytest.mark.parametrize("rate,burst,chunk", [(5, 3, 7), (5, 3, 3600), (2, 10, 60), (50, 1, 1)])
def test_bucket_equals_one_pass(events, rate, burst, chunk):
    rows, df = events
    got = rate_limit(df, ["key"], "ts", "id", rate, burst, keep=["key"], chunk_seconds=chunk).collect()
    assert sorted(r.id for r in got) == list(range(len(rows)))
    assert {r.id for r in got if r.allowed} == one_pass(rows, 1_000_000 // rate, burst)


def test_bucket_cuts_time_and_rate_columns(events):
    rows, df = events
    rated = df.withColumn("rate", F.when(F.col("key") == "hot", 2).otherwise(10))
    got = rate_limit(rated, ["key"], "ts", "id", F.col("rate"), 4, chunk_seconds=30)
    allowed = {r.id for r in got.collect() if r.allowed}
    hot = [e for e in rows if e[0] == "hot"]
    cold = [e for e in rows if e[0] != "hot"]
    assert allowed == one_pass(hot, 500_000, 4) | one_pass(cold, 100_000, 4)
    plan = plan_of(got)
    assert "hashpartitioning(_key" in plan and "_chunk" in plan


def test_burst_then_refill(spark):
    times = [0, 0, 0, 0, 1_000_000, 1_000_000, 9_000_000]
    df = spark.createDataFrame(
        [(START + timedelta(microseconds=t), i) for i, t in enumerate(times)], "ts timestamp, id bigint"
    ).withColumn("key", F.lit("k"))
    got = {r.id: r.allowed for r in rate_limit(df, ["key"], "ts", "id", 1, 3).collect()}
    assert [got[i] for i in range(7)] == [True, True, True, False, True, False, True]


def test_events_without_a_time(spark):
    df = spark.createDataFrame([(1, START), (2, None), (3, START), (4, None)], "id bigint, ts timestamp").withColumn("key", F.lit("k"))
    for got in (rate_limit(df, ["key"], "ts", "id", 1, 1), rate_limit_window(df, ["key"], "ts", "id", 1)):
        assert {r.id: r.allowed for r in got.collect()} == {1: True, 2: None, 3: False, 4: None}


def test_rates_below_one(spark):
    df = spark.createDataFrame([(1, START, 0)], "id bigint, ts timestamp, rate int")
    for rate, burst in ((0, 1), (1, 0), (-1, 1)):
        with pytest.raises(SpecError):
            rate_limit(df, ["id"], "ts", "id", rate, burst)
    with pytest.raises(Exception, match="at least 1"):
        rate_limit(df, ["id"], "ts", "id", F.col("rate"), 1).collect()
    with pytest.raises(SpecError):
        rate_limit_window(df, ["id"], "ts", "id", 0)


def test_events_are_shuffled_once(events):
    """Both passes over the events read one exchange by (key, chunk)."""
    _, df = events
    got = rate_limit(df, ["key"], "ts", "id", 5, 3, keep=["key"], timeless=False)
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange [_key" in final
    assert final.count("REPARTITION_BY_COL") <= 3  # events, their reuse, and one row for each chunk


def test_many_pieces_on_arrays():
    rng = random.Random(12)
    times = sorted(1000 + rng.randint(0, 400) for _ in range(300))
    bucket = BucketMap(1000, 7, 60)
    for n, t in enumerate(times):
        bucket._step_many(t) if n % 2 else bucket._step(t)
    for tat in range(990, 1000 + 60 * 7 + 1):
        assert bucket.apply(tat) == decide(max(tat, 1000), times, 7, 60)[0]


def test_window(events):
    rows, df = events
    got = {r.id: r.allowed for r in rate_limit_window(df, ["key"], "ts", "id", 3).collect()}
    groups = {}
    for key, t, i in rows:
        groups.setdefault((key, t // 1_000_000), []).append((t, i))
    want = {i for g in groups.values() for _, i in sorted(g)[:3]}
    assert {i for i, ok in got.items() if ok} == want and len(got) == len(rows)
    assert "WindowGroupLimit" in plan_of(rate_limit_window(df, ["key"], "ts", "id", 3))


IPS = {
    "192.168.1.1": True,
    "256.1.1.1": False,
    "1.2.3": False,
    "01.2.3.4": False,
    "::": True,
    "::1": True,
    "1::": True,
    "1:2:3:4:5:6:7:8": True,
    "1:2:3:4:5:6:7::": True,
    "1:2:3:4:5:6:7:8:9": False,
    "1:2:3:4:5:6:7": False,
    "1::2::3": False,
    "::ffff:10.0.0.1": True,
    "1:2:3:4:5:6:10.0.0.1": True,
    "1:2:3:4:5:6:7:10.0.0.1": False,
    "::1:2:3:4:5:6:7": True,
    "::1:2:3:4:5:6:7:8": False,
    "fe80::1%eth0": False,
    "12345::": False,
    "": False,
    "host": False,
}


def test_ip_addresses(spark):
    import ipaddress

    df = spark.createDataFrame([(x,) for x in IPS], "s string")
    assert dict(df.select("s", is_ip(F.col("s"))).collect()) == IPS
    for text, ok in IPS.items():
        if "%" in text:
            continue
        try:
            ipaddress.ip_address(text)
            assert ok, text
        except ValueError:
            assert not ok, text


def test_headers_and_client_ip(spark):
    df = spark.createDataFrame(
        [
            ({"X-Forwarded-For": "192.168.1.1, 10.0.0.1"},),
            ({"x-real-ip": "192.168.1.2"},),
            ({"x-forwarded-for": "unknown", "X-Real-IP": "10.0.0.9"},),
            ({"x-forwarded-for": "badé", "a": None},),
            ({},),
        ],
        "headers map<string,string>",
    )
    h = normalize_headers(F.col("headers"))
    assert [r[0] for r in df.select(client_ip(h)).collect()] == ["192.168.1.1", "192.168.1.2", "unknown", None, None]
    assert [r[0] for r in df.select(client_ip(h, strict=True)).collect()] == [
        "192.168.1.1",
        "192.168.1.2",
        "10.0.0.9",
        None,
        None,
    ]
    two = spark.sql("select map('A','1','a','2') headers")
    assert two.select(normalize_headers(F.col("headers"))).first()[0] == {"a": "2"}


def requests(spark, rows):
    return spark.createDataFrame(
        [(i, p, h, bytearray(b), START + timedelta(seconds=s)) for i, (p, h, b, s) in enumerate(rows)],
        "request_id bigint, path string, headers map<string,string>, body binary, received_at timestamp",
    )


KEY = {"X-Api-Key": "s3cret"}


def test_admission(spark):
    spec = AdmissionSpec(
        [Endpoint("/webhooks/pay", "/in/pay", rate_limit=RateLimit(1, 2)), Endpoint("/webhooks/free", "/in/free")],
        auth="apikey",
        secret="s3cret",
        max_body_size=4,
        source_name="gate",
    )
    rows = [
        ("/webhooks/pay", KEY, b"{}", 0),
        ("/webhooks/pay", {"x-api-key": "wrong"}, b"{}", 0),
        ("/webhooks/pay", {}, b"{}", 0),
        ("/webhooks/none", KEY, b"{}", 0),
        ("/webhooks/free", KEY, b"12345", 0),
        ("/webhooks/free", KEY, b"1234", 0),
        ("/webhooks/pay", KEY, b"{}", 0),
        ("/webhooks/pay", KEY, b"12345", 0),
        ("/webhooks/pay", KEY, b"{}", 1),
    ]
    df = requests(spark, rows)
    for limiter, third in (("bucket", 429), ("window", 200)):
        this = AdmissionSpec(**{**{k: getattr(spec, k) for k in ("endpoints", "auth", "secret", "max_body_size")}, "limiter": limiter})
        got = {r.request_id: (r.status, r.error) for r in admit_requests(df, this).collect()}
        assert len(got) == len(rows)
        assert got[0] == (200, None)
        assert got[1] == (401, "Invalid API key") and got[2] == (401, "Missing x-api-key header")
        assert got[3] == (404, "Endpoint not found: /webhooks/none")
        assert got[4] == (413, "Payload size 5 exceeds maximum 4") and got[5] == (200, None)
        if limiter == "bucket":
            assert got[6] == (200, None) and got[7][0] == third and got[8] == (200, None)
            assert got[7][1] == "Rate limit exceeded for endpoint: /webhooks/pay"
        else:  # one request per second
            assert got[6][0] == 429 and got[8] == (200, None)
    no_secret = AdmissionSpec(spec.endpoints, auth="apikey")
    assert {r.status for r in admit_requests(df, no_secret).collect()} == {500}
    messages = from_http_requests(df, spec, keep=["request_id"]).collect()
    assert {m.request_id for m in messages} == {0, 5, 6, 8}
    assert messages[0].producer == "gate"


def test_per_address_limit(spark):
    spec = AdmissionSpec([Endpoint("/a", "/in/a")], rate_limit=RateLimit(100, 2, per_ip=True, per_ip_rps=1))
    ip = {"x-forwarded-for": "10.0.0.1"}
    rows = [("/a", ip, b"", s) for s in (0, 0)] + [("/a", {"x-real-ip": "10.0.0.2"}, b"", 0)]
    rows += [("/a", ip, b"", 0), ("/a", {}, b"", 0), ("/a", ip, b"", 1), ("/a", ip, b"", 1)]
    df = requests(spark, rows)
    # The endpoint's own burst of 2 lets ids 0 and 1 in at second 0.
    got = {r.request_id: r.error for r in admit_requests(df, spec).collect()}
    assert [i for i, e in got.items() if e is None] and got[6] == "Rate limit exceeded for IP: 10.0.0.1"
    assert got[2] == got[3] == got[4] == "Rate limit exceeded for endpoint: /a"
    assert got[0] is None and got[1] is None and got[5] is None


def test_one_bucket_for_an_address(spark):
    """Over all endpoints, and however the address is spelt; the secret is not in the plan."""
    spec = AdmissionSpec(
        [Endpoint("/a", "/in/a"), Endpoint("/b", "/in/b", rate_limit=RateLimit(50, 2, per_ip=True, per_ip_rps=1))],
        rate_limit=RateLimit(50, 3, per_ip=True, per_ip_rps=1), auth="apikey", secret="open sesame",
    )
    names = ["2001:DB8::1", "2001:db8:0:0:0:0:0:1", "2001:0db8::0001", "2001:db8::0:1", "2001:db8::2"]
    rows = [("/ab"[0] + "ab"[i % 2], {"x-real-ip": ip, "X-Api-Key": "open sesame"}, b"", 0) for i, ip in enumerate(names)]
    judged = admit_requests(requests(spark, rows), spec)
    assert "sesame" not in plan_of(judged)
    assert [r.status for r in judged.orderBy("request_id").collect()] == [200, 200, 200, 429, 200]
    no_time = requests(spark, rows).withColumn("received_at", F.lit(None).cast("timestamp"))
    assert {(r.status, r.error) for r in admit_requests(no_time, spec).collect()} == {(429, "Request time is missing")}


def test_canonical_addresses(spark):
    import ipaddress

    texts = ["10.0.0.1", "::", "::1", "1::", "A:0b::00c", "1:2:3:4:5:6:7:8", "::ffff:10.0.0.1", "1:2:3:4:5:6:1.2.3.4", "fe80::0:0:9"]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    for text, got in df.select("s", canonical_ip(F.col("s"))).collect():
        assert ipaddress.ip_address(got) == ipaddress.ip_address(text) and (":" not in got or got.count(":") == 7)


def test_attributes_and_flags(spark):
    spec = AdmissionSpec([Endpoint("/a", "/in/a")], source_name="gate")
    df = requests(
        spark,
        [("/a", {"User-Agent": "curl", "Content-Type": "text/plain", "x-real-ip": "1.1.1.1"}, b"x", 0), ("/a", {}, b"1", 0)],
    )
    a, b = sorted(from_http_requests(df, spec, keep=["request_id"]).collect(), key=lambda r: r.request_id)
    assert a.attributes == {
        "webhook.source": "gate",
        "webhook.endpoint": "/a",
        "webhook.timestamp": "2024-01-01T00:00:00+00:00",
        "webhook.ip": "1.1.1.1",
        "webhook.user_agent": "curl",
        "webhook.content_type": "text/plain",
    }
    assert sorted(b.attributes) == ["webhook.endpoint", "webhook.source", "webhook.timestamp"]
    assert b.payload == "1"
    h = normalize_headers(F.col("headers"))
    assert [r[0] for r in df.select(flag_content_type(h)).collect()] == [True, False]
    assert [r[0] for r in df.select(check_body_size(F.col("body"), 0)).collect()] == [True, True]


@pytest.mark.parametrize("chunk_events", [1, 37, 500, 10_000])
def test_chunks_by_count_equal_one_pass(events, chunk_events):
    rows, df = events
    got = rate_limit(df, ["key"], "ts", "id", 5, 3, chunk_events=chunk_events).collect()
    assert sorted(r.id for r in got) == list(range(len(rows)))
    assert {r.id for r in got if r.allowed} == one_pass(rows, 200_000, 3)


def test_a_hot_key_is_spread(spark):
    """One key with all events inside 300 seconds: chunks are of about equal size, wherever the events lie."""
    n = 40_000
    squeezed = F.timestamp_micros((F.pow(F.col("id") / n, 6) * 299_000_000).cast("bigint") + 1_700_000_000_000_000)
    df = spark.range(n).select("id", F.lit("hot").alias("key"), squeezed.alias("ts"))
    events = df.select(F.col("key").alias("_key"), (F.unix_micros("ts") * 1000).alias("_t"), "id")
    cut = _cut_by_count(events, 500)
    sizes = sorted(r.n for r in cut.groupBy("_chunk").agg(F.count("*").alias("n")).collect())
    # Early events share their microseconds, so the first chunks are larger.
    assert len(sizes) > 60 and sizes[len(sizes) // 2] < 700
    spread = df.withColumn("ts", F.timestamp_micros(F.col("id") * 7000 + 1_700_000_000_000_000))
    events = spread.select(F.col("key").alias("_key"), (F.unix_micros("ts") * 1000).alias("_t"), "id")
    tasks = [r.n for r in _cut_by_count(events, 100).repartition(8, "_key", "_chunk").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(tasks) == 8 and max(tasks) < 3 * sorted(tasks)[4]
    quick = rate_limit(df, ["key"], "ts", "id", 50, 20, chunk_events=500)
    slow = rate_limit(df, ["key"], "ts", "id", 50, 20, chunk_events=10**9)
    assert quick.exceptAll(slow).count() == 0 and 0 < quick.where("allowed").count() < n


def test_cuts_are_found_by_halving(spark):
    """The chunk of an event is looked up in a few steps, however many cuts its key has."""
    cuts = sorted([3, 3, 3, 10, 11, 500] + [1_000 + 7 * i for i in range(300)])
    times = [0, 2, 3, 4, 10, 499, 500, 999, 1_000, 1_006, 1_007, 3_092, 3_093, 3_094, 9_999]
    df = spark.createDataFrame([(t, cuts[:n]) for t in times for n in (0, 1, 6, 305, 306)], "t bigint, cuts array<bigint>")
    got = df.select("t", F.size("cuts").alias("n"), limit._passed(F.col("cuts"), F.col("t"), len(cuts) + 1).alias("at")).collect()
    assert [r["at"] for r in got] == [sum(c <= r["t"] for c in cuts[: r["n"]]) for r in got]
    events = spark.range(2_000).select(F.lit("a").alias("_key"), F.col("id").alias("_t"))
    plan = limit._cut_by_count(events, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(_cuts" not in plan


def test_refused_events_take_no_steps(monkeypatch):
    """Many events at one time: only the first ones can change what a chunk does."""
    steps = []
    real = limit.BucketMap._step
    monkeypatch.setattr(limit.BucketMap, "_step", lambda self, t: (steps.append(t), real(self, t)))
    times = [t for t in range(0, 40) for _ in range(60)]
    period, burst = 100, 5
    some = limit.BucketMap(0, period, burst)
    some.feed(times)
    assert len(steps) < len(times) / 5
    for tat in range(0, burst * period + 1, 7):
        assert some.apply(tat) == limit.decide(tat, times, period, burst)[0]
