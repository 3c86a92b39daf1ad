import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import column, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow import CollectionSpec, FieldMapping, Route, SpecError
from weirflow.functions.ids import parse_u64, point_id, record_id, rfc3339
from weirflow.functions.variants import strict_json
from weirflow.operators import enrich
from weirflow.operators.documents import time_range, to_documents
from weirflow.operators.points import check_dimension, parse_vector_message, to_points
from weirflow.operators.project import bad_rows, declared_schema, enforce, enforce_not_null, good_rows, project_fields
from weirflow.sources import as_envelope, from_device_publishes, read_jsonl, union_envelopes

M = FieldMapping


def test_projection(texts):
    df = texts('{"hull":{"name":"Ran","masts":3},"port":"Bergen"}')
    got = project_fields(df, [M("port", "port", "Utf8"), M("hull.name", "ship", "Utf8", False)])
    assert got.first().asDict() == {"port": "Bergen", "ship": "Ran", "_errors": []}


def test_deep_projection(texts):
    df = texts('{"trip":{"leg":{"knots":11.5,"stop":{"port":"Riga"}},"no":"t-9"},"tide":{"cm":-4}}')
    fields = [
        M("tide.cm", "tide", "Int16", False),
        M("trip.leg.stop.port", "port", "Utf8"),
        M("trip.leg.knots", "knots", "Float64", False),
        M("trip.leg.stop.quay", "quay", "Utf8"),
    ]
    assert tuple(project_fields(df, fields).first())[:4] == (-4, "Riga", 11.5, None)


TYPED = [
    ("Utf8", '"x"', "x"),
    ("Utf8", "5", None),
    ("Int8", "127", 127),
    ("Int8", "128", None),
    ("Int32", "1.9", None),
    ("Int32", "1.0", 1),
    ("Int32", "1e2", 100),
    ("Int32", '"42"', 42),
    ("Int32", '"4x"', None),
    ("Int32", '"' + "0" * 60 + '42"', 42),
    ("Int32", '"-007"', -7),
    ("Int32", "true", None),
    ("Int64", "9223372036854775807", 9223372036854775807),
    ("Int64", "9223372036854775808", None),
    ("Int64", '"-9223372036854775808"', -9223372036854775808),
    ("UInt8", "255", 255),
    ("UInt8", "-1", None),
    ("UInt32", "4294967295", 4294967295),
    ("UInt64", "18446744073709551615", Decimal("18446744073709551615")),
    ("Float64", "5", 5.0),
    ("Float64", '"2.5"', 2.5),
    ("Float64", "true", None),
    ("Float64", '"abc"', None),
    ("Float32", "0.5", 0.5),
    ("Boolean", "true", True),
    ("Boolean", "1", None),
    ("Timestamp", '"2024-01-02T03:04:05Z"', datetime(2024, 1, 2, 3, 4, 5)),
    ("Timestamp", '"2024-01-02T03:04:05.123456+01:00"', datetime(2024, 1, 2, 2, 4, 5, 123456)),
    ("Timestamp", "1704164645000000", datetime(2024, 1, 2, 3, 4, 5)),
    ("Timestamp", '"soon"', None),
    ("Timestamp", "1.5", None),
    ("Date32", '"2024-02-29"', date(2024, 2, 29)),
    ("Date32", '"2023-02-29"', None),
    ("Binary", '"00ff"', bytearray(b"\x00\xff")),
    ("Binary", '"0"', None),
    ("Utf8", "{}", None),
    ("Int64", "[1]", None),
]


def test_typed_values(spark):
    for kind in dict.fromkeys(k for k, _, _ in TYPED):
        cases = [(v, want) for k, v, want in TYPED if k == kind]
        df = spark.createDataFrame([(f'{{"x":{v}}}',) for v, _ in cases], "payload string")
        got = project_fields(df, [M("x", "x", kind)], keep=["payload"]).collect()
        for row, (v, want) in zip(got, cases, strict=True):
            assert row.x == want, (kind, v, row)
            assert (row["_errors"] == []) == (want is not None), (kind, v, row)


def test_required_and_rules(texts):
    df = texts('{"a":"x"}', '{"a":null}', "{}", "not json", '{"a":1}')
    checked = project_fields(df, [M("a", "a", "Utf8", False)], keep=["payload"])
    reasons = {r.payload: r["_errors"] for r in checked.collect()}
    assert reasons == {
        '{"a":"x"}': [],
        '{"a":null}': ["a: required"],
        "{}": ["a: required"],
        "not json": ["message: not JSON"],
        '{"a":1}': ["a: not Utf8"],
    }
    assert good_rows(checked).count() == 1 and bad_rows(checked).count() == 4
    assert enforce(checked, "drop").count() == 1
    with pytest.raises(Exception, match="(a|message): "):
        enforce(checked, "fail").collect()
    with pytest.raises(SpecError):
        enforce(checked, "ignore")
    typed = df.sparkSession.createDataFrame([("x",), (None,)], "a string")
    assert enforce_not_null(typed, [M("a", "a", "Utf8", False)], "drop").count() == 1


def test_payloads_that_are_no_object(texts):
    df = texts("oops", "[1]", "7", None, ' {"a":1}', '{"a":1} x', '"{"')
    checked = project_fields(df, [M("a", "a", "Int64")], keep=["payload"])
    got = {r.payload: (r.a, r["_errors"]) for r in checked.collect()}
    bad, other = ["message: not JSON"], ["message: not an object"]
    assert got == {
        "oops": (None, bad), "[1]": (None, other), "7": (None, other), None: (None, bad), ' {"a":1}': (1, []),
        '{"a":1} x': (None, bad), '"{"': (None, other),
    }
    assert good_rows(checked).count() == 1
    parsed = df.select("payload", F.try_parse_json("payload").alias("v")).where("payload in ('[1]', '7')")
    assert [r["_errors"] for r in project_fields(parsed, [M("a", "a", "Int64")], "v").collect()] == [other, other]


def test_projection_is_one_native_stage(texts):
    plan = plan_of(project_fields(texts("{}"), [M("a.b", "b", "Int64"), M("c", "c", "Utf8")]))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Exchange" not in physical and "Python" not in physical
    assert sum("parseJson(" in line for line in physical.splitlines()) == 1


def test_declared_schema():
    got = declared_schema([M("a", "a", "UInt16", False), M("b", "b", "Date64")], "_msg_meta")
    assert got == T.StructType(
        [
            T.StructField("a", T.IntegerType(), False),
            T.StructField("b", T.DateType(), True),
            T.StructField("_msg_meta", T.StringType(), False),
        ]
    )


def test_ids(spark):
    cases = {
        "7": 7,
        "007": 7,
        "+7": 7,
        "18446744073709551615": 2**64 - 1,
        "0": 0,
        "0" * 60 + "9": 9,
        "18446744073709551616": None,
        "-7": None,
        " 7": None,
        "+": None,
        "": None,
        "7\n": None,
    }
    df = spark.createDataFrame([(x,) for x in cases], "s string")
    got = {r.s: r.n for r in df.select("s", parse_u64(F.col("s")).alias("n")).collect()}
    assert got == cases
    import hashlib

    df = spark.createDataFrame([("buoy/north",), ("buoy/south",), ("7",), (None,)], "s string")
    a, b, c, d = column(df, point_id(F.col("s"), F.lit("/t/x"), F.lit(5)))
    assert [a, b] == [int.from_bytes(hashlib.sha256(x).digest()[:8], "big") for x in (b"buoy/north", b"buoy/south")]
    assert c == 7 and d == int.from_bytes(hashlib.sha256(b"/t/x:5").digest()[:8], "big")


def test_record_id_and_times(spark):
    df = spark.createDataFrame([({"record_id": "r1"},), ({},), (None,)], "a map<string,string>")
    assert column(df, record_id(F.col("a"), "events")) == ["events:r1", None, None]
    times = {
        0: "1970-01-01T00:00:00+00:00",
        1704164645000000: "2024-01-02T03:04:05+00:00",
        1704164645120000: "2024-01-02T03:04:05.120+00:00",
        1704164645120001: "2024-01-02T03:04:05.120001+00:00",
    }
    df = spark.createDataFrame([(x,) for x in times], "us bigint")
    assert column(df, rfc3339(F.col("us"))) == list(times.values())


@pytest.fixture
def message(spark):
    def make(payload, attributes=None):
        return spark.createDataFrame(
            [("/ns/t", payload, 1704164645000000, "p1", attributes)],
            "topic string, payload string, publish_time_us bigint, producer string, attributes map<string,string>",
        )

    return make


def test_vector_messages(spark, message):
    cases = {
        '{"id":"m-8","vector":[0.1,0.2],"payload":{"text":"t"}}': [],
        '{"vector":[0.1,2]}': [],
        '{"id":null,"vector":[]}': [],
        '{"id":5,"vector":[1]}': ["id: not a string"],
        '{"id":"a"}': ["vector: not an array of numbers"],
        '{"vector":[1,null]}': ["vector: not an array of numbers"],
        '{"vector":[1,"2"]}': ["vector: not an array of numbers"],
        '{"vector":["1","2"]}': ["vector: not an array of numbers"],
        '{"vector":[true]}': ["vector: not an array of numbers"],
        "[1]": ["message: not an object", "vector: not an array of numbers"],
        "oops": ["message: not an object", "vector: not an array of numbers"],
    }
    for text, errors in cases.items():
        assert parse_vector_message(message(text)).first()["_errors"] == errors, text
    row = parse_vector_message(message('{"id":"m-8","vector":[0.5,2],"payload":{"text":"t"}}')).first()
    assert (row.msg_id, row.vector) == ("m-8", [0.5, 2.0])
    df = spark.createDataFrame([([1.0] * 3,)], "vector array<float>")
    assert check_dimension(df, 4).first()["_errors"] == ["Vector dimension mismatch: expected 4, got 3"]
    assert check_dimension(df, 3).first()["_errors"] == []


def test_points(message):
    text = '{"id":"42","vector":[1,2],"payload":{"a":{"b":1},"_msg_topic":"mine"}}'
    got = to_points(message(text, {"k": "v"}), CollectionSpec("c", 2))
    row = got.select("id", "vector", F.to_json("payload_fields").alias("p"), "_errors").first()
    assert row.id == 42 and row.vector == [1.0, 2.0] and row["_errors"] == []
    assert json.loads(row.p) == {
        "a.b": 1,
        "_msg_topic": "/ns/t",
        "_msg_timestamp": 1704164645000000,
        "_msg_producer": "p1",
        "_msg_attr_k": "v",
    }
    bare = to_points(message('{"vector":[1,2]}'), CollectionSpec("c", 2, include_metadata=False))
    assert bare.select(F.size("payload_fields")).first()[0] == 0
    bad = to_points(message('{"vector":[1,2]}'), CollectionSpec("c", 384))
    assert bad.first()["_errors"] == ["Vector dimension mismatch: expected 384, got 2"]
    physical = plan_of(got)
    physical = physical[physical.index("== Physical Plan ==") :]
    assert "Exchange" not in physical and "Python" not in physical


def test_one_deep_point_keeps_the_others(message):
    deep = '{"vector":[1,2],"payload":' + '{"a":' * 40 + "1" + "}" * 41
    rows = message('{"vector":[1,2],"payload":{"b":2}}').unionByName(message(deep))
    got = to_points(rows, CollectionSpec("c", 2, include_metadata=False)).select(F.to_json("payload_fields")).collect()
    assert sorted(r[0] for r in got) == sorted(['{"b":2}', '{"' + ".".join("a" * 40) + '":1}'])


def test_documents(message):
    text = '{"buoy":"north","celsius":8.25}'
    plain = to_documents(message(text), "readings", include_metadata=False).first()
    assert plain.id is None and json.loads(plain.doc) == json.loads(text)
    row = to_documents(message(text, {"record_id": "r9"}), "readings", "time_series").first()
    assert row.id == "readings:r9" and row.event_time == datetime(2024, 1, 2, 3, 4, 5)
    assert json.loads(row.doc) == {
        "buoy": "north",
        "celsius": 8.25,
        "_timestamp": "2024-01-02T03:04:05+00:00",
        "_msg_meta": {"topic": "/ns/t", "timestamp": "2024-01-02T03:04:05+00:00", "producer": "p1"},
    }
    # Only objects take members.
    assert to_documents(message("[1,2]"), "t", "time_series").first().doc == "[1,2]"


def test_metadata_json(message):
    df = enrich.add_metadata_json(message("{}"), processed_at=F.timestamp_micros(F.lit(1)))
    assert df.first()["_msg_meta"] == (
        '{"timestamp":1704164645000000,"timestamp_iso":"1970-01-01T00:00:00.000001+00:00","topic":"/ns/t"}'
    )
    now = enrich.add_metadata_json(message("{}")).first()["_msg_meta"]
    assert json.loads(now)["timestamp_iso"] > "2020"


def test_time_range(spark):
    df = spark.range(10).select(F.timestamp_seconds(F.col("id")).alias("event_time"))
    assert time_range(df, "1970-01-01 00:00:02", "1970-01-01 00:00:05").count() == 3


def test_device_source(spark):
    df = spark.createDataFrame(
        [
            ("sensors/t/zone1", bytearray(b'{"v":1}'), 1, False, True, datetime(2024, 1, 2)),
            ("sensors/t/zone1", bytearray(b"raw"), 0, True, False, datetime(2024, 1, 2)),
            ("other", bytearray(b"{}"), 0, False, False, datetime(2024, 1, 2)),
        ],
        "mqtt_topic string, payload binary, qos int, retain boolean, dup boolean, received_at timestamp",
    )
    routes = [Route("sensors/+/zone1", "/iot/one"), Route("sensors/#", "/iot/all")]
    a, b = from_device_publishes(df, routes).collect()
    assert (a.topic, a.key, a.payload) == ("/iot/one", "sensors/t/zone1", '{"v":1}')
    assert a.attributes == {
        "mqtt.topic": "sensors/t/zone1",
        "mqtt.qos": "1",
        "mqtt.retain": "false",
        "mqtt.dup": "true",
        "source": "mqtt",
    }
    assert json.loads(b.payload)["encoding"] == "base64"
    bare = from_device_publishes(df, routes, include_metadata=False).first()
    assert bare.key is None and bare.attributes == {}
    assert from_device_publishes(df, routes, on_unrouted="drop").count() == 2
    with pytest.raises(Exception, match="No route"):
        from_device_publishes(df, routes, on_unrouted="fail").collect()


def test_jsonl_and_union(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"id":"a"}\n\n   \n{"id":"b"}\n')
    df = read_jsonl(spark, str(tmp_path))
    assert sorted(r.payload for r in df.collect()) == ['{"id":"a"}', '{"id":"b"}']
    env = as_envelope(df, topic=F.lit("/a/b"), payload=F.col("payload"), publish_time_us=F.lit(1))
    assert union_envelopes(env, env, env).count() == 6
    assert strict_json(F.col("payload")) is not None
