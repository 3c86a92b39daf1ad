import json

import pytest
from helpers import column, plan_of

from weirflow import SpecError, TopicSchema
from weirflow.operators import registry as reg
from weirflow.operators.routing import routes_frame
from weirflow.operators.validate import check_schema, validate_primitive, validate_split
from weirflow.specs import Route

PARCEL = {
    "type": "object",
    "additionalProperties": False,
    "required": ["parcel", "grams", "state"],
    "properties": {
        "grams": {"type": "integer", "minimum": 5, "maximum": 40_000},
        "parcel": {"type": "string"},
        "label": {"type": "string", "pattern": r"^[A-Z]{2}-[0-9]{4}$"},
        "state": {"enum": ["packed", "held", "lost", 404]},
        "route": {
            "type": "object",
            "properties": {"hops": {"type": "integer"}, "hub": {"type": "string"}},
            "required": ["hub"],
        },
        "sent": {"format": "date-time", "type": "string"},
        "scanner": {"format": "ipv4", "type": "string"},
        "contact": {"format": "email", "type": "string"},
        "carrier": {"const": "mule"},
        "weights": {"type": "array", "minItems": 2, "items": {"type": "number"}},
        "fragile": {"type": "boolean"},
    },
}
OK = {"parcel": "p-1", "grams": 250, "state": "held"}

CASES = [
    ({}, []),
    ({"grams": 5}, []),
    ({"grams": 4}, ["grams: below the minimum"]),
    ({"grams": 40_001}, ["grams: above the maximum"]),
    ({"grams": 10.25}, ["grams: type is not integer"]),
    ({"grams": 10.0}, []),
    ({"grams": "heavy"}, ["grams: type is not integer"]),
    ({"parcel": None}, ["parcel: type is not string"]),
    ({"parcel": [1]}, ["parcel: type is not string"]),
    ({"state": "gone"}, ["state: not an allowed value"]),
    ({"state": 404}, []),
    ({"sent": "2031-05-06T07:08:09+02:00"}, []),
    ({"sent": "2031-05-06"}, ["sent: not a valid date-time"]),
    ({"sent": "2031-02-30T07:08:09Z"}, ["sent: not a valid date-time"]),
    ({"route": {}}, ["route.hub: required"]),
    ({"route": {"hub": False, "hops": 0.5}}, ["route.hub: type is not string", "route.hops: type is not integer"]),
    ({"route": {"hub": "north", "hops": 3.0}}, []),
    ({"route": "north"}, ["route: type is not object"]),
    ({"label": "QX-0042"}, []),
    ({"label": "QX-42"}, ["label: does not match the pattern"]),
    ({"label": "QX-0042\n"}, ["label: does not match the pattern"]),
    ({"scanner": "172.16.300.1"}, ["scanner: not a valid ipv4"]),
    ({"scanner": "172.16.30.1"}, []),
    ({"contact": "desk@hub.example"}, []),
    ({"contact": "desk"}, ["contact: not a valid email"]),
    ({"carrier": "ox"}, ["carrier: not the constant value"]),
    ({"weights": [1]}, ["weights: fewer than 2 items"]),
    ({"weights": [1, "x"]}, ["weights: an item is not number"]),
    ({"weights": [1, None]}, ["weights: an item is not number"]),
    ({"fragile": 0}, ["fragile: type is not boolean"]),
    ({"colour": 1, "shape": 2}, ["message: unexpected colour, shape"]),
]


def test_keywords(texts):
    df = texts(*[json.dumps({**OK, **change}) for change, _ in CASES])
    got = column(check_schema(df, PARCEL), "_errors")
    for errors, (change, want) in zip(got, CASES, strict=True):
        assert sorted(errors) == sorted(want), change


def test_missing_and_not_objects(texts):
    df = texts('{"grams": 77}', "[]", "nope", "null")
    got = column(check_schema(df, PARCEL), "_errors")
    assert got == [
        ["parcel: required", "state: required"],
        ["message: type is not object"],
        ["message: not JSON"],
        ["message: type is not object"],
    ]


def test_formats_may_be_notes(texts):
    df = texts(json.dumps({**OK, "scanner": "x"}))
    assert column(check_schema(df, PARCEL, assert_format=False), "_errors") == [[]]


def test_split(texts):
    df = texts(json.dumps(OK), "{}")
    good, bad = validate_split(df, PARCEL)
    assert good.count() == 1 and bad.first()["_errors"]
    good, _ = validate_split(df, PARCEL, on_error="drop")
    assert good.count() == 1
    with pytest.raises(Exception, match="required"):
        validate_split(df, PARCEL, on_error="fail")[0].collect()
    plan = plan_of(check_schema(df, PARCEL))
    assert "Python" not in plan[plan.index("== Physical") :]


def test_large_whole_numbers(texts):
    """Above 2**53 neighbours are one double, but not one number."""
    df = texts("9007199254740992", "9007199254740993", "9007199254740993.5", "90071992547409930000000")
    for keyword, want in {
        "const": [False, True, False, False],
        "enum": [False, True, False, False],
        "minimum": [False, True, True, True],
        "maximum": [True, True, False, False],
    }.items():
        bound = 9007199254740993
        got = column(check_schema(df, {keyword: [bound] if keyword == "enum" else bound}), "_errors")
        assert [not e for e in got][: 2 if keyword == "maximum" else 4] == want[: 2 if keyword == "maximum" else 4], keyword


def test_unknown_keyword(texts):
    with pytest.raises(SpecError, match="oneOf"):
        check_schema(texts("{}"), {"oneOf": []})


def test_primitives(spark, texts):
    df = texts('"text"', "5", "{}", "oops")

    def ok(frame, kind):
        return [not e for e in column(validate_primitive(frame, kind), "_errors")]

    assert ok(df, "string") == [True, False, False, False]
    assert ok(df, "number") == [False, True, False, False]
    assert ok(df, None) == ok(df, "bytes") == [True] * 4
    raw = spark.createDataFrame([(b"plain",), (b"1.5",), (b"\xff",)], "payload binary")
    assert ok(raw, "string") == [True, True, False]
    assert ok(raw, "number") == [False, True, False]


def test_registry(spark):
    r = spark.createDataFrame(
        [("s", 1, "json_schema", "a"), ("s", 2, "json_schema", "b"), ("s", 3, "json_schema", "c"), ("t", 1, "string", "")],
        reg.REGISTRY,
    )

    def pick(strategy):
        return [x.version for x in reg.resolve_schema(r, "s", strategy).collect()]

    assert pick("latest") == [3] and pick({"pinned": 2}) == [2] and pick({"pinned": 9}) == []
    assert pick({"minimum": 2}) == [3] and pick({"minimum": 4}) == []
    with pytest.raises(SpecError):
        pick("newest")
    assert reg.register_schema(r, "s", "json_schema", "c").count() == 0
    assert reg.register_schema(r, "s", "json_schema", "a").first().version == 4
    assert reg.register_schema(r, "u", "string", "").first().version == 1
    offers = [("s", "json_schema", "x"), ("s", "json_schema", "d"), ("s", "json_schema", "x"), ("s", "json_schema", "c"), ("v", "string", "")]
    offered = spark.createDataFrame([(n, *o) for n, o in enumerate(offers)], "n int, subject string, schema_type string, schema_json string")
    in_order = reg.register_schemas(r, offered, ["n"]).orderBy("subject", "version").collect()
    assert [(x.subject, x.version, x.schema_json) for x in in_order] == [("s", 4, "x"), ("s", 5, "d"), ("v", 1, "")]
    by_text = reg.register_schemas(r, offered).orderBy("subject", "version").collect()
    assert [x.schema_json for x in by_text] == ["d", "x", ""]
    assert reg.register_schema(reg.empty_registry(spark), "u", "string", "").first().version == 1


def test_schemas_and_routes(spark):
    schemas = reg.schemas_frame(spark, [TopicSchema("/a/x", "one"), TopicSchema("/a/x", "two"), TopicSchema("/a/y", "y")])
    routes = routes_frame(spark, [Route("x", "/a/x"), Route("z", "/a/z")])
    assert [r.topic for r in reg.schemas_without_route(schemas, routes).collect()] == ["/a/y"]
    topics = routes.select("to").withColumnRenamed("to", "topic")
    got = {r.topic: r.subject for r in reg.schema_for_topics(topics, schemas).collect()}
    assert got == {"/a/x": "one", "/a/z": None}
