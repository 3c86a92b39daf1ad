import json
import time

import pytest
from helpers import column
from pyspark.sql import functions as F

from weirflow.functions.variants import json_path, strict_json
from weirflow.operators.decode import decode_payload
from weirflow.operators.flatten import with_flat

NOT_JSON = ['{"a":1} x', "1],[2", '1}, {"v":2', '{"a":1}],[2', "[1],[2]", "", "01", "{'a':1}", "[1,]", "NaN", "nul", "1 2", "1,2"]
ARE_JSON = ['{"a":1}', "1", "[1,2]", '"]"', "null", " 7 ", "true", "[]", "{}", '{"a":{"b":[1,{"c":"]"}]}}', "-1.5e3"]


@pytest.mark.parametrize("text", NOT_JSON)
def test_not_json_becomes_base64(texts, text):
    df = texts(text).select(F.col("payload").cast("binary").alias("b"))
    got = json.loads(column(df, decode_payload(F.col("b")))[0])
    import base64

    assert got == {"data": base64.b64encode(text.encode()).decode(), "size": len(text), "encoding": "base64"}


def test_json_of_any_kind_is_kept(texts):
    df = texts(*ARE_JSON).select(F.col("payload").cast("binary").alias("b"))
    assert column(df, decode_payload(F.col("b"))) == ARE_JSON


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(bytes([0xFF, 0x31]),), (b"x" * 200,)], "b binary")
    a, b = (json.loads(x) for x in column(df, decode_payload(F.col("b"))))
    assert a == {"data": "/zE=", "size": 2, "encoding": "base64"}
    assert b["size"] == 200 and "\n" not in b["data"] and len(b["data"]) == 268


def test_last_duplicate_key_wins(texts):
    df = texts('{"a":1,"a":2}')
    assert column(df, F.to_json(strict_json(F.col("payload")))) == ['{"a":2}']


def test_json_path(texts):
    df = texts('{"ship":{"crew":{"cook":"Ida"},"masts":2},"port":"Oslo","cargo":null,"log":[{"day":4}]}')
    v = strict_json(F.col("payload"))

    def at(path):
        return column(df, F.to_json(json_path(v, path)))[0]

    assert at("ship.crew.cook") == '"Ida"'
    assert at("port") == '"Oslo"'
    assert at("ship.masts.height") is None and at("ship.sails") is None
    assert at("cargo") == "null"
    assert at("log.day") is None and at("log.0") is None


def flat_of(df):
    parsed = df.select("payload", strict_json(F.col("payload")).alias("v"))
    return [json.loads(x) for x in column(with_flat(parsed, "v", "flat"), F.to_json("flat"))]


def test_flatten(texts):
    cases = {
        '{"port":"Oslo","tons":7,"loaded":false}': {"port": "Oslo", "tons": 7, "loaded": False},
        '{"a":{"b":{"c":1},"d":null},"e":{}}': {"a.b.c": 1},
        '{"a":[1,"x",null,{"q":1},[2],true,1.5],"b":[null],"c":[]}': {"a": [1, "x", True, 1.5]},
        "7": {"": 7},
        "null": {},
        '{"a.b":9,"a":{"b":1}}': {"a.b": 9},
        '{"big":18446744073709551615,"i":9223372036854775807}': {
            "big": 18446744073709551615.0,
            "i": 9223372036854775807,
        },
        '{"":{"x":1}}': {"x": 1},
    }
    assert flat_of(texts(*cases)) == list(cases.values())


def plain_flat(value):
    """Dotted keys by recursion."""
    out = {}

    def walk(key, v):
        if isinstance(v, dict):
            for k in sorted(v):
                walk(k if key == "" else f"{key}.{k}", v[k])
        elif isinstance(v, list):
            kept = [x for x in v if not isinstance(x, (list, dict)) and x is not None]
            if kept:
                out[key] = kept
        elif v is not None:
            out[key] = float(v) if type(v) is int and abs(v) >= 2**63 else v

    walk("", value)
    return out


def test_flatten_any_depth(texts):
    def nest(levels, inner):
        return '{"a":' * levels + inner + "}" * levels

    rich = '{"x":1.25,"s":"t","l":[1,[2],{"q":3},null,"u"],"n":null,"e":{},"big":18446744073709551615,"t":true}'
    many = [nest(n, rich) for n in range(14)] + [nest(100, "5"), nest(400, '"deep"'), '{"p":' + nest(30, rich) + ',"q":{"r":2}}']
    assert flat_of(texts(*many)) == [plain_flat(json.loads(t)) for t in many]


def test_flatten_plans_are_small(texts):
    start = time.monotonic()
    parsed = texts("{}").select(strict_json(F.col("payload")).alias("v"))
    with_flat(parsed, "v", "flat")._jdf.queryExecution().optimizedPlan()
    assert time.monotonic() - start < 3


def test_deep_objects_are_read_in_one_pass(texts):
    """Below the native levels: odd keys, lists with objects, escapes, and a cost that is not the square of the depth."""

    def nest(levels, inner, key="a"):
        return json.dumps({key: None})[:-5] * levels + json.dumps(inner) + "}" * levels

    odd = {"": {"": 1}, 'q"x': {"b\\c": ["]", "{", '"', "\\", "\n"]}, "x\":{\"y": {"e": {}, "n": None}, "é.f": [[1, {"z": [2]}], []]}
    whole = {"lists": [{"q": {"r": 1}}, [{"s": [1]}]], "d": -7, "t": True, "big": 1e300, "s": "Infinity-"}
    many = [nest(n, v, key) for n in (4, 9, 40) for v in (odd, whole, {"f": 5.0, "m": [1, "x"]}) for key in ("a", "", 'k"\\')]
    assert flat_of(texts(*many)) == [plain_flat(json.loads(t)) for t in many]
    start = time.monotonic()
    assert flat_of(texts(*[nest(300, i) for i in range(100)])) == [{".".join("a" * 300): i} for i in range(100)]
    assert time.monotonic() - start < 20


def test_flat_columns_are_computed_once(texts):
    """The filter below an explode reads the finished column."""
    parsed = texts("{}").select(strict_json(F.col("payload")).alias("v"))
    plan = with_flat(parsed, "v", "flat").select(F.explode("flat"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries(") == 1
