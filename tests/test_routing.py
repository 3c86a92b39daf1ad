import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from weirflow import Endpoint, Route, SpecError
from weirflow.functions.topics import effective_reliable, topic_matches, valid_topic
from weirflow.operators import routing
from weirflow.specs import AdmissionSpec, CollectionSpec, FieldMapping, check_routes, check_storage


def matches(pattern, topic, parent=False):
    """The rule level by level, as plain code."""
    p, t = pattern.split("/"), topic.split("/")
    for i, level in enumerate(p):
        if level == "#":
            return i < len(t) or (parent and i == len(t))
        if i >= len(t) or (level != "+" and level != t[i]):
            return False
    return len(p) == len(t)


CASES = [
    ("yard", "yard", True),
    ("yard/gate", "yard", False),
    ("+/open", "gate/open", True),
    ("+/open", "gate/shut", False),
    ("+/open", "yard/gate/open", False),
    ("yard/+/+", "yard//2", True),
    ("#", "yard", True),
    ("yard/#", "yards/gate", False),
    ("yard/#", "yard", False),
    ("yard/#", "yard/", True),
    ("yard/+", "yard/", True),
    ("+/gate/#", "yard/gate/2/hinge", True),
    ("+/gate/#", "yard/door/2", False),
    ("a/#/c", "a/x/y", True),
    ("a.b", "axb", False),
    ("a", "a\n", False),
    ("+", "a\n", True),
]


@pytest.mark.parametrize("pattern,topic,expected", CASES)
def test_topic_matches(spark, pattern, topic, expected):
    df = spark.createDataFrame([(topic,)], "topic string")
    assert df.select(topic_matches(F.col("topic"), pattern)).first()[0] is expected
    assert matches(pattern, topic) is expected


def test_first_route_wins_and_table_agrees(spark):
    rng = random.Random(7)
    words = ["a", "b", "", "+", "c.d"]
    topics = {"/".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(150)}
    seen, routes = set(), []
    while len(routes) < 40:
        levels = [rng.choice(["a", "b", "+", "+", "c.d"]) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.4 or not levels:
            levels.append("#")
        pattern = "/".join(levels)
        if pattern not in seen:
            seen.add(pattern)
            routes.append(Route(pattern, f"/t/{len(routes)}"))
    df = spark.createDataFrame([(t,) for t in topics] * 3, "topic string")
    for parent in (False, True):
        listed = routing.route_wildcard(df, routes, hash_matches_parent=parent)
        table = routing.route_by_table(df, routing.routes_frame(spark, routes), hash_matches_parent=parent)
        expected = {t: next((r.to for r in routes if matches(r.source, t, parent)), None) for t in topics}
        assert {(r.topic, r.to) for r in listed.collect()} == set(expected.items())
        assert {(r.topic, r.to) for r in table.collect()} == set(expected.items())
        assert table.count() == df.count()


def test_route_table_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame([("a/b",)], "topic string")
    table = routing.routes_frame(spark, [Route("a/+", "/x/y")])
    plan = plan_of(routing.route_by_table(df, table))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unrouted(spark):
    df = spark.createDataFrame([("a",), ("b",)], "topic string")
    routed = routing.route_exact(df, [Route("a", "/x/a")])
    assert [r.topic for r in routing.on_unrouted_rows(routed, "topic", "drop").collect()] == ["a"]
    good, bad = routing.split_unrouted(routed)
    assert good.count() == 1 and [r.topic for r in bad.collect()] == ["b"]
    with pytest.raises(Exception, match="No route for topic: b"):
        routing.on_unrouted_rows(routed, "topic", "fail").collect()
    assert [r.topic for r in routing.unrouted_messages(df, [Route("a", "/x/a")]).collect()] == ["b"]


def test_duplicate_routes():
    a, b = Route("t", "/x/1"), Route("t", "/x/2")
    with pytest.raises(SpecError, match="two routes"):
        check_routes([a, b])
    assert check_routes([a, b], "first") == [a]
    assert check_routes([a, b], "last") == [b]


def test_repeated_source_in_a_table(spark):
    """A message gets one target, never one for each repeat."""
    table = spark.createDataFrame([(2, "t", "/x/2"), (0, "t", "/x/0"), (1, "t", "/x/1"), (3, "u", "/x/u")], "idx int, source string, to string")
    df = spark.createDataFrame([("t",), ("u",), ("v",)], "topic string")
    for mode, want in (("first", "/x/0"), ("last", "/x/2")):
        got = {r.topic: r.to for r in routing.route_exact(df, table, duplicates=mode).collect()}
        assert got == {"t": want, "u": "/x/u", "v": None} and routing.route_exact(df, table, duplicates=mode).count() == 3
    with pytest.raises(Exception, match="source named by two routes: t"):
        routing.route_exact(df, table).collect()


def test_reliable_flag(spark):
    assert [Route("t", "/x/1", qos=q).effective_reliable for q in (0, 1, 2)] == [False, True, True]
    assert Route("t", "/x/1", qos=0, reliable=True).effective_reliable
    df = spark.createDataFrame([(0, None), (1, None), (2, False)], "qos int, r boolean")
    got = [r[0] for r in df.select(effective_reliable(F.col("qos"), F.col("r"))).collect()]
    assert got == [False, True, False]


def test_valid_topic(spark):
    names = {"/a/b": True, "/a": False, "a/b": False, "/a/b/c": False, "//b": False, "/a/b\n": True}
    df = spark.createDataFrame([(n,) for n in names], "t string")
    assert dict(df.select("t", valid_topic(F.col("t"))).collect()) == names


@pytest.mark.parametrize(
    "make",
    [
        lambda: Route("", "/a/b"),
        lambda: Route("a", ""),
        lambda: Route("a", "/a/b", subscription=""),
        lambda: Route("a", "/a/b", qos=3),
        lambda: check_routes([]),
        lambda: Endpoint("no-slash", "/a/b"),
        lambda: Endpoint("/x", ""),
        lambda: AdmissionSpec([]),
        lambda: AdmissionSpec([Endpoint("/x", "/a/b"), Endpoint("/x", "/a/c")]),
        lambda: AdmissionSpec([Endpoint("/x", "/a/b")], auth="apikey", header=None),
        lambda: CollectionSpec("c", 0),
        lambda: CollectionSpec("c", 4, "hamming"),
        lambda: FieldMapping("a", "a", "InvalidType"),
        lambda: FieldMapping("a", "", "Utf8"),
        lambda: check_storage("s3", {}),
        lambda: check_storage("azure", {"account": "a"}),
        lambda: check_storage("gcs", {}),
        lambda: check_storage("ftp", {}),
    ],
)
def test_bad_settings(make):
    with pytest.raises(SpecError):
        make()
