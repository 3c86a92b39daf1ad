"""Which topic, table or collection a message goes to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.topics import topic_matches
from weirflow.specs import Route, SpecError, check_routes

UNROUTED_MODES = ("drop", "keep", "fail")

# Above this many listed routes a plan holds them as a joined table, not as literals.
MAX_LISTED_ROUTES = 256


# A driver-side list up to this length is a table small enough to send to every task.
MAX_BROADCAST_ROWS = 10_000


def listed_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table from a driver-side list, marked for broadcast while the list is short.

    Spark knows no size for such a table and would shuffle the other side of a join.
    """
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= MAX_BROADCAST_ROWS else table


def routes_frame(spark: SparkSession, routes: Sequence[Route]) -> DataFrame:
    """The routes as a table ``idx, source, to, qos, partitions, reliable``."""
    rows = [
        (i, r.source, r.to, r.qos, r.partitions, r.effective_reliable)
        for i, r in enumerate(routes)
    ]
    return listed_frame(
        spark, rows, "idx int, source string, to string, qos int, partitions int, reliable boolean"
    )


def _one_per_source(routes: DataFrame, duplicates: str) -> DataFrame:
    """``source, to`` of a route table with one row for each source."""
    if duplicates not in ("reject", "first", "last"):
        raise SpecError(f"unknown duplicates mode {duplicates!r}")
    order = F.col("idx") if "idx" in routes.columns else F.col("to")
    pick = F.max_by("to", order) if duplicates == "last" else F.min_by("to", order)
    found = routes.groupBy("source").agg(pick.alias("to"), F.count(F.lit(1)).alias("_n"))
    if duplicates == "reject":
        stop = F.raise_error(F.concat(F.lit("source named by two routes: "), "source")).cast("string")
        found = found.withColumn("to", F.when(F.col("_n") > 1, stop).otherwise(F.col("to")))
    return found.select("source", "to")


def route_exact(
    df: DataFrame,
    routes: Sequence[Route] | DataFrame,
    col: str = "topic",
    duplicates: str = "reject",
) -> DataFrame:
    """Add ``to``: the target of the route whose source equals the topic, else NULL.

    A list is broadcast while it is short. A route table is joined without a hint:
    Spark broadcasts it below its size threshold, else shuffles with skew splitting.
    ``duplicates`` says what happens to a repeated source: 'reject' (in a table, the query
    stops), or the 'first' or 'last' by ``idx`` counts.
    """
    if isinstance(routes, DataFrame):
        table = _one_per_source(routes, duplicates).withColumnRenamed("source", col)
    else:
        kept = check_routes(routes, duplicates)
        table = routes_frame(df.sparkSession, kept).select(F.col("source").alias(col), "to")
    return df.join(table, col, "left")


def first_match(topic: Column, routes: Sequence[Route], hash_matches_parent: bool = False) -> Column:
    """Target of the first route in list order that matches, else NULL."""
    result = None
    for route in routes:
        hit = topic_matches(topic, route.source, hash_matches_parent)
        result = F.when(hit, route.to) if result is None else result.when(hit, route.to)
    if result is None:
        raise SpecError("no routes given")
    return result


def route_wildcard(
    df: DataFrame,
    routes: Sequence[Route] | DataFrame,
    col: str = "topic",
    hash_matches_parent: bool = False,
) -> DataFrame:
    """Add ``to`` by wildcard pattern; the first matching route wins.

    A short list becomes one CASE expression: no join, no shuffle. A route table, or
    a longer list, goes through :func:`route_by_table`.
    """
    if not isinstance(routes, DataFrame):
        if len(routes) <= MAX_LISTED_ROUTES:
            return df.withColumn("to", first_match(F.col(col), routes, hash_matches_parent))
        routes = routes_frame(df.sparkSession, routes)
    return route_by_table(df, routes, col, hash_matches_parent)


def pattern_shapes(routes: DataFrame) -> DataFrame:
    """Every pattern as (shape, key): equality on both replaces pattern matching.

    A shape says how many leading levels count, which of them are ``+``, and whether
    anything may follow. The key is the pattern's leading levels.
    """
    levels = F.split("source", "/")
    hash_at = F.array_position(levels, "#")
    n = F.when(hash_at > 0, hash_at - 1).otherwise(F.size(levels)).cast("int")
    return (
        routes.select("idx", "to", levels.alias("levels"), (hash_at > 0).alias("rest"), n.alias("n"))
        .withColumn("head", F.slice("levels", 1, F.col("n")))
        .select(
            "idx",
            "to",
            "n",
            "rest",
            F.transform("head", lambda x: x == "+").alias("plus"),
            F.concat_ws("/", "head").alias("pattern_key"),
        )
    )


def match_topics(
    topics: DataFrame, routes: DataFrame, col: str = "topic", hash_matches_parent: bool = False
) -> DataFrame:
    """For each topic the first matching route, by equality joins only.

    ``topics`` holds distinct topics. Each is paired with the few shapes of its
    length, masked the way the shape says, and joined to the patterns by key.
    """
    patterns = pattern_shapes(routes)
    shapes = patterns.select("n", "rest", "plus").distinct()
    min_rest = 0 if hash_matches_parent else 1
    levels = topics.select(col, F.split(col, "/").alias("levels"))
    prefixes = (
        levels.withColumn("n", F.explode(F.sequence(F.lit(0), F.size("levels"))))
        .withColumn("left_over", F.size("levels") - F.col("n"))
        .withColumn(
            "rest",
            F.explode(
                F.array_compact(
                    F.array(
                        F.when(F.col("left_over") >= min_rest, F.lit(True)),
                        F.when(F.col("left_over") == 0, F.lit(False)),
                    )
                )
            ),
        )
    )
    masked = prefixes.join(shapes, ["n", "rest"]).select(
        col,
        "n",
        "rest",
        "plus",
        F.concat_ws(
            "/",
            F.zip_with(
                F.slice("levels", 1, F.col("n")), "plus", lambda x, p: F.when(p, "+").otherwise(x)
            ),
        ).alias("pattern_key"),
    )
    return (
        masked.join(patterns, ["n", "rest", "plus", "pattern_key"])
        .groupBy(col)
        .agg(F.min(F.struct("idx", "to")).alias("hit"))
        .select(col, F.col("hit.to").alias("to"))
    )


def route_by_table(
    df: DataFrame, routes: DataFrame, col: str = "topic", hash_matches_parent: bool = False
) -> DataFrame:
    """Wildcard routing by a table ``idx, source, to`` of any size.

    Patterns are matched against the distinct topics, which map-side aggregation
    collapses even when one topic holds most rows; messages then join by topic.
    """
    topics = df.select(col).where(F.col(col).isNotNull()).distinct()
    return df.join(match_topics(topics, routes, col, hash_matches_parent), col, "left")


def on_unrouted_rows(df: DataFrame, topic_col: str, mode: str) -> DataFrame:
    """What happens to rows without a route: 'drop', 'keep' (``to`` is NULL) or 'fail'."""
    if mode not in UNROUTED_MODES:
        raise SpecError(f"unknown mode {mode!r}")
    if mode == "drop":
        return df.where(F.col("to").isNotNull())
    if mode == "fail":
        message = F.concat(F.lit("No route for topic: "), F.coalesce(topic_col, F.lit("NULL")))
        return df.withColumn(
            "to", F.when(F.col("to").isNull(), F.raise_error(message)).otherwise(F.col("to"))
        )
    return df


def split_unrouted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(routed, unrouted) for setting unrouted rows aside."""
    return df.where(F.col("to").isNotNull()), df.where(F.col("to").isNull()).drop("to")


def unrouted_messages(
    df: DataFrame, routes: Sequence[Route] | DataFrame, col: str = "topic"
) -> DataFrame:
    """Messages whose topic no route names."""
    table = routes if isinstance(routes, DataFrame) else routes_frame(df.sparkSession, routes)
    return df.join(table.select(F.col("source").alias(col)), col, "left_anti")
