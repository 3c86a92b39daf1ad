"""A registry of message schemas, kept as a table.

Columns: ``subject STRING, version INT, schema_type STRING, schema_json STRING``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirflow.operators.routing import listed_frame
from weirflow.specs import SpecError, TopicSchema

REGISTRY = "subject string, version int, schema_type string, schema_json string"


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY)


def _eligible(strategy: str | dict) -> Column:
    if strategy == "latest":
        return F.lit(True)
    if isinstance(strategy, dict) and len(strategy) == 1:
        (name, version), = strategy.items()
        if name == "pinned":
            return F.col("version") == version
        if name == "minimum":
            return F.col("version") >= version
    raise SpecError(f"unknown version strategy {strategy!r}")


def resolve_schemas(registry: DataFrame, strategy: str | dict = "latest") -> DataFrame:
    """The version the strategy picks, for every subject."""
    picked = F.max_by(F.struct("version", "schema_type", "schema_json"), "version")
    return (
        registry.where(_eligible(strategy))
        .groupBy("subject")
        .agg(picked.alias("s"))
        .select("subject", "s.version", "s.schema_type", "s.schema_json")
    )


def resolve_schema(registry: DataFrame, subject: str, strategy: str | dict = "latest") -> DataFrame:
    """One subject's schema under a version strategy: latest, pinned=n or minimum=n."""
    return resolve_schemas(registry.where(F.col("subject") == subject), strategy)


def register_schemas(registry: DataFrame, offered: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """New registry rows for offered ``subject, schema_type, schema_json``.

    Each distinct offer of a subject becomes the next version, in the order of ``order_by``
    (columns of ``offered``), then of type and text. An offer that equals the newest
    version is none. Append the result to the stored registry.
    """
    text = ["schema_type", "schema_json"]
    newest = resolve_schemas(registry).select(
        "subject", "version", F.col("schema_json").alias("known"), F.col("schema_type").alias("kt")
    )
    distinct = offered.groupBy("subject", *text).agg(F.min(F.struct(*order_by, *text)).alias("_order"))
    fresh = distinct.join(newest, "subject", "left").where(
        ~F.col("schema_json").eqNullSafe(F.col("known")) | ~F.col("schema_type").eqNullSafe(F.col("kt"))
    )
    place = F.row_number().over(Window.partitionBy("subject").orderBy("_order"))
    return fresh.select(
        "subject", (F.coalesce("version", F.lit(0)) + place).cast("int").alias("version"), *text
    )


def register_schema(
    registry: DataFrame, subject: str, schema_type: str, schema_json: str
) -> DataFrame:
    """New registry rows (none or one) for a single subject."""
    offered = registry.sparkSession.createDataFrame(
        [(subject, schema_type, schema_json)],
        "subject string, schema_type string, schema_json string",
    )
    return register_schemas(registry, offered)


def schemas_frame(spark: SparkSession, schemas: Sequence[TopicSchema]) -> DataFrame:
    rows = [(i, s.topic, s.subject, s.schema_type, s.auto_register) for i, s in enumerate(schemas)]
    return listed_frame(
        spark,
        rows,
        "idx int, topic string, subject string, schema_type string, auto_register boolean",
    )


def schema_for_topics(topics: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every topic with the first schema configured for it, or NULLs."""
    first = (
        schemas.groupBy("topic")
        .agg(F.min_by(F.struct("subject", "schema_type"), "idx").alias("s"))
        .select("topic", "s.subject", "s.schema_type")
    )
    return topics.join(first, "topic", "left")


def schemas_without_route(schemas: DataFrame, routes: DataFrame) -> DataFrame:
    """Schemas configured for a topic that no route produces."""
    return schemas.join(routes.select(F.col("to").alias("topic")), "topic", "left_anti")
