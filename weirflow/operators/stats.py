"""Counts and delivery statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One row per flushed batch and route.
BATCH_LOG = (
    "batch_id bigint, topic string, to string, rows bigint, started_at timestamp, "
    "duration_ms bigint, error string"
)


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, largest first, ties by value."""
    return count_by(df, col).orderBy(F.desc("n"), F.asc(col))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by the given columns: a bounded heap per task, no full sort."""
    return df.orderBy(*order).limit(n)


def table_columns(df: DataFrame) -> DataFrame:
    """A table's columns and types as rows."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def route_stats(df: DataFrame, by: str = "to") -> DataFrame:
    """Rows written and batches flushed per route, from rows that carry a batch id."""
    per_batch = df.groupBy(by, "batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return per_batch.groupBy(by).agg(
        F.sum("rows").alias("rows_written"), F.count(F.lit(1)).alias("batches_flushed")
    )


def log_stats(log: DataFrame, by: str = "to") -> DataFrame:
    """Rows written and batches flushed per route, from the batch log."""
    good = log.where("error IS NULL")
    return good.groupBy(by).agg(
        F.sum("rows").alias("rows_written"),
        F.count_distinct("batch_id").alias("batches_flushed"),
    )


def route_totals(stats: DataFrame) -> DataFrame:
    """Totals over all routes of a route_stats table."""
    return stats.agg(
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"),
        F.coalesce(F.sum("batches_flushed"), F.lit(0)).alias("batches_flushed"),
        F.count(F.lit(1)).alias("routes"),
    )


def quality_stats(df: DataFrame, bad: Column, by: str | None = None) -> DataFrame:
    """Processed and failed row counts, overall or per group."""
    aggregates = [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.coalesce(bad, F.lit(True))).alias("failed"),
    ]
    return df.groupBy(by).agg(*aggregates) if by else df.agg(*aggregates)


def batch_profile(log: DataFrame, by: str = "to", accuracy: int = 10_000) -> DataFrame:
    """Spread of batch sizes and durations per route."""
    return log.groupBy(by).agg(
        F.count(F.lit(1)).alias("batches"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        F.avg("rows").alias("avg_rows"),
        F.percentile_approx("rows", 0.5, accuracy).alias("median_rows"),
        F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"),
        F.percentile_approx("duration_ms", 0.95, accuracy).alias("p95_ms"),
    )


def topic_properties(routes: DataFrame) -> DataFrame:
    """Distinct target topics with (partitions, reliable); the last route wins."""
    return (
        routes.groupBy(F.col("to").alias("topic"))
        .agg(F.max_by(F.struct("partitions", "reliable"), "idx").alias("p"))
        .select("topic", "p.partitions", "p.reliable")
    )


def route_last_error(log: DataFrame, by: str = "to") -> DataFrame:
    """Error of each route's newest batch; NULL once a batch went through."""
    newest = F.max_by(F.struct("batch_id", "error"), "batch_id")
    return log.groupBy(by).agg(newest.alias("b")).select(by, "b.batch_id", "b.error")


def collection_info(points: DataFrame, catalog: DataFrame, name: str) -> DataFrame:
    """Points count, dimension and distance of a stored collection."""
    found = points.agg(
        F.count(F.lit(1)).alias("points"), F.max(F.size("vector")).alias("stored_dimension")
    ).withColumn("name", F.lit(name))
    return (
        catalog.where(F.col("name") == name)
        .join(found, "name")
        .select("name", "points", "stored_dimension", "dimension", "distance")
    )


def list_collections(catalog: DataFrame) -> DataFrame:
    return catalog.select("name").distinct().orderBy("name")
