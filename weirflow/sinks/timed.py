"""Tables in buckets of time: a derived partition that range filters prune.

The partition is the start of a row's hour, day or month, in UTC and as text that sorts like time
(its first letter tells the unit, and keeps Spark from taking it for a date).
A range over the exact time is turned into one over the partition, so Spark lists and reads only
the partitions that overlap it, and the exact comparison is left for their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.specs import SpecError

#: Name of the partition column, and what a row without a time has there.
BUCKET = "time_bucket"
NO_TIME = "none"
# Formats of the partitions.
_FORMATS = {"hour": "'h'yyyy-MM-dd-HH", "day": "'d'yyyy-MM-dd", "month": "'m'yyyy-MM"}


def time_bucket(at: Column, unit: str = "day") -> Column:
    """The partition of a time."""
    if unit not in _FORMATS:
        raise SpecError(f"unknown unit {unit!r}")
    return F.coalesce(F.date_format(at, _FORMATS[unit]), F.lit(NO_TIME))


def write_timed(
    df: DataFrame, path: str, at: str, unit: str = "day", batch_id: int | None = None, fmt: str = "parquet", spread: int | None = None
) -> None:
    """Store rows under the bucket of their time ``at``.

    A batch with an id replaces itself: it has a partition of its own in every bucket. ``spread``
    deals the rows so that a bucket's come from at most so many tasks, instead of from all.
    """
    if BUCKET in df.columns:
        raise SpecError(f"column {BUCKET} is the table's own")
    rows = df.withColumn(BUCKET, time_bucket(F.col(at), unit))
    if spread is not None:
        # Salted, so that a bucket with most rows is more than one task.
        rows = rows.repartition(BUCKET, F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    if batch_id is None:
        rows.write.format(fmt).partitionBy(BUCKET).mode("append").save(path)
        return
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", BUCKET)
        .mode("overwrite")
        .save(path)
    )


def read_timed(
    spark: SparkSession, path: str, at: str, start: str | None = None, end: str | None = None, unit: str = "day", fmt: str = "parquet"
) -> DataFrame:
    """Rows with ``start <= at < end``; a bound left out is open. ``unit`` is that of the table.

    Rows without a time come only when no bound is given.
    """
    if unit not in _FORMATS:
        raise SpecError(f"unknown unit {unit!r}")
    rows = spark.read.format(fmt).load(path)
    kind = rows.schema[at].dataType.typeName()
    if start is not None:
        rows = rows.where((F.col(BUCKET) >= _bucket_text(spark, start, unit)) & (F.col(at) >= F.lit(start).cast(kind)))
    if end is not None:
        rows = rows.where((F.col(BUCKET) <= _bucket_text(spark, end, unit)) & (F.col(at) < F.lit(end).cast(kind)))
    if start is not None or end is not None:
        rows = rows.where(F.col(BUCKET) != NO_TIME)
    return rows.drop(BUCKET, "batch_id")


def _bucket_text(spark: SparkSession, bound: str, unit: str) -> str:
    """A bound's bucket, worked out once so that the filter compares with a constant."""
    text = spark.range(1).select(F.date_format(F.lit(bound).try_cast("timestamp"), _FORMATS[unit])).first()[0]
    if text is None:
        raise SpecError(f"not a time: {bound!r}")
    return text


def buckets_of(spark: SparkSession, path: str, fmt: str = "parquet") -> Sequence[str]:
    """Names of the stored buckets, from the partitions."""
    return sorted(r[0] for r in spark.read.format(fmt).load(path).select(BUCKET).distinct().collect())
