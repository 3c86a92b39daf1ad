"""Upsert in place: a table in buckets of keys, of which a batch rewrites those that it touches.

A row's bucket is told by its key, so a batch's rows and the stored rows that they replace are in
the same buckets. A batch reads the buckets it touches, and no others, and writes each anew as the
partition ``bucket=B/version=N`` of the table. Then one small file, the batch's commit, names the
version of every bucket. Readers take the last commit and read the partitions that it names: rows
are plain, one per key, so reading needs no window, no join and no listing of older versions.

Until the commit is there nothing has changed, so a batch that failed half-way is run again as it
is; its partitions are replaced. A batch that is committed already is left out. A version that a
commit no longer names serves those who still read it, until :func:`compact_buckets` drops it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.sinks.tables import _NO_TABLE, _same_columns, latest_by_key
from weirflow.specs import SpecError

COMMIT = "bucket int, version bigint, buckets int"


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with one row for each ``key``, in ``buckets`` parts.

    ``order_by`` tells the later of two rows of a batch. ``bucket`` is an expression from 0 up to
    ``buckets``, over columns of the key; without it keys are hashed. ``files`` is the number of
    tasks, and files, that a rewritten bucket is dealt to.
    """

    path: str
    key: Sequence[str]
    order_by: Sequence[str] = ()
    buckets: int = 256
    bucket: Column | None = None
    files: int = 1

    def __post_init__(self):
        if not self.key:
            raise SpecError("a keyed table needs a key")
        if self.buckets < 1 or self.files < 1:
            raise SpecError("buckets and files must be at least 1")

    def bucket_of(self) -> Column:
        found = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)) if self.bucket is None else self.bucket
        return found.cast("int")


def _commits(spark: SparkSession, table: KeyedTable) -> DataFrame | None:
    try:
        found = spark.read.schema(COMMIT).option("basePath", f"{table.path}/commits").parquet(f"{table.path}/commits")
    except AnalysisException as error:
        if error.getCondition() not in _NO_TABLE:
            raise
        return None
    return found if "batch_id" in found.columns else None


def current_versions(spark: SparkSession, table: KeyedTable) -> tuple[int | None, dict[int, int]]:
    """(last committed batch, version of each bucket that has rows). At most one row per bucket is read."""
    commits = _commits(spark, table)
    last = None if commits is None else commits.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None, {}
    rows = commits.where(F.col("batch_id") == last).collect()
    if rows[0].buckets != table.buckets:
        raise SpecError(f"table {table.path} has {rows[0].buckets} buckets, not {table.buckets}")
    return last, {r.bucket: r.version for r in rows}


def _schema(spark: SparkSession, table: KeyedTable) -> T.StructType | None:
    try:
        return spark.read.parquet(f"{table.path}/columns").schema
    except AnalysisException as error:
        if error.getCondition() not in _NO_TABLE:
            raise
        return None


def _read(spark: SparkSession, table: KeyedTable, versions: dict[int, int], schema: T.StructType) -> DataFrame:
    """The named versions of buckets, with the bucket as a column. Nothing else is listed."""
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())])
    if not versions:
        return spark.createDataFrame([], whole).drop("version")
    rows = f"{table.path}/rows"
    places = [f"{rows}/bucket={b}/version={v}" for b, v in sorted(versions.items())]
    return spark.read.schema(whole).option("basePath", rows).parquet(*places).drop("version")


def read_buckets(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The table's rows after the last committed batch."""
    schema = _schema(spark, table)
    if schema is None:
        raise SpecError(f"no table at {table.path}")
    return _read(spark, table, current_versions(spark, table)[1], schema).drop("bucket")


def upsert_buckets(table: KeyedTable, batch: DataFrame, batch_id: int) -> list[int]:
    """Replace and add the batch's rows; returns the buckets that were rewritten.

    Rows of a batch win over stored ones. A NULL key stops the batch. Batches come in the order of
    their ids; one that is committed already changes nothing.
    """
    spark = batch.sparkSession
    last, versions = current_versions(spark, table)
    if last is not None and batch_id <= last:
        return []
    if {"bucket", "version"} & set(batch.columns):
        raise SpecError("columns bucket and version are the table's own")
    schema = _schema(spark, table)
    if schema is None:
        spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(f"{table.path}/columns")
        schema = spark.read.parquet(f"{table.path}/columns").schema
    _same_columns("batch", batch.schema, schema)
    # Written once: what is merged, and which buckets it touches, must be the same rows.
    incoming = f"{table.path}/incoming"
    newest = latest_by_key(batch, table.key, table.order_by or table.key).select(*schema.names)
    newest.withColumn("bucket", table.bucket_of()).write.mode("overwrite").parquet(incoming)
    newest = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(incoming)
    touched = sorted(r.bucket for r in newest.select("bucket").distinct().collect())  # at most one for each bucket
    if touched and not 0 <= touched[0] <= touched[-1] < table.buckets:
        raise SpecError(f"buckets run from 0 to {table.buckets - 1}, found {touched[0]} and {touched[-1]}")
    old = _read(spark, table, {b: versions[b] for b in touched if b in versions}, schema)
    kept = old.join(newest.select("bucket", *table.key), ["bucket", *table.key], "left_anti")
    merged = kept.select(*newest.columns).unionByName(newest)
    spread = F.pmod(F.xxhash64(*table.key), F.lit(table.files))
    (
        merged.repartition(max(1, len(touched) * table.files), "bucket", spread)
        .withColumn("version", F.lit(batch_id).cast("bigint"))
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "version")
        .mode("overwrite")
        .parquet(f"{table.path}/rows")
    )
    versions = versions | {b: batch_id for b in touched}
    _commit(spark, table, versions, batch_id)
    return touched


def _commit(spark: SparkSession, table: KeyedTable, versions: dict[int, int], batch_id: int) -> None:
    if not versions:
        return
    rows = [(b, v, table.buckets) for b, v in sorted(versions.items())]
    place = f"{table.path}/commits/batch_id={batch_id}"
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").parquet(place)


def _drop(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def compact_buckets(spark: SparkSession, table: KeyedTable, keep: int = 1) -> int:
    """Drop commits before the last ``keep``, and versions that none of those names; returns how many versions went."""
    if keep < 1:
        raise SpecError("the last commit is always kept")
    commits = _commits(spark, table)
    if commits is None:
        return 0
    ids = sorted(r.batch_id for r in commits.select("batch_id").distinct().collect())
    old = ids[:-keep]
    if not old:
        return 0
    oldest = ids[-keep]
    named = commits.where(F.col("batch_id") >= oldest).select("bucket", "version")
    gone = commits.where(F.col("batch_id") < oldest).select("bucket", "version").distinct().exceptAll(named.distinct()).collect()
    for r in gone:
        _drop(spark, f"{table.path}/rows/bucket={r.bucket}/version={r.version}")
    for batch_id in old:
        _drop(spark, f"{table.path}/commits/batch_id={batch_id}")
    return len(gone)
