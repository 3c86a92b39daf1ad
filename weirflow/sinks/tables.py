"""Writing one table.

``fmt`` is any Spark table format on the class path; nothing here needs more than
Parquet. With ``fmt='delta'`` and the Delta package present, appends carry a
transaction id so that a repeated batch is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weirflow.specs import CollectionSpec, SpecError, check_storage

BATCH = "batch_id"
#: The batch of a table that was made before anything was stored in it; it has no rows.
EMPTY_BATCH = -1


def write_append(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options
) -> None:
    """Append a batch: one job, one commit."""
    df.write.format(fmt).options(**options).partitionBy(*partition_by).mode("append").save(path)


def write_overwrite(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), **options
) -> None:
    """Replace the table's contents."""
    df.write.format(fmt).options(**options).partitionBy(*partition_by).mode("overwrite").save(path)


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    fmt: str = "parquet",
    app_id: str = "weirflow",
    declared: T.StructType | None = None,
    **options,
) -> None:
    """Store a micro-batch so that storing it again changes nothing.

    File formats keep it in its own ``batch_id`` partition, which a repeat replaces, also
    by nothing. With ``declared`` the table is made with these columns when it is missing,
    and must have them when it is there; so must the batch.
    """
    if declared is not None:
        _same_columns("batch", df.schema, declared)
        ensure_table(df.sparkSession, path, declared, fmt, None if fmt == "delta" else EMPTY_BATCH)
    if fmt == "delta":
        write_append(df, path, fmt, txnAppId=app_id, txnVersion=str(batch_id), **options)
        return
    df.write.format(fmt).options(**options).mode("overwrite").save(f"{path}/{BATCH}={int(batch_id)}")


# Error conditions that say there is no table yet; any other failure is passed on.
_NO_TABLE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_MISSING_DELTA_TABLE"}


def _same_columns(what: str, found: T.StructType, declared: T.StructType) -> None:
    have = {f.name: f.dataType for f in found.fields}
    for field in declared.fields:
        if have.get(field.name) != field.dataType:
            raise SpecError(
                f"{what}: column {field.name} is {have.get(field.name, 'missing')}, declared {field.dataType}"
            )


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", batch_id: int | None = None
) -> DataFrame:
    """Open the table at ``path``, or make it empty with the declared schema.

    An existing table must have the declared column names and types. ``batch_id`` names the
    partition of a table of batches that is made empty.
    """
    try:
        found = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in _NO_TABLE:
            raise
        place = path if batch_id is None else f"{path}/{BATCH}={batch_id}"
        spark.createDataFrame([], schema).write.format(fmt).mode("append").save(place)
        return spark.read.format(fmt).schema(schema).load(path)
    _same_columns(f"table {path}", found.schema, schema)
    return found


def _named(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows; one without a key stops the query instead of replacing another."""
    checked = {
        k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"row without {k}")).cast(df.schema[k].dataType)).otherwise(F.col(k))
        for k in key
    }
    return df.withColumns(checked)


def without_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with a NULL in the key, to be set aside before an upsert."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return df.where(missing)


def latest_by_key(df: DataFrame, key: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The last row per key. Earlier ones are cut before the shuffle, so a hot key is
    one row per task by the time it moves. A NULL key stops the query."""
    last_first = [F.col(c).desc() if isinstance(c, str) else c for c in order_by]
    place = Window.partitionBy(*key).orderBy(*last_first)
    numbered = _named(df, key).withColumn("_place", F.row_number().over(place))
    return numbered.where("_place = 1").drop("_place")


def upsert_by_key(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """The table after an upsert: later rows of a batch replace earlier ones and the
    stored one. The batch's keys are the small side of the anti-join, which Spark
    broadcasts below its threshold; the target then is only scanned."""
    newest = latest_by_key(batch, key, order_by).select(*target.columns)
    kept = target.join(newest.select(*key), list(key), "left_anti")
    return kept.select(*target.columns).unionByName(newest)


def read_latest(
    spark: SparkSession,
    path: str,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Current rows of a table whose batches were stored by :func:`write_batch`.

    Upserts without a merge-capable format are stored as they come and resolved on
    read: newest batch first, then ``order_by``. Write the result elsewhere from time
    to time to keep reads short.
    """
    stored = spark.read.format(fmt).load(path)
    return latest_by_key(stored, key, [BATCH, *order_by]).drop(BATCH)


def merge_upsert(
    spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str], order_by: Sequence[str]
) -> None:
    """Upsert into a Delta table in place. Needs the Delta package."""
    try:
        from delta.tables import DeltaTable
    except ImportError as error:
        raise SpecError("fmt='delta' needs the Delta package on the class path") from error
    same = " AND ".join(f"t.`{k}` = s.`{k}`" for k in key)
    (
        DeltaTable.forPath(spark, path)
        .alias("t")
        .merge(latest_by_key(batch, key, order_by).alias("s"), same)
        .whenMatchedUpdateAll()
        .whenNotMatchedInsertAll()
        .execute()
    )


def new_documents(
    target: DataFrame, batch: DataFrame, table: str, order_by: Sequence[str], id: str = "id"
) -> DataFrame:
    """Rows of the batch to append: the first per id, ids not stored yet.

    Rows without an id get a random one, after everything that shuffles. Stored ids
    are first cut to those the batch names, so the table's ids are scanned, not moved.
    """
    named = batch.where(F.col(id).isNotNull())
    first = latest_by_key(named, [id], [F.col(c).asc() for c in order_by])
    taken = target.select(id).join(named.select(id).distinct(), id, "left_semi")
    fresh = first.join(taken, id, "left_anti").select(*batch.columns)
    unnamed = batch.where(F.col(id).isNull()).withColumn(
        id, F.concat(F.lit(f"{table}:"), F.uuid())
    )
    return fresh.unionByName(unnamed)


def insert_documents(
    target: DataFrame,
    batch: DataFrame,
    table: str,
    order_by: Sequence[str],
    id: str = "id",
    on_conflict: str = "keep_first",
) -> DataFrame:
    """The table after inserting documents.

    'keep_first' leaves a stored document as it is, 'keep_last' replaces it.
    """
    if on_conflict == "keep_first":
        fresh = new_documents(target, batch, table, order_by, id)
        return target.unionByName(fresh.select(*target.columns))
    if on_conflict == "keep_last":
        named = batch.where(F.col(id).isNotNull())
        unnamed = batch.where(F.col(id).isNull()).withColumn(
            id, F.concat(F.lit(f"{table}:"), F.uuid())
        )
        return upsert_by_key(target, named, [id], order_by).unionByName(
            unnamed.select(*target.columns)
        )
    raise SpecError(f"unknown on_conflict {on_conflict!r}")


CATALOG = "name string, dimension int, distance string"


def catalog_frame(spark: SparkSession, specs: Sequence[CollectionSpec]) -> DataFrame:
    return spark.createDataFrame([(s.name, s.dimension, s.distance) for s in specs], CATALOG)


def ensure_collection(catalog: DataFrame, spec: CollectionSpec) -> DataFrame:
    """The catalog with the collection in it.

    A missing collection is added, or refused when auto-create is off. One that exists
    must have the declared dimension and distance.
    """
    found = catalog.where(F.col("name") == spec.name).limit(1).collect()
    if found:
        if (found[0].dimension, found[0].distance) != (spec.dimension, spec.distance):
            raise SpecError(
                f"collection {spec.name} has dimension {found[0].dimension} and distance "
                f"{found[0].distance}, declared {spec.dimension} and {spec.distance}"
            )
        return catalog
    if not spec.auto_create:
        raise SpecError(f"collection {spec.name} is missing and may not be made")
    return catalog.unionByName(catalog_frame(catalog.sparkSession, [spec]))


def store_collection(spark: SparkSession, path: str, spec: CollectionSpec, fmt: str = "parquet") -> DataFrame:
    """The stored catalog with the collection in it; the catalog is made when it is missing."""
    schema = spark.createDataFrame([], CATALOG).schema
    catalog = ensure_table(spark, path, schema, fmt)
    grown = ensure_collection(catalog, spec)
    if grown is not catalog:
        write_append(catalog_frame(spark, [spec]), path, fmt)
    return spark.read.format(fmt).schema(schema).load(path)


def _azure_host(options: dict) -> str:
    return f"{options['account']}.dfs.core.windows.net"


def storage_root(backend: str, **options) -> str:
    """The URI that paths of a backend start with."""
    check_storage(backend, options)
    if backend == "azure":
        return f"abfss://{options['container']}@{_azure_host(options)}"
    return f"{'s3a' if backend == 's3' else 'gs'}://{options['bucket']}" if options.get("bucket") else ""


def storage_conf(backend: str, **options) -> dict[str, str]:
    """Hadoop settings of a storage backend, for ``spark.hadoop.*`` or read/write options.

    s3: region, endpoint, allow_http; azure: account, container; gcs: project.
    Credentials come from the environment, never from here.
    """
    check_storage(backend, options)
    conf: dict[str, str] = {}
    if backend == "s3":
        conf["fs.s3a.endpoint.region"] = options["region"]
        if options.get("endpoint"):
            conf["fs.s3a.endpoint"] = options["endpoint"]
            conf["fs.s3a.path.style.access"] = "true"
        if options.get("allow_http"):
            conf["fs.s3a.connection.ssl.enabled"] = "false"
    elif backend == "azure":
        conf[f"fs.azure.account.auth.type.{_azure_host(options)}"] = options.get("auth_type", "SharedKey")
    else:
        conf["fs.gs.project.id"] = options["project"]
    return conf
