"""Vector messages into collection points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.ids import point_id
from weirflow.functions.variants import as_string, at_path, let, schema_kind, strict_json
from weirflow.operators.enrich import META_PREFIX, add_metadata_fields
from weirflow.operators.flatten import FLAT, with_flat
from weirflow.operators.once import fence
from weirflow.operators.project import ERRORS, error_list
from weirflow.specs import CollectionSpec

# Array kinds whose items are all numbers, or that have no items.
_NUMERIC_ARRAY = r"\AARRAY<(?:BIGINT|DOUBLE|FLOAT|VOID|DECIMAL\([0-9]+,[0-9]+\))>\z"


def parse_vector_message(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``msg_id``, ``vector ARRAY<FLOAT>``, ``msg_payload VARIANT`` and ``_errors``.

    ``id`` must be a string or null, ``vector`` an array of numbers without nulls;
    ``payload`` may be anything.
    """
    is_text = isinstance(df.schema[payload].dataType, T.StringType)
    v = strict_json(F.col(payload)) if is_text else F.col(payload)
    names = [c for c in df.columns if c != payload]
    parsed = df.select(*names, v.alias("_v")).select(
        *names,
        schema_kind(F.col("_v")).startswith("OBJECT<").alias("_is_object"),
        at_path(F.col("_v"), ["id"]).alias("_id"),
        at_path(F.col("_v"), ["vector"]).alias("_vector"),
        at_path(F.col("_v"), ["payload"]).alias("msg_payload"),
    )
    items = F.try_variant_get("_vector", "$", "array<double>")
    numbers = F.when(
        F.rlike(schema_kind(F.col("_vector")), F.lit(_NUMERIC_ARRAY)),
        let(items, lambda a: F.when(~F.exists(a, lambda x: x.isNull()), a)),
    )
    id_kind = schema_kind(F.col("_id"))
    typed = parsed.select(
        *names,
        "_is_object",
        F.coalesce(id_kind.isin("STRING", "VOID"), F.lit(True)).alias("_id_ok"),
        F.when(id_kind == "STRING", as_string(F.col("_id"))).alias("msg_id"),
        numbers.cast("array<float>").alias("vector"),
        "msg_payload",
    )
    errors = error_list(
        F.when(~F.coalesce("_is_object", F.lit(False)), F.lit("message: not an object")),
        F.when(~F.col("_id_ok"), F.lit("id: not a string")),
        F.when(F.col("vector").isNull(), F.lit("vector: not an array of numbers")),
    )
    made = ["msg_id", "vector", "msg_payload", ERRORS]
    return fence(typed.select(*names, *made[:-1], errors.alias(ERRORS)), made)


def check_dimension(df: DataFrame, dimension: int, vector: str = "vector") -> DataFrame:
    """Name a vector of another length in ``_errors`` (made when it is not there)."""
    prior = F.col(ERRORS) if ERRORS in df.columns else F.array().cast("array<string>")
    # Fixed value: message text.
    message = F.concat(
        F.lit(f"Vector dimension mismatch: expected {dimension}, got "),
        F.size(vector).cast("string"),
    )
    wrong = F.col(vector).isNotNull() & (F.size(vector) != dimension)
    return df.withColumn(
        ERRORS, F.when(wrong, F.array_append(prior, message)).otherwise(prior)
    )


def to_points(
    df: DataFrame,
    spec: CollectionSpec,
    payload: str = "payload",
    keep: tuple[str, ...] = (),
    prefix: str = META_PREFIX,
) -> DataFrame:
    """Messages -> points ``id, vector, payload_fields`` plus ``_errors``.

    ``payload_fields`` is the flat payload, with message metadata if the collection
    asks for it. There is no shuffle; payloads nested deeper than the native levels pass
    through Arrow batches.
    """
    parsed = check_dimension(parse_vector_message(df, payload), spec.dimension)
    good = parsed.withColumn("msg_payload", F.when(F.size(ERRORS) == 0, F.col("msg_payload")))
    flat = with_flat(good, "msg_payload", "payload_fields")
    points = flat.withColumn("payload_fields", F.coalesce("payload_fields", F.create_map().cast(FLAT)))
    if spec.include_metadata:
        points = add_metadata_fields(points, "payload_fields", prefix)
    return points.select(
        *keep,
        point_id(F.col("msg_id"), F.col("topic"), F.col("publish_time_us")).alias("id"),
        "vector",
        "payload_fields",
        ERRORS,
    )
