"""JSON paths into declared, typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.variants import as_double, as_string, at_path, is_object, schema_kind, strict_json
from weirflow.operators.once import fence
from weirflow.specs import INT_RANGES, FieldMapping, SpecError

ERRORS = "_errors"

_WIDE = "decimal(38,0)"
_INT_TEXT = r"\A[+-]?0*[0-9]{1,38}\z"
_PADDING = r"\A([+-]?)0+(?=[0-9])"
_FLOAT_TEXT = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_DATE_TEXT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIME_TEXT = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"
)
_HEX_TEXT = r"\A(?:[0-9A-Fa-f]{2})*\z"


def error_list(*errors: Column) -> Column:
    """The error texts that are not NULL, as an array.

    The higher-order function keeps the projection out of whole-stage code on purpose:
    measured, one method with every check is too large for the JVM to compile, while
    the projection generator cuts it into small ones.
    """
    if not errors:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*errors))


def _matches(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(pattern))


def _whole_number(v: Column, kind: Column, low: int, high: int, out: T.DataType) -> Column:
    """Integral numbers and integral texts inside [low, high]."""
    long = F.try_variant_get(v, "$", "bigint")
    low_long, high_long = max(low, -(2**63)), min(high, 2**63 - 1)
    in_range = F.when(long.between(F.lit(low_long), F.lit(high_long)), long).cast(out)
    # The rarer forms: 1.0, 1e2, "1" and numbers beyond 64 bits.
    real = as_double(v)
    wide = (
        F.when(
            kind.startswith("DECIMAL(") & kind.endswith(",0)"), F.try_variant_get(v, "$", _WIDE)
        )
        .when((kind == "DOUBLE") & (real == F.floor(real)), real.try_cast(_WIDE))
        .when(
            (kind == "STRING") & _matches(as_string(v), _INT_TEXT),
            F.regexp_replace(as_string(v), _PADDING, "$1").try_cast(_WIDE),
        )
    )
    bounds = [F.lit(str(x)).cast(_WIDE) for x in (low, high)]
    return F.when(kind == "BIGINT", in_range).otherwise(
        F.when(wide.between(*bounds), wide).cast(out)
    )


def _real_number(v: Column, kind: Column, out: T.DataType) -> Column:
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL(")
    text = as_string(v)
    return (
        F.when(number, as_double(v))
        .when((kind == "STRING") & _matches(text, _FLOAT_TEXT), text.try_cast("double"))
        .cast(out)
    )


def typed_value(v: Column, kind: Column, data_type: str) -> Column:
    """A JSON value as the declared type, NULL when its kind or range does not fit."""
    out = FieldMapping("v", "v", data_type).spark_type
    text = F.when(kind == "STRING", as_string(v))
    if data_type == "Utf8":
        return text
    if data_type in INT_RANGES:
        return _whole_number(v, kind, *INT_RANGES[data_type], out)
    if data_type in ("Float32", "Float64"):
        return _real_number(v, kind, out)
    if data_type == "Boolean":
        return F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
    if data_type == "Timestamp":
        micros = F.timestamp_micros(F.try_variant_get(v, "$", "bigint"))
        return F.when(kind == "BIGINT", micros).when(
            _matches(text, _TIME_TEXT), text.try_cast("timestamp")
        )
    if data_type in ("Date32", "Date64"):
        return F.when(_matches(text, _DATE_TEXT), text.try_cast("date"))
    if data_type == "Binary":
        return F.when(_matches(text, _HEX_TEXT), F.unhex(text))
    raise SpecError(f"Unsupported data type: {data_type}")


def project_fields(
    df: DataFrame,
    mappings: Sequence[FieldMapping],
    payload: str = "payload",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One typed column per mapping, plus ``_errors ARRAY<STRING>``.

    The payload (JSON text, or VARIANT) is parsed once. A missing path and an explicit
    null both give NULL. A payload that is no JSON or no object, a value that does not fit
    its type, and a NULL in a required column are named in ``_errors``.
    """
    if not mappings:
        raise SpecError("no field mappings given")
    is_text = isinstance(df.schema[payload].dataType, T.StringType)
    parsed = strict_json(F.col(payload)) if is_text else F.col(payload)
    # A text that parses is an object if it starts like one: cheaper than its schema.
    starts = F.ltrim(F.col(payload), F.lit(" \t\r\n")).startswith("{") if is_text else is_object(F.col(payload))
    found = df.select(*keep, parsed.alias("_v"), F.coalesce(starts, F.lit(False)).alias("_starts"))
    trouble = F.when(F.col("_v").isNull(), F.lit("message: not JSON")).when(
        ~F.col("_starts"), F.lit("message: not an object")
    )
    found = found.select(
        *keep, trouble.alias("_trouble"), *[at_path(F.col("_v"), m.parts).alias(f"_v{i}") for i, m in enumerate(mappings)]
    )
    kinds = found.select("*", *[schema_kind(F.col(f"_v{i}")).alias(f"_k{i}") for i in range(len(mappings))])
    typed = kinds.select(
        *keep,
        "_trouble",
        *[f"_k{i}" for i in range(len(mappings))],
        *[
            typed_value(F.col(f"_v{i}"), F.col(f"_k{i}"), m.data_type).alias(m.column)
            for i, m in enumerate(mappings)
        ],
    )
    errors = []
    for i, m in enumerate(mappings):
        missing = F.col(f"_k{i}").isNull() | (F.col(f"_k{i}") == "VOID")
        bad = F.col(m.column).isNull() & ~missing
        errors.append(F.when(bad, F.lit(f"{m.column}: not {m.data_type}")))
        if not m.nullable:
            errors.append(F.when(missing, F.lit(f"{m.column}: required")))
    columns = [m.column for m in mappings]
    found = F.when(F.col("_trouble").isNotNull(), F.array("_trouble")).otherwise(error_list(*errors))
    judged = typed.select(*keep, *columns, found.alias(ERRORS))
    return fence(judged, [*columns, ERRORS])


def declared_schema(mappings: Sequence[FieldMapping], metadata_col: str | None = None) -> T.StructType:
    """The stored schema of a table with these mappings."""
    fields = [T.StructField(m.column, m.spark_type, m.nullable) for m in mappings]
    if metadata_col:
        fields.append(T.StructField(metadata_col, T.StringType(), False))
    return T.StructType(fields)


def good_rows(df: DataFrame, errors: str = ERRORS) -> DataFrame:
    return df.where(F.size(errors) == 0).drop(errors)


def bad_rows(df: DataFrame, errors: str = ERRORS) -> DataFrame:
    return df.where(F.size(errors) > 0)


def enforce(df: DataFrame, on_error: str = "quarantine", errors: str = ERRORS) -> DataFrame:
    """Apply an error rule to rows that carry an error array.

    'fail' stops the query at the first bad row, 'drop' leaves bad rows out, and
    'quarantine' keeps them with their reasons for a split by good_rows / bad_rows.
    """
    if on_error == "quarantine":
        return df
    if on_error == "drop":
        return good_rows(df, errors)
    if on_error == "fail":
        # The test is part of the kept column, so the optimizer cannot drop it.
        checked = F.when(
            F.size(errors) > 0, F.raise_error(F.concat_ws("; ", F.col(errors)))
        ).otherwise(F.col(errors))
        return df.withColumn(errors, checked).where(F.size(errors) == 0).drop(errors)
    raise SpecError(f"unknown on_error {on_error!r}")


def enforce_not_null(
    df: DataFrame, mappings: Sequence[FieldMapping], on_error: str = "quarantine"
) -> DataFrame:
    """Required columns of an already typed table: add ``_errors``, then apply the rule."""
    errors = [
        F.when(F.col(m.column).isNull(), F.lit(f"{m.column}: required"))
        for m in mappings
        if not m.nullable
    ]
    return enforce(df.withColumn(ERRORS, error_list(*errors)), on_error)
