"""JSON Schema checks compiled into column expressions.

A schema becomes one ``ARRAY<STRING>`` expression of error texts over a VARIANT, so
checking runs inside the scan stage: no per-row Python, no shuffle. The keywords are
those the message schemas use: type, required, properties, additionalProperties,
enum, const, pattern, minimum, maximum, format, items.type and minItems.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.headers import IPV4
from weirflow.functions.variants import (
    as_double,
    as_items,
    as_members,
    as_string,
    at_path,
    is_number_kind,
    let,
    schema_kind,
    strict_json,
)
from weirflow.operators.decode import is_json_bytes
from weirflow.operators.once import fence, with_once
from weirflow.operators.project import ERRORS, bad_rows, enforce, error_list, good_rows
from weirflow.specs import SpecError

# Keywords that only describe, and do not check.
_NOTES = {"$schema", "$id", "title", "description", "examples", "default"}
_CHECKS = {
    "type",
    "required",
    "properties",
    "additionalProperties",
    "enum",
    "const",
    "pattern",
    "minimum",
    "maximum",
    "format",
    "items",
    "minItems",
}

_DATE_TIME = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?"
    r"(?:[Zz]|[+-][0-9]{2}:[0-9]{2})\z"
)
_EMAIL = r"\A[^@\s]+@[^@\s.]+(?:\.[^@\s.]+)*\z"


def _end_strictly(pattern: str) -> str:
    """A closing ``$`` means the very end; Java's also stands before a final newline."""
    if pattern.endswith("$") and not pattern.endswith("\\$"):
        return pattern[:-1] + r"\z"
    return pattern


def _has_type(v: Column, kind: Column, name: str) -> Column:
    simple = {
        "string": kind == "STRING",
        "boolean": kind == "BOOLEAN",
        "null": kind == "VOID",
        "object": kind.startswith("OBJECT<"),
        "array": kind.startswith("ARRAY<"),
        "number": is_number_kind(kind),
    }
    if name in simple:
        return simple[name]
    if name == "integer":
        real = as_double(v)
        return (
            (kind == "BIGINT")
            | (kind.startswith("DECIMAL(") & kind.endswith(",0)"))
            | ((kind == "DOUBLE") & (real == F.floor(real)))
        )
    raise SpecError(f"unknown type {name!r} in schema")


def _compared(v: Column, kind: Column, bound: int | float, test: Callable[[Column, Column], Column]) -> Column:
    """A number against a bound; whole ones as integers, for doubles round above 2**53."""
    real = test(as_double(v), F.lit(float(bound)))
    if bound != int(bound) or abs(bound) >= 10**38:
        return real
    whole = (kind == "BIGINT") | (kind.startswith("DECIMAL(") & kind.endswith(",0)"))
    exact = test(F.try_variant_get(v, "$", "decimal(38,0)"), F.lit(str(int(bound))).cast("decimal(38,0)"))
    return F.when(whole, exact).otherwise(real)


def _equals(v: Column, kind: Column, wanted) -> Column:
    if isinstance(wanted, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(wanted))
    if wanted is None:
        return kind == "VOID"
    if isinstance(wanted, (int, float)):
        return is_number_kind(kind) & _compared(v, kind, wanted, lambda a, b: a == b)
    if isinstance(wanted, str):
        return (kind == "STRING") & (as_string(v) == F.lit(wanted))
    text = json.dumps(wanted, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return F.to_json(v) == F.to_json(F.parse_json(F.lit(text)))


def _one_of(v: Column, kind: Column, values: list) -> Column:
    texts = [x for x in values if isinstance(x, str)]
    hit = (kind == "STRING") & as_string(v).isin(texts) if texts else F.lit(False)
    for other in (x for x in values if not isinstance(x, str)):
        hit = hit | _equals(v, kind, other)
    return hit


def _format_ok(text: Column, name: str) -> Column | None:
    if name == "date-time":
        return F.rlike(text, F.lit(_DATE_TIME)) & F.upper(text).try_cast("timestamp").isNotNull()
    if name == "ipv4":
        return F.rlike(text, F.lit(rf"\A{IPV4}\z"))
    if name == "email":
        return F.rlike(text, F.lit(_EMAIL))
    return None


def _kind_checks(schema: dict, v: Column, kind: Column, where: str, assert_format: bool) -> Iterable[Column]:
    """Error texts (or NULL) of the keywords that look at this value only."""

    def fail(when: Column, message: str) -> Column:
        return F.when(when, F.lit(f"{where}: {message}"))

    if "type" in schema:
        names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        ok = F.lit(False)
        for name in names:
            ok = ok | _has_type(v, kind, name)
        yield fail(~ok, f"type is not {' or '.join(names)}")
    if "enum" in schema:
        yield fail(~_one_of(v, kind, schema["enum"]), "not an allowed value")
    if "const" in schema:
        yield fail(~_equals(v, kind, schema["const"]), "not the constant value")
    if "pattern" in schema:
        miss = ~F.rlike(as_string(v), F.lit(_end_strictly(schema["pattern"])))
        yield fail((kind == "STRING") & miss, "does not match the pattern")
    if "minimum" in schema:
        below = _compared(v, kind, schema["minimum"], lambda a, b: a < b)
        yield fail(is_number_kind(kind) & below, "below the minimum")
    if "maximum" in schema:
        above = _compared(v, kind, schema["maximum"], lambda a, b: a > b)
        yield fail(is_number_kind(kind) & above, "above the maximum")
    if assert_format and "format" in schema:
        ok = _format_ok(as_string(v), schema["format"])
        if ok is not None:
            yield fail((kind == "STRING") & ~ok, f"not a valid {schema['format']}")
    is_list = kind.startswith("ARRAY<")
    if "minItems" in schema:
        short = F.size(as_items(v)) < F.lit(int(schema["minItems"]))
        yield fail(is_list & short, f"fewer than {schema['minItems']} items")
    if "items" in schema:
        extra = set(schema["items"]) - _NOTES - {"type"}
        if extra:
            raise SpecError(f"unsupported keywords under items: {sorted(extra)}")
        if "type" in schema["items"]:
            wanted = schema["items"]["type"]
            bad = F.exists(as_items(v), lambda x: ~_has_type(x, schema_kind(x), wanted))
            yield fail(is_list & bad, f"an item is not {wanted}")


# Gives the value at a path and its kind; a value that is absent has neither.
Lookup = Callable[[tuple[str, ...]], tuple[Column, Column]]


def _checks(schema: dict, look: Lookup, path: tuple[str, ...], assert_format: bool) -> list[Column]:
    """Error texts of one (sub)schema; a value that is absent passes."""
    unknown = set(schema) - _NOTES - _CHECKS
    if unknown:
        raise SpecError(f"unsupported schema keywords: {sorted(unknown)}")
    where = ".".join(path) if path else "message"
    v, kind = look(path)
    # Absent values have a NULL kind, which makes every test below NULL: no error.
    found = list(_kind_checks(schema, v, kind, where, assert_format))
    is_object = kind.startswith("OBJECT<")
    for name in schema.get("required", []):
        label = ".".join([*path, name])
        missing = look((*path, name))[0].isNull()
        found.append(F.when(is_object & missing, F.lit(f"{label}: required")))
    properties = schema.get("properties", {})
    if schema.get("additionalProperties") is False:
        allowed = F.array(*[F.lit(p) for p in properties]).cast("array<string>")
        others = F.array_except(F.map_keys(as_members(v)), allowed)
        found.append(
            F.when(
                is_object & (F.size(others) > 0),
                F.concat(F.lit(f"{where}: unexpected "), F.array_join(others, ", ")),
            )
        )
    for name, sub in properties.items():
        found += _checks(sub, look, (*path, name), assert_format)
    return found


def compile_schema(schema: dict | str, v: Column, assert_format: bool = True) -> Column:
    """``ARRAY<STRING>`` of what is wrong with VARIANT ``v``; empty when it is valid."""

    def look(path: tuple[str, ...]) -> tuple[Column, Column]:
        value = at_path(v, path) if path else v
        return value, schema_kind(value)

    return _compiled(schema, v, look, assert_format)


def _compiled(schema: dict | str, v: Column, look: Lookup, assert_format: bool) -> Column:
    schema = json.loads(schema) if isinstance(schema, str) else schema
    found = error_list(*_checks(schema, look, (), assert_format))
    return F.when(v.isNull(), F.array(F.lit("message: not JSON"))).otherwise(found)


def check_schema(
    df: DataFrame,
    schema: dict | str,
    payload: str = "payload",
    assert_format: bool = True,
    errors: str = ERRORS,
) -> DataFrame:
    """Add the error array for the JSON (text or VARIANT) in ``payload``.

    The text is parsed once, and each value a check looks at is extracted once, in
    projections of their own that the checks then read.
    """
    is_text = isinstance(df.schema[payload].dataType, T.StringType)
    parsed = df.withColumn("_v", strict_json(F.col(payload)) if is_text else F.col(payload))
    names: dict[tuple[str, ...], str] = {}

    def look(path: tuple[str, ...]) -> tuple[Column, Column]:
        name = names.setdefault(path, f"_v{len(names)}")
        return F.col(name), F.col(f"{name}_kind")

    judged = _compiled(schema, F.col("_v"), look, assert_format)
    values = parsed.select(
        *df.columns, "_v", *[at_path(F.col("_v"), p).alias(n) if p else F.col("_v").alias(n) for p, n in names.items()]
    )
    kinds = values.select("*", *[schema_kind(F.col(n)).alias(f"{n}_kind") for n in names.values()])
    return fence(kinds.select(*df.columns, judged.alias(errors)), [errors])


def validate_primitive(df: DataFrame, schema_type: str | None, payload: str = "payload", errors: str = ERRORS) -> DataFrame:
    """Topic schemas without a schema text: string, number, bytes; None takes all.

    On BINARY payloads a string is valid UTF-8 and a number is a JSON number; on JSON
    text the parsed value must be a string or a number, and bytes takes anything.
    """
    raw = isinstance(df.schema[payload].dataType, T.BinaryType)
    col = F.col(payload)
    if schema_type in (None, "bytes"):
        ok = F.lit(True)
    elif schema_type == "string":
        ok = F.is_valid_utf8(col.cast("string")) if raw else schema_kind(strict_json(col)) == "STRING"
    elif schema_type == "number":
        number = let(schema_kind(strict_json(col.cast("string"))), is_number_kind)
        ok = is_json_bytes(col) & number if raw else number
    else:
        raise SpecError(f"unknown schema type {schema_type!r}")
    message = F.array(F.lit(f"message: not a {schema_type}"))
    passed = F.coalesce(ok, F.lit(False))
    found = F.when(passed, F.array().cast("array<string>")).otherwise(message)
    return with_once(df, **{errors: found})


def validate_split(
    df: DataFrame,
    schema: dict | str,
    payload: str = "payload",
    on_error: str = "quarantine",
    assert_format: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``_errors``).

    Both are filters over one plan. To store both sides use store_split, which checks
    every row once.
    """
    checked = check_schema(df, schema, payload, assert_format)
    if on_error == "quarantine":
        return good_rows(checked), bad_rows(checked)
    return enforce(checked, on_error), bad_rows(checked).limit(0)


def store_split(
    df: DataFrame,
    schema: dict | str,
    path: str,
    payload: str = "payload",
    assert_format: bool = True,
    fmt: str = "parquet",
) -> None:
    """All rows with ``_errors``, written in one pass as partitions ``valid=true`` and ``valid=false``."""
    checked = check_schema(df, schema, payload, assert_format)
    flagged = checked.withColumn("valid", F.size(ERRORS) == 0)
    flagged.write.format(fmt).partitionBy("valid").mode("overwrite").save(path)
