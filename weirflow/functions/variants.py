"""JSON text and VARIANT helpers. All are native expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MAP_OF_VARIANT = "map<string,variant>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often body uses it."""
    return F.transform(F.array(value), body)[0]


_END = "~end~"


def strict_json(text: Column) -> Column:
    """Parse JSON text to VARIANT, NULL unless the whole text is one JSON value.

    The built-in parser stops after the first value and ignores what follows. So the
    text is parsed as the first of two items of an array, ``[text,"~end~"]``: text
    after the value breaks the parse or moves the end mark. Only a text that closes
    the bracket itself and brings its own end mark could pass; where that is possible
    (it has a ``]``, and the mark or an escape that may spell it), a second parse as
    an object member, which no such text survives, decides.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))

    def has(part: str) -> Column:
        return F.contains(text, F.lit(part))

    # The repeated parse is one common subexpression of the generated projection.
    return F.when(
        (F.try_variant_get(in_array, "$[1]", "string") == _END)
        & F.variant_get(in_array, "$[2]", "variant").isNull()
        & (~has("]") | ~(has(_END) | has("\\")) | in_object.isNotNull()),
        F.variant_get(in_array, "$[0]", "variant"),
    )


def child(v: Column, key: str) -> Column:
    """Member ``key`` of an object; NULL when absent or when ``v`` is no object."""
    if "'" not in key and "\\" not in key:
        return F.variant_get(v, f"$['{key}']", "variant")
    if '"' not in key and "\\" not in key:
        return F.variant_get(v, f'$["{key}"]', "variant")
    # Keys that no path literal can hold are looked up in the object's map form.
    return F.when(is_object(v), F.try_element_at(v.cast(MAP_OF_VARIANT), F.lit(key)))


def at_path(v: Column, parts: Sequence[str]) -> Column:
    """Walk object members only; arrays are not entered and an explicit null stays."""
    if all("'" not in p and "\\" not in p for p in parts):
        return F.variant_get(v, "$" + "".join(f"['{p}']" for p in parts), "variant")
    for part in parts:
        v = child(v, part)
    return v


def json_path(v: Column, path: str) -> Column:
    """Dot-path lookup; dots inside a key cannot be written."""
    return at_path(v, path.split("."))


def schema_kind(v: Column) -> Column:
    """Spark's own type text of a VARIANT, e.g. BIGINT, DECIMAL(2,1), OBJECT<..>."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return schema_kind(v).startswith("OBJECT<")


def is_array(v: Column) -> Column:
    return schema_kind(v).startswith("ARRAY<")


def is_number_kind(kind: Column) -> Column:
    return (
        kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL(")
    )


def is_scalar_kind(kind: Column) -> Column:
    return kind.isin("STRING", "BOOLEAN") | is_number_kind(kind)


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def as_double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def as_items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def as_members(v: Column) -> Column:
    return F.try_variant_get(v, "$", MAP_OF_VARIANT)


def normal_number(v: Column, kind: Column) -> Column:
    """Numbers are 64-bit integers when they fit, else doubles."""
    return F.when(kind.startswith("DECIMAL("), as_double(v).cast("variant")).otherwise(v)
