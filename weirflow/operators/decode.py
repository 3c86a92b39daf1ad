"""Payload bytes to JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.variants import strict_json


def base64_text(data: Column) -> Column:
    """Standard base64 on one line (the built-in breaks lines after 76 characters)."""
    return F.translate(F.base64(data), "\r\n", "")


def wrap_bytes(data: Column) -> Column:
    """JSON text that carries bytes which are no JSON themselves."""
    return F.concat(
        F.lit('{"data":"'),
        base64_text(data),
        F.lit('","encoding":"base64","size":'),
        F.octet_length(data).cast("string"),
        F.lit("}"),
    )


def is_json_bytes(data: Column) -> Column:
    text = data.cast("string")
    return F.is_valid_utf8(text) & F.when(
        F.is_valid_utf8(text), strict_json(text).isNotNull()
    ).otherwise(False)


def decode_payload(data: Column) -> Column:
    """JSON text as it came if the bytes are one JSON value, else the wrapped bytes."""
    return F.when(is_json_bytes(data), data.cast("string")).otherwise(wrap_bytes(data))
