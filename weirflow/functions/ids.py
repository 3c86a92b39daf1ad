"""Stable ids and RFC 3339 times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_TYPE = "decimal(20,0)"  # holds every unsigned 64-bit value
_MAX_U64 = str(2**64 - 1)


def hash_u64(text: Column) -> Column:
    """First eight bytes of SHA-256 as an unsigned big-endian number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast(ID_TYPE)


def parse_u64(text: Column) -> Column:
    """Unsigned 64-bit number, an optional ``+`` and leading zeros allowed, else NULL."""
    digits = F.regexp_replace(text, r"\A\+?0*(?=[0-9])", "")
    number = F.when(
        F.rlike(text, F.lit(r"\A\+?[0-9]+\z")) & (F.length(digits) <= 20),
        digits.try_cast(ID_TYPE),
    )
    return F.when(number <= F.lit(_MAX_U64).cast(ID_TYPE), number)


def point_id(id: Column, topic: Column, publish_time_us: Column) -> Column:
    """Numeric ids as they are, other ids hashed, no id: hash of topic and time."""
    key = F.coalesce(id, F.concat(topic, F.lit(":"), publish_time_us.cast("string")))
    return F.coalesce(parse_u64(id), hash_u64(key))


def record_id(attributes: Column, table: str | Column) -> Column:
    """``table:record_id`` from the message attribute, NULL when it is not set."""
    name = F.lit(table) if isinstance(table, str) else table
    return F.concat(name, F.lit(":"), F.try_element_at(attributes, F.lit("record_id")))


def rfc3339(micros: Column) -> Column:
    """UTC time text with 0, 3 or 6 fraction digits, whichever is exact."""
    ts = F.timestamp_micros(micros)
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = (
        F.when(micros % 1_000_000 == 0, F.lit(""))
        .when(micros % 1_000 == 0, F.date_format(ts, ".SSS"))
        .otherwise(F.date_format(ts, ".SSSSSS"))
    )
    return F.concat(base, fraction, F.lit("+00:00"))
