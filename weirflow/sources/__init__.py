"""Readers that turn landed data into message rows."""

from weirflow.sources.envelope import (
    ENVELOPE,
    as_envelope,
    from_device_publishes,
    from_http_requests,
    read_jsonl,
    read_table,
    union_envelopes,
)

__all__ = [
    "ENVELOPE",
    "as_envelope",
    "from_device_publishes",
    "from_http_requests",
    "read_jsonl",
    "read_table",
    "union_envelopes",
]
