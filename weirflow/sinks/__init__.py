"""Writers: append, overwrite, upsert, insert, and fan-out to many tables."""

from weirflow.sinks.buckets import KeyedTable, compact_buckets, read_buckets, upsert_buckets
from weirflow.sinks.fanout import fan_out, write_partitioned
from weirflow.sinks.ledger import Ledger, Retry
from weirflow.sinks.tables import (
    catalog_frame,
    ensure_collection,
    ensure_table,
    insert_documents,
    latest_by_key,
    new_documents,
    read_latest,
    storage_conf,
    storage_root,
    store_collection,
    upsert_by_key,
    write_append,
    write_batch,
    write_overwrite,
    without_key,
)
from weirflow.sinks.timed import read_timed, write_timed

__all__ = [
    "KeyedTable",
    "Ledger",
    "Retry",
    "catalog_frame",
    "compact_buckets",
    "ensure_collection",
    "ensure_table",
    "fan_out",
    "insert_documents",
    "latest_by_key",
    "new_documents",
    "read_buckets",
    "read_latest",
    "read_timed",
    "storage_conf",
    "storage_root",
    "store_collection",
    "upsert_buckets",
    "upsert_by_key",
    "without_key",
    "write_append",
    "write_batch",
    "write_overwrite",
    "write_partitioned",
    "write_timed",
]
