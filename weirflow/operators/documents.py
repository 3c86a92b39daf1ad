"""Messages into documents of a document or time-series table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.ids import record_id
from weirflow.functions.variants import strict_json
from weirflow.operators.enrich import add_event_time, add_metadata_object

MODES = ("document", "time_series")


def to_documents(
    df: DataFrame,
    table: str,
    mode: str = "document",
    include_metadata: bool = True,
    payload: str = "payload",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Messages -> ``id, doc`` where doc is JSON text and id may be NULL.

    Time-series rows also get a real ``event_time TIMESTAMP`` column, which range
    filters prune on, besides the ``_timestamp`` text inside the document.
    """
    if mode not in MODES:
        raise ValueError(f"unknown storage mode {mode!r}")
    is_text = isinstance(df.schema[payload].dataType, T.StringType)
    shaped = df.withColumn("_doc", strict_json(F.col(payload)) if is_text else F.col(payload))
    if mode == "time_series":
        shaped = add_event_time(shaped, "_doc")
    if include_metadata:
        shaped = add_metadata_object(shaped, "_doc")
    columns = [record_id(F.col("attributes"), table).alias("id"), F.to_json("_doc").alias("doc")]
    if mode == "time_series":
        columns.append(F.timestamp_micros("publish_time_us").alias("event_time"))
    return shaped.select(*keep, *columns)


def time_range(df: DataFrame, start: str, end: str, col: str = "event_time") -> DataFrame:
    """Rows with ``start <= time < end``; a plain comparison, so it reaches the scan."""
    kind = df.schema[col].dataType.typeName()
    return df.where((F.col(col) >= F.lit(start).cast(kind)) & (F.col(col) < F.lit(end).cast(kind)))
