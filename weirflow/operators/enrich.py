"""Attributes and metadata that say where a message came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.headers import client_ip, header, normalize_headers
from weirflow.functions.ids import rfc3339
from weirflow.functions.variants import MAP_OF_VARIANT, as_members, is_object

META = "_msg_meta"
META_PREFIX = "_msg_"
EVENT_TIME = "_timestamp"


def device_attributes() -> Column:
    """Attributes of a device publish; every value is a string."""
    # Attribute names.
    return F.create_map(
        F.lit("mqtt.topic"),
        F.col("mqtt_topic"),
        F.lit("mqtt.qos"),
        F.col("qos").cast("string"),
        F.lit("mqtt.retain"),
        F.col("retain").cast("string"),
        F.lit("mqtt.dup"),
        F.col("dup").cast("string"),
        F.lit("source"),
        F.lit("mqtt"),
    )


def request_attributes(source_name: str) -> Column:
    """Attributes of a request; address, agent and content type only when present."""
    headers = normalize_headers(F.col("headers"))
    # Attribute names.
    every = F.create_map(
        F.lit("webhook.source"),
        F.lit(source_name),
        F.lit("webhook.endpoint"),
        F.col("path"),
        F.lit("webhook.timestamp"),
        rfc3339(F.unix_micros(F.col("received_at").cast("timestamp"))),
        F.lit("webhook.ip"),
        client_ip(headers),
        F.lit("webhook.user_agent"),
        header(headers, "user-agent"),
        F.lit("webhook.content_type"),
        header(headers, "content-type"),
    )
    return F.map_filter(every, lambda _, v: v.isNotNull())


def add_metadata_json(
    df: DataFrame, col: str = META, processed_at: Column | None = None
) -> DataFrame:
    """Add one JSON text column with topic, publish time and processing time."""
    now = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumn(
        col,
        F.to_json(
            F.struct(
                F.col("publish_time_us").alias("timestamp"),
                rfc3339(F.unix_micros(now)).alias("timestamp_iso"),
                F.col("topic").alias("topic"),
            )
        ),
    )


def put_member(v: Column, name: str, value: Column) -> Column:
    """The object ``v`` with member ``name`` set; other JSON kinds are left alone."""
    merged = F.map_concat(as_members(v), F.create_map(F.lit(name), value.cast("variant")))
    return F.when(is_object(v), F.to_variant_object(merged)).otherwise(v)


def add_metadata_object(df: DataFrame, col: str = "doc", name: str = META) -> DataFrame:
    """Put topic, publish time and producer as one nested object into VARIANT ``col``."""
    about = F.to_variant_object(
        F.struct(
            F.col("topic").alias("topic"),
            rfc3339(F.col("publish_time_us")).alias("timestamp"),
            F.col("producer").alias("producer"),
        )
    )
    return df.withColumn(col, put_member(F.col(col), name, about))


def add_event_time(df: DataFrame, col: str = "doc", name: str = EVENT_TIME) -> DataFrame:
    """Put the publish time as text into VARIANT ``col``, objects only."""
    return df.withColumn(col, put_member(F.col(col), name, rfc3339(F.col("publish_time_us"))))


def metadata_fields(prefix: str = META_PREFIX) -> Column:
    """Topic, publish time, producer and every attribute as flat payload fields."""
    base = F.create_map(
        F.lit(f"{prefix}topic"),
        F.col("topic").cast("variant"),
        F.lit(f"{prefix}timestamp"),
        F.col("publish_time_us").cast("variant"),
        F.lit(f"{prefix}producer"),
        F.col("producer").cast("variant"),
    )
    attributes = F.coalesce(F.col("attributes"), F.create_map().cast("map<string,string>"))
    named = F.transform_keys(attributes, lambda k, _: F.concat(F.lit(f"{prefix}attr_"), k))
    return F.map_concat(base, F.transform_values(named, lambda _, v: v.cast("variant")))


def add_metadata_fields(
    df: DataFrame, col: str = "payload_fields", prefix: str = META_PREFIX
) -> DataFrame:
    """Add the metadata fields to a flat payload; they replace fields of the same name."""
    own = F.coalesce(F.col(col), F.create_map().cast(MAP_OF_VARIANT))
    return df.withColumn(col, F.map_concat(own, metadata_fields(prefix)))
