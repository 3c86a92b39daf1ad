"""Message inputs derived from the stored tables, the same rows on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.sources import as_envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def device_publishes(events: DataFrame) -> DataFrame:
    """Events as device publishes; every tenth payload is no JSON."""
    raw = F.concat(F.lit("raw:"), "event_type")
    return events.select(
        "event_id",
        F.concat(
            F.lit("sensors/"), "event_type", F.lit("/zone"), (F.col("user_id") % 3).cast("string")
        ).alias("mqtt_topic"),
        F.when(F.col("event_id") % 10 == 0, raw).otherwise(F.col("props")).cast("binary").alias("payload"),
        (F.col("event_id") % 3).cast("int").alias("qos"),
        (F.col("event_id") % 2 == 0).alias("retain"),
        (F.col("event_id") % 7 == 0).alias("dup"),
        F.col("ts").alias("received_at"),
    )


def http_requests(events: DataFrame) -> DataFrame:
    """Events as requests with an address, an agent, a key and a body."""
    address = F.concat(F.lit("10.0."), (F.col("user_id") % 200).cast("string"), F.lit(".7"))
    headers = F.map_filter(
        F.create_map(
            F.lit("X-Api-Key"),
            F.when(F.col("event_id") % 11 != 0, F.when(F.col("event_id") % 13 == 0, "wrong").otherwise("s3cret")),
            F.lit("X-Forwarded-For"),
            F.when(F.col("user_id") % 2 == 0, F.concat(address, F.lit(" , 172.16.0.1"))),
            F.lit("X-Real-IP"),
            F.when(F.col("user_id") % 3 != 0, address),
            F.lit("User-Agent"),
            F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("agent/"), (F.col("user_id") % 4).cast("string"))),
            F.lit("Content-Type"),
            F.when(F.col("event_id") % 4 == 0, F.lit("text/plain")).otherwise(F.lit("application/json; charset=utf-8")),
        ),
        lambda _, v: v.isNotNull(),
    )
    return events.select(
        F.col("event_id").alias("request_id"),
        F.concat(F.lit("/webhooks/"), "event_type").alias("path"),
        headers.alias("headers"),
        F.encode(F.col("props"), "utf-8").alias("body"),
        F.col("ts").alias("received_at"),
    )


def rich_payload(events: DataFrame) -> DataFrame:
    """Add ``payload``: a nested JSON object built from the event's columns."""
    whole = F.when(F.col("event_id") % 6 != 0, F.col("value"))
    return events.withColumn(
        "payload",
        F.to_json(
            F.struct(
                F.struct(
                    F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("id"),
                    F.struct((F.col("event_id") % 5).alias("floor"), F.lit(None).cast("string").alias("room")).alias(
                        "place"
                    ),
                ).alias("device"),
                F.col("event_type").alias("kind"),
                whole.alias("value"),
                (F.col("event_id") % 130).alias("battery"),
                F.array(F.col("event_id") % 4, F.lit(None).cast("bigint")).alias("marks"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
            )
        ),
    )


def messages(events: DataFrame, payload: str = "props") -> DataFrame:
    """Events as messages; every fourth carries a record id."""
    attributes = F.map_filter(
        F.create_map(
            F.lit("origin"),
            F.lit("events"),
            F.lit("record_id"),
            F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        ),
        lambda _, v: v.isNotNull(),
    )
    return as_envelope(
        events,
        topic=F.concat(F.lit("/events/"), "event_type"),
        key=F.col("user_id").cast("string"),
        payload=F.col(payload),
        publish_time_us=F.unix_micros(F.col("ts").cast("timestamp")),
        producer=F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        attributes=attributes,
        keep=["event_id"],
    )


def vector_messages(embeddings: DataFrame) -> DataFrame:
    """Embeddings as vector messages: numeric, textual and missing ids in turn."""
    turn = F.col("vec_id") % 3
    id = F.when(turn == 0, F.col("vec_id").cast("string")).when(
        turn == 1, F.concat(F.lit("vec-"), F.col("vec_id").cast("string"))
    )
    body = F.to_json(
        F.struct(
            id.alias("id"),
            F.col("embedding").alias("vector"),
            F.struct(F.col("label").alias("label"), F.struct(F.lit("set-1").alias("name")).alias("source")).alias(
                "payload"
            ),
        )
    )
    return as_envelope(
        embeddings.withColumn("_body", body),
        topic=F.lit("/vectors/embeddings"),
        payload=F.col("_body"),
        publish_time_us=F.col("vec_id") + 1_700_000_000_000_000,
        producer=F.lit("encoder-1"),
        attributes=F.create_map(F.lit("model"), F.lit("m1")),
        keep=["vec_id"],
    )
