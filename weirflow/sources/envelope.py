"""The message row, and the sources that produce it.

Every function takes and returns a lazy DataFrame, so the same code runs over a
batch read and over ``readStream``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators.admit import admit_requests
from weirflow.operators.decode import decode_payload
from weirflow.operators.enrich import device_attributes, request_attributes
from weirflow.operators.routing import on_unrouted_rows, route_wildcard
from weirflow.specs import AdmissionSpec, Route

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("key", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("publish_time_us", T.LongType()),
        T.StructField("producer", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)


def as_envelope(
    df: DataFrame,
    *,
    topic: Column,
    payload: Column,
    publish_time_us: Column,
    key: Column | None = None,
    producer: Column | None = None,
    attributes: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Select message rows out of any DataFrame; ``keep`` carries more columns along."""
    given = {
        "topic": topic,
        "key": key,
        "payload": payload,
        "publish_time_us": publish_time_us,
        "producer": producer,
        "attributes": attributes,
    }
    columns = [
        (F.lit(None) if given[f.name] is None else given[f.name]).cast(f.dataType).alias(f.name)
        for f in ENVELOPE.fields
    ]
    return df.select(*keep, *columns)


def from_device_publishes(
    df: DataFrame,
    routes: Sequence[Route],
    include_metadata: bool = True,
    on_unrouted: str = "drop",
    hash_matches_parent: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Landed device publishes -> messages.

    Expects ``mqtt_topic, payload BINARY, qos, retain, dup, received_at``. The first
    matching route names the topic. Without metadata there are no attributes and no
    routing key.
    """
    routed = on_unrouted_rows(
        route_wildcard(df, routes, "mqtt_topic", hash_matches_parent=hash_matches_parent),
        "mqtt_topic",
        on_unrouted,
    )
    return as_envelope(
        routed,
        topic=F.col("to"),
        key=F.col("mqtt_topic") if include_metadata else None,
        payload=decode_payload(F.col("payload")),
        publish_time_us=F.unix_micros(F.col("received_at").cast("timestamp")),
        attributes=device_attributes() if include_metadata else F.create_map().cast(
            "map<string,string>"
        ),
        keep=keep,
    )


def from_http_requests(
    df: DataFrame,
    spec: AdmissionSpec,
    request_id: str = "request_id",
    keep: Sequence[str] = (),
    late: str | None = None,
) -> DataFrame:
    """Landed requests, a table or a stream -> messages of the requests that were admitted.

    Expects ``request_id, path, headers, body BINARY, received_at``. Rejected requests
    are what ``admit_requests`` gives with another status than 200.
    """
    admitted = admit_requests(df, spec, request_id=request_id, late=late).where("status = 200")
    return as_envelope(
        admitted,
        topic=F.col("to"),
        payload=decode_payload(F.col("body")),
        publish_time_us=F.unix_micros(F.col("received_at").cast("timestamp")),
        producer=F.lit(spec.source_name),
        attributes=request_attributes(spec.source_name),
        keep=keep,
    )


def read_jsonl(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Line-delimited JSON texts as column ``payload``; blank lines are skipped."""
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("text")
        .load(path)
        .where(F.rlike("value", F.lit(r"\S")))
        .select(F.col("value").alias("payload"))
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stored table."""
    return spark.read.format(fmt).options(**options).load(path)


def union_envelopes(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several sources as one message stream, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), others, first)
