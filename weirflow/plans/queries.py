"""The query registry: every operator over whole tables, with equivalent SQL.

Each query takes (spark, folder) and returns a DataFrame; ``ORACLES`` holds SQL that
gives the same rows over the same tables. Ids and times leave as numbers or text, and
no map, array or VARIANT column leaves a query, so results compare value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.headers import client_ip, normalize_headers
from weirflow.functions.ids import point_id, record_id
from weirflow.functions.topics import effective_reliable, valid_topic
from weirflow.functions.variants import as_double, as_string, at_path, child, json_path, strict_json
from weirflow.operators import (
    admit,
    decode,
    enrich,
    flatten,
    limit,
    pivots,
    points,
    project,
    registry,
    routing,
    search,
    sketches,
    stats,
    validate,
)
from weirflow.operators.documents import time_range, to_documents
from weirflow.operators.once import fence, with_once
from weirflow.plans import inputs
from weirflow.session import checkpoint_root, configure
from weirflow.sinks import (
    KeyedTable,
    Ledger,
    Retry,
    catalog_frame,
    compact_buckets,
    ensure_table,
    fan_out,
    insert_documents,
    new_documents,
    read_buckets,
    read_latest,
    read_timed,
    store_collection,
    upsert_buckets,
    upsert_by_key,
    write_append,
    write_batch,
    write_overwrite,
    write_partitioned,
    write_timed,
)
from weirflow.sinks.buckets import current_versions
from weirflow.sinks.fanout import FanOutError, table_writer
from weirflow.sources import (
    from_device_publishes,
    from_http_requests,
    read_jsonl,
    read_table,
    union_envelopes,
)
from weirflow.specs import (
    AdmissionSpec,
    CollectionSpec,
    Endpoint,
    FieldMapping,
    RateLimit,
    Route,
)
from weirflow.streaming import (
    Landing,
    batch_log,
    counted,
    counter_totals,
    rate_limit_stream,
    read_stream,
    run_batches,
    run_stream,
    run_with_retries,
    window_limit_stream,
)
from weirflow.streaming.run import partition_by_key

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL for the same rows if there is any."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(configure(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "events")


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt to all cores, for queries whose rows cost far more than their bytes: a small file is one task's."""
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream. The pattern takes a single file as well as a folder of files."""
    return read_stream(spark, f"{sf}/events.parque[t]", _events(spark, sf).schema)


def _joined(errors: str | Column = "_errors") -> Column:
    return F.array_join(errors, "; ")


def _store(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query that writes, in the shared folder of the session."""
    return f"{checkpoint_root(spark)}/weirflow/{name}-{uuid.uuid4().hex}"


# SQL fragments used more than once.
_US = "epoch_us(ts)"
_SECONDS = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
_RFC = f"""{_SECONDS} || CASE WHEN {_US} % 1000000 = 0 THEN ''
    WHEN {_US} % 1000 = 0 THEN '.' || lpad((({_US} // 1000) % 1000)::VARCHAR, 3, '0')
    ELSE '.' || lpad(({_US} % 1000000)::VARCHAR, 6, '0') END || '+00:00'"""
_DEVICE = "'sensors/' || event_type || '/zone' || (user_id % 3)"


# -- counts, filters, limits ---------------------------------------------------


@query("SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type")
def count_by_type(spark, sf):
    return stats.count_by(_events(spark, sf), "event_type")


@query("SELECT count(*)::BIGINT AS n FROM events")
def total_count(spark, sf):
    return stats.total_count(_events(spark, sf))


@query("SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1 ORDER BY n DESC, 1")
def value_counts(spark, sf):
    return stats.value_counts(_events(spark, sf), "event_type")


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def purchases_only(spark, sf):
    return _events(spark, sf).where("event_type = 'purchase'").select("event_id", "user_id", "value")


@query("SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 10")
def first_n(spark, sf):
    newest = _events(spark, sf).select("event_id", "event_type", "value", "ts")
    return newest.orderBy(F.desc("ts"), "event_id").limit(10).drop("ts")


@query(
    f"""SELECT event_id, {_US} AS event_us FROM events
    WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 12:00:00'"""
)
def time_range_rows(spark, sf):
    rows = time_range(_events(spark, sf), "2024-01-05 00:00:00", "2024-01-12 12:00:00", "ts")
    return rows.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("event_us"))


# -- routing -------------------------------------------------------------------

_EXACT = [
    Route("/events/click", "/tables/web"),
    Route("/events/view", "/tables/web"),
    Route("/events/purchase", "/tables/sales"),
]


@query(
    """SELECT CASE WHEN event_type IN ('click', 'view') THEN '/tables/web'
    WHEN event_type = 'purchase' THEN '/tables/sales' END AS "to", count(*)::BIGINT AS n
    FROM events GROUP BY 1"""
)
def route_exact_counts(spark, sf):
    messages = inputs.messages(_events(spark, sf)).select("topic")
    return stats.count_by(routing.route_exact(messages, _EXACT), "to")


@query(
    """SELECT event_id, '/events/' || event_type AS topic FROM events
    WHERE event_type NOT IN ('click', 'view', 'purchase')"""
)
def unrouted_messages(spark, sf):
    messages = inputs.messages(_events(spark, sf)).select("event_id", "topic")
    return routing.unrouted_messages(messages, _EXACT).select("event_id", "topic")


_WILDCARD = [
    Route("sensors/click/zone0", "/iot/one"),
    Route("sensors/+/zone1", "/iot/zone1"),
    Route("sensors/view/#", "/iot/views"),
    Route("sensors/+/+/+", "/iot/none"),
    Route("sensors/error", "/iot/none"),
]
_WILDCARD_SQL = f"""SELECT event_id, {_DEVICE} AS mqtt_topic,
    CASE WHEN event_type = 'click' AND user_id % 3 = 0 THEN '/iot/one'
    WHEN user_id % 3 = 1 THEN '/iot/zone1'
    WHEN regexp_full_match({_DEVICE}, 'sensors/view/.*') THEN '/iot/views' END AS "to"
    FROM events"""


@query(_WILDCARD_SQL)
def route_wildcard_first_match(spark, sf):
    devices = inputs.device_publishes(_events(spark, sf)).select("event_id", "mqtt_topic")
    return routing.route_wildcard(devices, _WILDCARD, "mqtt_topic")


@query(_WILDCARD_SQL)
def route_by_pattern_table(spark, sf):
    devices = inputs.device_publishes(_events(spark, sf)).select("event_id", "mqtt_topic")
    table = routing.routes_frame(spark, _WILDCARD)
    return routing.route_by_table(devices, table, "mqtt_topic").select("event_id", "mqtt_topic", "to")


@query(
    """SELECT page_id, regexp_replace(url, '^https?:/', '') AS topic,
    regexp_full_match(regexp_replace(url, '^https?:/', ''), '/[^/]+/[^/]+') AS valid FROM pages"""
)
def valid_topics(spark, sf):
    pages = inputs.table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("url", "^https?:/", "").alias("topic")
    )
    return pages.withColumn("valid", valid_topic(F.col("topic")))


@query(
    """SELECT event_id, CASE WHEN user_id % 4 = 0 THEN event_id % 2 = 0
    ELSE event_id % 3 <> 0 END AS reliable FROM events"""
)
def reliable_flag(spark, sf):
    explicit = F.when(F.col("user_id") % 4 == 0, F.col("event_id") % 2 == 0)
    reliable = effective_reliable((F.col("event_id") % 3).cast("int"), explicit)
    return _events(spark, sf).select("event_id", reliable.alias("reliable"))


# -- sources and decoding ------------------------------------------------------


@query(
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN
    '{"data":"' || base64(('raw:' || event_type)::BLOB) || '","encoding":"base64","size":' ||
    strlen('raw:' || event_type) || '}' ELSE props END AS payload FROM events"""
)
def decode_payload(spark, sf):
    devices = inputs.device_publishes(_events(spark, sf))
    return devices.select("event_id", decode.decode_payload(F.col("payload")).alias("payload"))


@query(
    """SELECT page_id, '{"data":"' || base64(encode(html)) || '","encoding":"base64","size":' ||
    strlen(html) || '}' AS payload FROM pages"""
)
def decode_pages(spark, sf):
    html = F.encode("html", "utf-8")
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", decode.decode_payload(html).alias("payload"))


@query(
    f"""SELECT event_id, CASE WHEN user_id % 3 = 1 THEN '/iot/zone1' ELSE '/iot/all' END AS topic,
    {_DEVICE} AS key, {_US} AS publish_time_us, (event_id % 3)::VARCHAR AS qos,
    CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS retain,
    CASE WHEN event_id % 7 = 0 THEN 'true' ELSE 'false' END AS dup, 'mqtt' AS source FROM events"""
)
def device_attributes(spark, sf):
    routes = [Route("sensors/+/zone1", "/iot/zone1"), Route("sensors/#", "/iot/all")]
    devices = inputs.device_publishes(_events(spark, sf))
    got = from_device_publishes(devices, routes, keep=["event_id"])
    return got.select(
        "event_id",
        "topic",
        "key",
        "publish_time_us",
        *[F.col("attributes")[f"mqtt.{n}"].alias(n) for n in ("qos", "retain", "dup")],
        F.col("attributes")["source"].alias("source"),
    )


_IP = "'10.0.' || (user_id % 200) || '.7'"


@query(
    f"""SELECT event_id AS request_id, name, value FROM (
    SELECT event_id, unnest(['webhook.source', 'webhook.endpoint', 'webhook.timestamp', 'webhook.ip',
        'webhook.user_agent', 'webhook.content_type']) AS name,
        unnest(['gate', '/webhooks/' || event_type, {_RFC},
        CASE WHEN user_id % 2 = 0 OR user_id % 3 <> 0 THEN {_IP} END,
        CASE WHEN user_id % 5 <> 0 THEN 'agent/' || (user_id % 4) END,
        CASE WHEN event_id % 4 = 0 THEN 'text/plain' ELSE 'application/json; charset=utf-8' END]) AS value
    FROM events) WHERE value IS NOT NULL"""
)
def request_attributes(spark, sf):
    requests = inputs.http_requests(_events(spark, sf))
    made = with_once(requests, attributes=enrich.request_attributes("gate"))
    return made.select("request_id", F.explode("attributes").alias("name", "value"))


@query(
    f"""SELECT event_id AS request_id,
    CASE WHEN user_id % 2 = 0 OR user_id % 3 <> 0 THEN {_IP} END AS ip,
    CASE WHEN user_id % 2 = 0 OR user_id % 3 <> 0 THEN {_IP} END AS strict_ip,
    event_id % 4 = 0 AS not_json FROM events"""
)
def client_ips(spark, sf):
    headers = normalize_headers(F.col("headers"))
    return inputs.http_requests(_events(spark, sf)).select(
        "request_id",
        client_ip(headers).alias("ip"),
        client_ip(headers, strict=True).alias("strict_ip"),
        admit.flag_content_type(headers).alias("not_json"),
    )


@query(
    f"""SELECT event_id AS request_id, CASE event_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN '300.1.2.3' WHEN 2 THEN {_IP} ELSE NULL END AS forwarded,
    CASE event_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN '300.1.2.3' WHEN 2 THEN {_IP}
        ELSE CASE WHEN event_id % 3 = 0 THEN '10.1' ELSE '::1' END END AS ip,
    CASE WHEN event_id % 4 = 2 THEN {_IP} WHEN event_id % 3 <> 0 THEN '::1' END AS strict_ip FROM events"""
)
def strict_client_ips(spark, sf):
    """Addresses that do not parse fall through to the next source, and to NULL, where one is needed."""
    address = F.concat(F.lit("10.0."), (F.col("user_id") % 200).cast("string"), F.lit(".7"))
    forwarded = F.get(F.array(F.lit("unknown"), F.lit("300.1.2.3"), address), (F.col("event_id") % 4).cast("int"))
    real = F.when(F.col("event_id") % 3 == 0, "10.1").otherwise("::1")
    sent = F.create_map(F.lit("X-Forwarded-For"), F.concat(forwarded, F.lit(", 10.9.9.9")), F.lit("X-Real-IP"), real)
    headers = normalize_headers(F.map_filter(sent, lambda _, v: v.isNotNull()))
    return _events(spark, sf).select(
        F.col("event_id").alias("request_id"),
        forwarded.alias("forwarded"),
        client_ip(headers).alias("ip"),
        client_ip(headers, strict=True).alias("strict_ip"),
    )


@query(
    f"""SELECT topic, count(*)::BIGINT AS n, sum(publish_time_us)::DECIMAL(38,0) AS us FROM (
    SELECT '/all/' || event_type AS topic, {_US} AS publish_time_us FROM events
    UNION ALL SELECT '/all/' || event_type, {_US} FROM events
    UNION ALL SELECT '/all/' || event_type, {_US} FROM events) GROUP BY topic"""
)
def union_sources(spark, sf):
    events = _events(spark, sf)
    kinds = ["click", "error", "purchase", "signup", "view"]
    devices = from_device_publishes(
        inputs.device_publishes(events), [Route(f"sensors/{k}/#", f"/all/{k}") for k in kinds]
    )
    requests = from_http_requests(
        inputs.http_requests(events),
        AdmissionSpec([Endpoint(f"/webhooks/{k}", f"/all/{k}") for k in kinds]),
    )
    messages = inputs.messages(events).drop("event_id")
    messages = messages.withColumn("topic", F.regexp_replace("topic", "^/events/", "/all/"))
    return (
        union_envelopes(devices, requests, messages)
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("publish_time_us").cast("decimal(28,0)")).alias("us"),
        )
    )


# -- projection, flattening ----------------------------------------------------


def _rich(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.rich_payload(_events(spark, sf)).select("event_id", "payload")


@query(
    """SELECT event_id, 'dev-' || user_id AS device, (event_id % 5)::VARCHAR AS floor,
    event_type AS kind, NULL::VARCHAR AS room, NULL::VARCHAR AS mark FROM events"""
)
def path_extract(spark, sf):
    v = strict_json(F.col("payload"))
    paths = {
        "device": "device.id",
        "floor": "device.place.floor",
        "kind": "kind",
        "room": "device.place.room",
        "mark": "marks.0",
    }
    parsed = _rich(spark, sf).select("event_id", v.alias("v"))
    return parsed.select(
        "event_id", *[as_string(json_path(F.col("v"), p)).alias(n) for n, p in paths.items()]
    )


_MAPPINGS = [
    FieldMapping("device.id", "device", "Utf8", False),
    FieldMapping("device.place.floor", "floor", "Int16"),
    FieldMapping("value", "value", "Float64", False),
    FieldMapping("battery", "battery", "Int8"),
    FieldMapping("at", "at", "Timestamp", False),
    FieldMapping("kind", "kind_number", "Int32"),
]
_PROJECTED = f"""SELECT event_id, 'dev-' || user_id AS device, (event_id % 5)::SMALLINT AS floor,
    CASE WHEN event_id % 6 <> 0 THEN value END AS value,
    CASE WHEN event_id % 130 <= 127 THEN (event_id % 130)::TINYINT END AS battery,
    {_SECONDS} AS "at",
    concat_ws('; ', CASE WHEN event_id % 6 = 0 THEN 'value: required' END,
        CASE WHEN event_id % 130 > 127 THEN 'battery: not Int8' END,
        'kind_number: not Int32') AS errors FROM events"""


@query(_PROJECTED)
def typed_projection(spark, sf):
    typed = project.project_fields(_rich(spark, sf), _MAPPINGS, keep=["event_id"])
    at = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss").alias("at")
    return typed.select("event_id", "device", "floor", "value", "battery", at, _joined().alias("errors"))


@query(
    """SELECT event_id, CASE WHEN event_id % 10 IN (0, 5) THEN NULL ELSE regexp_extract(props, '[0-9]+')::BIGINT END AS k,
    CASE event_id % 10 WHEN 0 THEN 'message: not JSON' WHEN 5 THEN 'message: not an object' ELSE '' END AS errors FROM events"""
)
def typed_projection_bad(spark, sf):
    """Payloads of which every tenth is no JSON, and every tenth no object."""
    kind = F.col("event_id") % 10
    payload = F.when(kind == 0, F.concat("props", F.lit("}"))).when(kind == 5, F.lit(" [1]")).otherwise(F.col("props"))
    rows = _events(spark, sf).select("event_id", payload.alias("payload"))
    typed = project.project_fields(rows, [FieldMapping("k", "k", "Int64")], keep=["event_id"])
    return typed.select("event_id", "k", _joined().alias("errors"))


@query(
    f"""SELECT errors = 'kind_number: not Int32' AS only_kind, count(*)::BIGINT AS n,
    round(sum(value), 2) AS total FROM ({_PROJECTED}) GROUP BY 1"""
)
def required_split(spark, sf):
    typed = project.project_fields(_rich(spark, sf), _MAPPINGS, keep=["event_id"])
    only = (_joined() == "kind_number: not Int32").alias("only_kind")
    return typed.groupBy(only).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    f"""SELECT event_id, name, value, number FROM (SELECT event_id,
    unnest(['device.id', 'device.place.floor', 'kind', 'battery', 'marks', 'at']) AS name,
    unnest(['"dev-' || user_id || '"', (event_id % 5)::VARCHAR, '"' || event_type || '"', (event_id % 130)::VARCHAR,
        '[' || (event_id % 4) || ']', '"' || {_SECONDS} || '"']) AS value, NULL::DOUBLE AS number FROM events)
    UNION ALL SELECT event_id, 'value', NULL, round(value, 6) FROM events WHERE event_id % 6 <> 0"""
)
def flatten_payload(spark, sf):
    events = inputs.rich_payload(_spread(_events(spark, sf)))
    parsed = events.select("event_id", strict_json(F.col("payload")).alias("v"))
    rows = flatten.with_flat(parsed, "v", "m").select("event_id", F.explode("m").alias("name", "v"))
    is_number = F.col("name") == "value"
    return rows.select(
        "event_id",
        "name",
        F.when(~is_number, F.to_json("v")).alias("value"),
        F.when(is_number, F.round(as_double(F.col("v")), 6)).alias("number"),
    )


@query(
    """SELECT event_id, 'top' || repeat('.a', (event_id % 100)::INTEGER) AS name, event_id::VARCHAR AS value FROM events
    UNION ALL SELECT event_id, 'list', '[1,"x"]' FROM events"""
)
def flatten_deep(spark, sf):
    """Objects nested 1 to 100 levels deep, the deeper ones finished outside the native levels."""
    depth = (F.col("event_id") % 100).cast("int")
    text = F.concat(
        F.lit('{"list":[1,{"q":1},"x",[2]],"none":null,"top":'), F.repeat(F.lit('{"a":'), depth),
        F.col("event_id").cast("string"), F.repeat(F.lit("}"), depth), F.lit("}"),
    )
    parsed = _spread(_events(spark, sf)).select("event_id", strict_json(text).alias("v"))
    rows = flatten.with_flat(parsed, "v", "m").select("event_id", F.explode("m").alias("name", "v"))
    return rows.select("event_id", "name", F.to_json("v").alias("value"))


# -- metadata, ids, documents, points ------------------------------------------


@query(
    f"""SELECT event_id, '{{"timestamp":' || {_US} || ',"timestamp_iso":"' || {_RFC} ||
    '","topic":"/events/' || event_type || '"}}' AS meta FROM events"""
)
def metadata_json(spark, sf):
    messages = inputs.messages(_events(spark, sf))
    # The processing time is set, so that a run can be compared with another.
    seen = F.timestamp_micros("publish_time_us")
    return enrich.add_metadata_json(messages, "meta", processed_at=seen).select("event_id", "meta")


@query(
    f"""SELECT event_id, '/events/' || event_type AS topic, {_RFC} AS at, 'user-' || user_id AS producer,
    regexp_extract(props, '[0-9]+') AS k FROM events"""
)
def metadata_object(spark, sf):
    docs = to_documents(inputs.messages(_events(spark, sf)), "events", keep=("event_id",))
    v = F.parse_json("doc")
    return docs.select(
        "event_id",
        as_string(at_path(v, ["_msg_meta", "topic"])).alias("topic"),
        as_string(at_path(v, ["_msg_meta", "timestamp"])).alias("at"),
        as_string(at_path(v, ["_msg_meta", "producer"])).alias("producer"),
        as_string(child(v, "k")).alias("k"),
    )


@query(
    f"""SELECT event_id, {_RFC} AS "_timestamp", {_US} AS event_us,
    CASE WHEN event_id % 4 = 0 THEN 'events:u' || user_id END AS id FROM events"""
)
def timeseries_timestamp(spark, sf):
    docs = to_documents(
        inputs.messages(_events(spark, sf)), "events", "time_series", False, keep=("event_id",)
    )
    return docs.select(
        "event_id",
        as_string(child(F.parse_json("doc"), "_timestamp")).alias("_timestamp"),
        F.unix_micros("event_time").alias("event_us"),
        "id",
    )


@query(
    f"""SELECT event_id, name, value FROM (SELECT event_id,
    unnest(['k', '_msg_topic', '_msg_timestamp', '_msg_producer', '_msg_attr_origin', '_msg_attr_record_id']) AS name,
    unnest([regexp_extract(props, '[0-9]+'), '"/events/' || event_type || '"', ({_US})::VARCHAR,
        '"user-' || user_id || '"', '"events"', CASE WHEN event_id % 4 = 0 THEN '"u' || user_id || '"' END]) AS value
    FROM events) WHERE value IS NOT NULL"""
)
def metadata_fields(spark, sf):
    messages = inputs.messages(_events(spark, sf))
    parsed = messages.withColumn("v", strict_json(F.col("payload")))
    flat = flatten.with_flat(parsed, "v", "payload_fields")
    full = fence(enrich.add_metadata_fields(flat), ["payload_fields"])
    rows = full.select("event_id", F.explode("payload_fields").alias("name", "v"))
    return rows.select("event_id", "name", F.to_json("v").alias("value"))


_HASH = "('0x' || substr(sha256({}), 1, 16))::UBIGINT::DECIMAL(20,0)"


@query(
    f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id::DECIMAL(20,0)
    WHEN doc_id % 3 = 1 THEN {_HASH.format("lang || '-' || text")}
    ELSE {_HASH.format("'/docs/' || source || ':' || n_chars")} END AS id FROM documents"""
)
def point_ids(spark, sf):
    turn = F.col("doc_id") % 3
    given = F.when(turn == 0, F.concat(F.lit("+00"), F.col("doc_id").cast("string"))).when(
        turn == 1, F.concat("lang", F.lit("-"), "text")
    )
    topic = F.concat(F.lit("/docs/"), "source")
    return inputs.table(spark, sf, "documents").select(
        "doc_id", point_id(given, topic, F.col("n_chars")).alias("id")
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'events:u' || user_id END AS id FROM events"""
)
def record_ids(spark, sf):
    messages = inputs.messages(_events(spark, sf))
    return messages.select("event_id", record_id(F.col("attributes"), "events").alias("id"))


@query(
    """SELECT vec_id, CASE WHEN label % 2 = 0 THEN 64 ELSE 60 END::INTEGER AS dims,
    CASE WHEN label % 2 = 0 THEN '' ELSE 'Vector dimension mismatch: expected 64, got 60' END AS errors
    FROM embeddings"""
)
def vector_dimension_split(spark, sf):
    cut = F.when(F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 60))
    vectors = inputs.table(spark, sf, "embeddings").withColumn("embedding", cut)
    parsed = points.parse_vector_message(inputs.vector_messages(vectors))
    checked = points.check_dimension(parsed, 64)
    return checked.select("vec_id", F.size("vector").alias("dims"), _joined().alias("errors"))


_POINT_ID = f"""CASE WHEN vec_id % 3 = 0 THEN vec_id::DECIMAL(20,0)
    WHEN vec_id % 3 = 1 THEN {_HASH.format("'vec-' || vec_id")}
    ELSE {_HASH.format("'/vectors/embeddings:' || (vec_id + 1700000000000000)")} END"""


def _points(spark: SparkSession, sf: str) -> DataFrame:
    messages = inputs.vector_messages(inputs.table(spark, sf, "embeddings"))
    return points.to_points(messages, CollectionSpec("embeddings", 64), keep=("vec_id",))


@query(
    f"""SELECT {_POINT_ID} AS id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total,
    label::VARCHAR AS label, 'set-1' AS source, '/vectors/embeddings' AS topic, 'm1' AS model, '' AS errors
    FROM embeddings"""
)
def vector_points(spark, sf):
    fields = {"label": "label", "source": "source.name", "topic": "_msg_topic", "model": "_msg_attr_model"}
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return _points(spark, sf).select(
        "id",
        F.round(total, 4).alias("total"),
        *[as_string(F.col("payload_fields")[f]).alias(n) for n, f in fields.items()],
        _joined().alias("errors"),
    )


# -- validation ----------------------------------------------------------------


def _checked(spark: SparkSession, sf: str, schema: dict) -> DataFrame:
    checked = validate.check_schema(_rich(spark, sf), schema)
    return checked.select("event_id", _joined().alias("errors"))


def _object(required: tuple[str, ...] = (), **properties) -> dict:
    return {"type": "object", "required": list(required), "properties": properties}


@query(
    """SELECT event_id, concat_ws('; ', CASE WHEN event_id % 6 = 0 THEN 'value: required' END,
    'room: required') AS errors FROM events"""
)
def validate_required(spark, sf):
    return _checked(spark, sf, _object(required=("kind", "value", "room")))


@query(
    """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'battery: type is not string; kind: type is not number'
    ELSE concat_ws('; ', CASE WHEN value <> floor(value) THEN 'value: type is not integer' END,
    'battery: type is not string', 'kind: type is not number') END AS errors FROM events"""
)
def validate_type(spark, sf):
    schema = _object(value={"type": "integer"}, battery={"type": "string"}, kind={"type": "number"})
    return _checked(spark, sf, schema)


@query(
    """SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view', 'signup')
    THEN 'kind: not an allowed value' ELSE '' END AS errors FROM events"""
)
def validate_enum(spark, sf):
    return _checked(spark, sf, _object(kind={"type": "string", "enum": ["click", "view", "signup", 7]}))


@query(
    """SELECT event_id, CASE WHEN event_type <> 'click' THEN 'kind: not the constant value'
    ELSE '' END AS errors FROM events"""
)
def validate_const(spark, sf):
    return _checked(spark, sf, _object(kind={"const": "click"}))


@query(
    """SELECT event_id, concat_ws('; ', CASE WHEN event_id % 130 < 10 THEN 'battery: below the minimum' END,
    CASE WHEN event_id % 130 > 100 THEN 'battery: above the maximum' END) AS errors FROM events"""
)
def validate_range(spark, sf):
    return _checked(spark, sf, _object(battery={"type": "number", "minimum": 10, "maximum": 100}))


@query(
    """SELECT event_id, CASE WHEN NOT regexp_matches('dev-' || user_id, '^dev-[0-9]{2,3}$')
    THEN 'device.id: does not match the pattern' ELSE '' END AS errors FROM events"""
)
def validate_pattern(spark, sf):
    return _checked(spark, sf, _object(device=_object(id={"type": "string", "pattern": "^dev-[0-9]{2,3}$"})))


@query(
    f"""SELECT event_id, concat_ws('; ', CASE WHEN event_id % 2 = 0 THEN 'ip: not a valid ipv4' END,
    CASE WHEN event_id % 3 = 0 THEN 'at: not a valid date-time' END,
    CASE WHEN event_id % 5 = 0 THEN 'mail: not a valid email' END) AS errors FROM events"""
)
def validate_format(spark, sf):
    """Good and bad values of each format."""

    def form(name):
        return {"type": "string", "format": name}

    n = F.col("event_id").cast("string")
    octet = F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 100 + 256).otherwise(F.col("event_id") % 256)
    body = F.struct(
        F.concat(F.lit("10.1.2."), octet.cast("string")).alias("ip"),
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("at"),
        F.concat(F.lit("u"), n, F.when(F.col("event_id") % 5 == 0, "").otherwise("@example.org")).alias("mail"),
    )
    rows = _events(spark, sf).select("event_id", F.to_json(body).alias("payload"))
    checked = validate.check_schema(rows, _object(ip=form("ipv4"), at=form("date-time"), mail=form("email")))
    return checked.select("event_id", _joined().alias("errors"))


@query(
    """SELECT event_id, 'message: unexpected at, marks' || CASE WHEN event_id % 6 <> 0 THEN ', value'
    ELSE '' END AS errors FROM events"""
)
def validate_extra_keys(spark, sf):
    schema = _object(device={}, kind={}, battery={}) | {"additionalProperties": False}
    return _checked(spark, sf, schema)


@query(
    """SELECT event_id, concat_ws('; ', CASE WHEN event_id % 4 < 2 THEN 'marks: fewer than 3 items' END,
    CASE WHEN event_id % 3 = 0 THEN 'marks: an item is not integer' END) AS errors FROM events"""
)
def validate_items(spark, sf):
    """Lists of 1 to 4 items, some with an item that is no integer."""
    last = F.when(F.col("event_id") % 3 == 0, "1.5").otherwise("7")
    items = F.concat(F.repeat(F.lit("2,"), (F.col("event_id") % 4).cast("int")), last)
    rows = _events(spark, sf).select("event_id", F.concat(F.lit('{"marks":['), items, F.lit("]}")).alias("payload"))
    schema = _object(marks={"type": "array", "items": {"type": "integer"}, "minItems": 3})
    return validate.check_schema(rows, schema).select("event_id", _joined().alias("errors"))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 1 THEN '' WHEN event_id % 3 = 0 THEN 'message: not the constant value; message: below the minimum'
    ELSE 'message: not the constant value; message: above the maximum' END AS errors FROM events"""
)
def validate_large_numbers(spark, sf):
    """Whole numbers that are one double, but not one number."""
    number = (F.lit(9007199254740992) + F.col("event_id") % 3).cast("string")
    rows = _events(spark, sf).select("event_id", number.alias("payload"))
    wanted = 9007199254740993
    checked = validate.check_schema(rows, {"const": wanted, "minimum": wanted, "maximum": wanted})
    return checked.select("event_id", _joined().alias("errors"))


@query(
    """SELECT event_id, concat_ws('; ', 'device.owner: required',
    CASE WHEN event_id % 5 > 3 THEN 'device.place.floor: above the maximum' END) AS errors FROM events"""
)
def validate_nested(spark, sf):
    place = _object(required=("floor",), floor={"type": "integer", "maximum": 3})
    return _checked(spark, sf, _object(device=_object(required=("id", "owner"), place=place)))


@query(
    """SELECT event_type, count(*) FILTER (WHERE event_id % 6 <> 0)::BIGINT AS valid,
    count(*) FILTER (WHERE event_id % 6 = 0)::BIGINT AS rejected FROM events GROUP BY 1"""
)
def validate_split_counts(spark, sf):
    rich = inputs.rich_payload(_events(spark, sf)).select("event_type", "payload")
    path = _store(spark, "split")
    validate.store_split(rich, _object(required=("value",)), path)
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("rejected")
    )


@query(
    """SELECT event_id, event_id % 4 <> 3 AS is_string, event_id % 4 = 1 AS is_number, true AS is_bytes FROM events"""
)
def validate_primitives(spark, sf):
    """Bytes that are an object, a number, plain text, or no UTF-8."""
    kind = F.col("event_id") % 4
    text = F.when(kind == 1, F.col("event_id").cast("string")).when(kind == 2, "plain").otherwise(F.col("props"))
    raw = F.when(kind == 3, F.unhex(F.lit("ff31"))).otherwise(F.encode(text, "utf-8"))
    df = _events(spark, sf).select("event_id", raw.alias("payload"))
    for name in ("string", "number", "bytes"):
        df = validate.validate_primitive(df, name, errors=f"_{name}")
    return df.select(
        "event_id", *[(F.size(f"_{k}") == 0).alias(f"is_{k}") for k in ("string", "number", "bytes")]
    )


@query(
    """SELECT subject, version, schema_json FROM (SELECT event_type AS subject, 'v' || k AS schema_json,
    (1 + row_number() OVER (PARTITION BY event_type ORDER BY first_id))::INTEGER AS version FROM (
        SELECT event_type, event_id % 3 AS k, min(event_id) AS first_id FROM events WHERE event_id % 3 <> 2 GROUP BY ALL))"""
)
def schema_offers(spark, sf):
    """Several texts offered for one subject: each becomes a version, the known one none."""
    events = _events(spark, sf)
    offered = events.select(
        "event_id", F.col("event_type").alias("subject"), F.lit("json_schema").alias("schema_type"),
        F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string")).alias("schema_json"),
    )
    known = offered.where("schema_json = 'v2'").select("subject", F.lit(1).alias("version"), "schema_type", "schema_json").distinct()
    return registry.register_schemas(known, offered, ["event_id"]).select("subject", "version", "schema_json")


# -- schema registry -----------------------------------------------------------


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as one registered schema version of its type."""
    return _events(spark, sf).select(
        F.col("event_type").alias("subject"),
        F.col("event_id").cast("int").alias("version"),
        F.lit("json_schema").alias("schema_type"),
        F.col("props").alias("schema_json"),
    )


def _picked_sql(where: str) -> str:
    return f"""SELECT event_type AS subject, max(event_id)::INTEGER AS version,
    arg_max(props, event_id) AS schema_json FROM events WHERE {where} GROUP BY 1"""


@query(_picked_sql("true"))
def schema_latest(spark, sf):
    return registry.resolve_schemas(_registry(spark, sf)).select("subject", "version", "schema_json")


@query(_picked_sql("event_id = 42"))
def schema_pinned(spark, sf):
    picked = registry.resolve_schemas(_registry(spark, sf), {"pinned": 42})
    return picked.select("subject", "version", "schema_json")


@query(_picked_sql("event_id >= 500"))
def schema_minimum(spark, sf):
    picked = registry.resolve_schemas(_registry(spark, sf), {"minimum": 500})
    return picked.select("subject", "version", "schema_json")


@query(
    """SELECT subject, version, schema_json FROM (
    SELECT event_type AS subject, max(event_id)::INTEGER + 1 AS version, '{"k": 1}' AS schema_json,
        arg_max(props, event_id) AS known FROM events GROUP BY 1
    UNION ALL SELECT DISTINCT lang, 1, '{"k": 1}', NULL FROM documents)
    WHERE known IS DISTINCT FROM schema_json"""
)
def schema_register(spark, sf):
    subjects = (
        _events(spark, sf)
        .select(F.col("event_type").alias("subject"))
        .unionByName(inputs.table(spark, sf, "documents").select(F.col("lang").alias("subject")))
        .distinct()
    )
    offered = subjects.select(
        "subject", F.lit("json_schema").alias("schema_type"), F.lit('{"k": 1}').alias("schema_json")
    )
    fresh = registry.register_schemas(_registry(spark, sf), offered)
    return fresh.select("subject", "version", "schema_json")


def _part_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Every part as a schema set for the topic of its brand and size."""
    return inputs.table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("idx"),
        F.concat(F.lit("/"), "p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("topic"),
        F.col("p_name").alias("subject"),
        F.lit("json_schema").alias("schema_type"),
    )


_PART_TOPIC = "'/' || p_brand || '/' || p_size"


@query(
    f"""SELECT p_partkey::INTEGER AS idx, {_PART_TOPIC} AS topic FROM part
    WHERE {_PART_TOPIC} NOT IN (SELECT {_PART_TOPIC} FROM part WHERE p_size > 25)"""
)
def schemas_without_route(spark, sf):
    routes = (
        inputs.table(spark, sf, "part")
        .where("p_size > 25")
        .select(F.concat(F.lit("/"), "p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("to"))
    )
    return registry.schemas_without_route(_part_schemas(spark, sf), routes).select("idx", "topic")


@query(
    f"""SELECT t.topic, s.subject FROM (SELECT DISTINCT '/' || p_brand || '/' || (p_size + 10) AS topic FROM part) t
    LEFT JOIN (SELECT {_PART_TOPIC} AS topic, arg_min(p_name, p_partkey) AS subject FROM part GROUP BY 1) s
    USING (topic)"""
)
def schema_for_topics(spark, sf):
    bigger = F.concat(F.lit("/"), "p_brand", F.lit("/"), (F.col("p_size") + 10).cast("string"))
    topics = inputs.table(spark, sf, "part").select(bigger.alias("topic")).distinct()
    return registry.schema_for_topics(topics, _part_schemas(spark, sf)).select("topic", "subject")


# -- admission and rate limits -------------------------------------------------


def _admission(limiter: str, rate: RateLimit | None = None) -> AdmissionSpec:
    kinds = ("click", "error", "purchase", "view")
    return AdmissionSpec(
        [Endpoint(f"/webhooks/{k}", f"/in/{k}") for k in kinds],
        auth="apikey",
        header="X-API-Key",
        secret="s3cret",
        max_body_size=8,
        rate_limit=rate,
        limiter=limiter,
    )


_ADMIT = """CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 401
    WHEN {over} THEN 429 WHEN event_type = 'signup' THEN 404
    WHEN strlen(props) > 8 THEN 413 ELSE 200 END::INTEGER"""
_ADMIT_ERROR = """CASE WHEN event_id % 11 = 0 THEN 'Missing x-api-key header'
    WHEN event_id % 13 = 0 THEN 'Invalid API key'
    WHEN {over} THEN 'Rate limit exceeded for endpoint: /webhooks/' || event_type
    WHEN event_type = 'signup' THEN 'Endpoint not found: /webhooks/signup'
    WHEN strlen(props) > 8 THEN 'Payload size ' || strlen(props) || ' exceeds maximum 8' END"""


@query(
    f"""SELECT event_id AS request_id, {_ADMIT.format(over="false")} AS status,
    {_ADMIT_ERROR.format(over="false")} AS error FROM events"""
)
def admission_status(spark, sf):
    requests = inputs.http_requests(_events(spark, sf))
    return admit.admit_requests(requests, _admission("off")).select("request_id", "status", "error")


@query(
    f"""SELECT event_id AS request_id, {_ADMIT.format(over="place > 1")} AS status,
    {_ADMIT_ERROR.format(over="place > 1")} AS error FROM (
    SELECT *, CASE WHEN event_type <> 'signup' AND event_id % 11 <> 0 AND event_id % 13 <> 0 THEN
    row_number() OVER (PARTITION BY event_type, date_trunc('second', ts),
        event_id % 11 <> 0 AND event_id % 13 <> 0 ORDER BY ts, event_id) ELSE 0 END AS place FROM events)"""
)
def admission_window(spark, sf):
    requests = inputs.http_requests(_events(spark, sf))
    judged = admit.admit_requests(requests, _admission("window", RateLimit(1, 1)))
    return judged.select("request_id", "status", "error")


def _bucket_cte(name: str, rows: str, key: str, period_us: int, burst: int) -> str:
    """``rows`` (with event_id and t) judged by a bucket per key, one step per event."""
    room = (burst - 1) * period_us
    return f"""{name}_o AS MATERIALIZED (SELECT {key} AS key, event_id, t,
        row_number() OVER (PARTITION BY {key} ORDER BY t, event_id) AS n FROM {rows}),
    {name} AS (
        SELECT key, event_id, n, true AS allowed, t + {period_us} AS tat FROM {name}_o WHERE n = 1
        UNION ALL
        SELECT o.key, o.event_id, o.n, r.tat - o.t <= {room},
            CASE WHEN r.tat - o.t <= {room} THEN greatest(r.tat, o.t) + {period_us} ELSE r.tat END
        FROM {name} r JOIN {name}_o o ON o.key = r.key AND o.n = r.n + 1)"""


# Time runs 20,000 times faster, so that a second holds many requests.
_FASTER = 20_000
_ADDRESS = "CASE WHEN user_id % 2 = 0 OR user_id % 3 <> 0 THEN '10.0.' || (user_id % 200) || '.7' END"
_CHAIN = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT *, {_US} // {_FASTER} AS t, {_ADDRESS} AS address FROM events),
    {_bucket_cte("first", "(SELECT * FROM e WHERE event_type <> 'signup' AND event_id % 11 <> 0 AND event_id % 13 <> 0)",
                 "event_type", 100_000, 4)},
    {_bucket_cte("second", "(SELECT e.* FROM e JOIN first f USING (event_id) WHERE f.allowed AND address IS NOT NULL)",
                 "address", 500_000, 4)}"""


_ADMISSION_CHAIN = f"""{_CHAIN} SELECT event_id AS request_id, {_ADMIT.format(over="NOT coalesce(f.allowed, true) OR NOT coalesce(s.allowed, true)")}
    AS status, CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 AND NOT s.allowed
    THEN 'Rate limit exceeded for IP: ' || address ELSE {_ADMIT_ERROR.format(over="NOT coalesce(f.allowed, true)")} END AS error
    FROM e LEFT JOIN first f USING (event_id) LEFT JOIN second s USING (event_id)"""


def _faster_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = inputs.http_requests(_events(spark, sf))
    faster = F.floor(F.unix_micros(F.col("received_at").cast("timestamp")) / _FASTER).cast("bigint")
    return requests.withColumn("received_at", F.timestamp_micros(faster))


@query(_ADMISSION_CHAIN)
def admission_bucket(spark, sf):
    """A bucket for each endpoint, then one for each address over all endpoints."""
    requests = _faster_requests(spark, sf)
    spec = _admission("bucket", RateLimit(10, 4, per_ip=True, per_ip_rps=2))
    return admit.admit_requests(requests, spec).select("request_id", "status", "error")


@query(
    """SELECT event_id, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
    ORDER BY ts, event_id) <= 2 AS allowed FROM events"""
)
def rate_limit_window(spark, sf):
    events = _events(spark, sf).select("event_id", "event_type", "ts")
    judged = limit.rate_limit_window(events, ["event_type"], "ts", "event_id", 2, unit="hour")
    return judged.select("event_id", "allowed")


def _bucket_sql(key: str, period_us: int, burst: int) -> str:
    """The bucket as one step per event of each key."""
    room = (burst - 1) * period_us
    return f"""WITH RECURSIVE o AS MATERIALIZED (
        SELECT {key} AS key, event_id, {_US} AS t,
            row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS n FROM events),
    run AS (
        SELECT key, event_id, n, true AS allowed, t + {period_us} AS tat FROM o WHERE n = 1
        UNION ALL
        SELECT o.key, o.event_id, o.n, r.tat - o.t <= {room},
            CASE WHEN r.tat - o.t <= {room} THEN greatest(r.tat, o.t) + {period_us} ELSE r.tat END
        FROM run r JOIN o ON o.key = r.key AND o.n = r.n + 1)
    SELECT event_id, allowed FROM run"""


@query(_bucket_sql("user_id", 36 * 3600 * 1_000_000, 3))
def rate_limit_bucket(spark, sf):
    """Three events at once, then one in 36 hours, per user."""
    events = _events(spark, sf).select("event_id", "user_id", "ts")
    return limit.rate_limit(
        events, ["user_id"], "ts", "event_id", 1, 3, per_seconds=36 * 3600, chunk_seconds=24 * 3600
    )


@query(_bucket_sql("event_type", 600 * 1_000_000, 5))
def rate_limit_bucket_hot(spark, sf):
    """Few keys with many events each: the buckets are cut by count."""
    events = _events(spark, sf).select("event_id", "event_type", "ts")
    return limit.rate_limit(
        events, ["event_type"], "ts", "event_id", 1, 5, per_seconds=600, chunk_events=400
    )


# -- sinks ---------------------------------------------------------------------


@query(
    """SELECT c_custkey AS id, coalesce(o.seq, 0)::BIGINT AS seq, coalesce(o.amount, c_acctbal) AS amount
    FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS seq,
        arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS amount FROM orders GROUP BY 1) o
    ON o_custkey = c_custkey
    UNION ALL SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)),
        arg_max(o_totalprice, (o_orderdate, o_orderkey)) FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1"""
)
def upsert_latest(spark, sf):
    target = inputs.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.lit(0).cast("bigint").alias("seq"),
        F.col("c_acctbal").alias("amount"),
        F.lit(None).cast("timestamp_ntz").alias("at"),
    )
    batch = inputs.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("at"),
    )
    return upsert_by_key(target, batch, ["id"], ["at", "seq"]).drop("at")


def _documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    stored = inputs.table(spark, sf, "customer").select(
        F.concat(F.lit("events:u"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("doc"),
        F.lit(-1).cast("bigint").alias("event_id"),
    )
    fresh = to_documents(
        inputs.messages(_events(spark, sf)), "events", include_metadata=False, keep=("event_id",)
    )
    return stored, fresh.select("id", "doc", "event_id")


def _shown(docs: DataFrame) -> DataFrame:
    given = F.when(F.rlike("id", F.lit(r"\Aevents:u[0-9]+\z")), F.col("id"))
    return docs.select(given.alias("id"), "event_id", F.col("id").isNotNull().alias("has_id"))


_UNNAMED = "UNION ALL SELECT NULL, event_id, true FROM events WHERE event_id % 4 <> 0"


@query(
    f"""SELECT 'events:u' || c_custkey AS id, -1::BIGINT AS event_id, true AS has_id FROM customer
    UNION ALL SELECT 'events:u' || user_id, min(event_id), true FROM events
    WHERE event_id % 4 = 0 AND user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY 1 {_UNNAMED}"""
)
def insert_keep_first(spark, sf):
    stored, fresh = _documents(spark, sf)
    return _shown(insert_documents(stored, fresh, "events", ["event_id"]))


@query(
    f"""SELECT 'events:u' || c_custkey AS id, -1::BIGINT AS event_id, true AS has_id FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_id % 4 = 0)
    UNION ALL SELECT 'events:u' || user_id, max(event_id), true FROM events
    WHERE event_id % 4 = 0 GROUP BY 1 {_UNNAMED}"""
)
def insert_keep_last(spark, sf):
    stored, fresh = _documents(spark, sf)
    return _shown(insert_documents(stored, fresh, "events", ["event_id"], on_conflict="keep_last"))


@query(
    """SELECT CASE WHEN event_type = 'purchase' THEN 'sales' ELSE 'web' END AS target,
    count(*)::BIGINT AS n, sum(regexp_extract(props, '[0-9]+')::BIGINT)::BIGINT AS total
    FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1"""
)
def fan_out_tables(spark, sf):
    root = _store(spark, "fan_out")
    names = {"/events/click": "web", "/events/view": "web", "/events/purchase": "sales"}
    # Clicks and views feed one table.
    routes = [Route(topic, f"{root}/{name}") for topic, name in names.items()]
    mapping = [FieldMapping("k", "k", "Int64", False)]
    declared = project.declared_schema(mapping).add("topic", "string")

    def shape(route, rows):
        return project.good_rows(project.project_fields(rows, mapping, keep=["topic"]))

    messages = inputs.messages(_events(spark, sf)).select("topic", "payload")
    # The batch is stored twice, as a replay would.
    for _ in range(2):
        fan_out(messages, routes, table_writer(shape, 0, declared=declared), 0, "drop")
    stored = union_envelopes(
        *[spark.read.parquet(f"{root}/{name}").withColumn("target", F.lit(name)) for name in ("web", "sales")]
    )
    return stored.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query(
    """SELECT '/tables/' || CASE WHEN event_type = 'purchase' THEN 'sales' ELSE 'web' END AS "to",
    count(*)::BIGINT AS n FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1"""
)
def partitioned_targets(spark, sf):
    path = _store(spark, "partitioned")
    messages = inputs.messages(_events(spark, sf)).select("topic", "payload")
    write_partitioned(messages, _EXACT, path, batch_id=0)
    return stats.count_by(spark.read.parquet(path), "to")


@query(
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id,
    arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1"""
)
def upsert_on_read(spark, sf):
    path = _store(spark, "upserts")
    events = _events(spark, sf).select("user_id", "event_id", "value", "ts")
    # The second batch repeats the first, as a replay would.
    for batch in (0, 1, 1):
        write_batch(events, path, batch)
    return read_latest(spark, path, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


_NEWEST = "(event_id % 3, ts, event_id)"


@query(
    f"""SELECT user_id, arg_max(event_id, {_NEWEST}) AS event_id, arg_max(value, {_NEWEST}) AS value
    FROM events GROUP BY 1"""
)
def upsert_in_place(spark, sf):
    """Three batches into a table in buckets, the last one twice, and compacted."""
    table = KeyedTable(_store(spark, "buckets"), ["user_id"], ["ts", "event_id"], buckets=16)
    events = _events(spark, sf).select("user_id", "event_id", "value", "ts")
    for batch in (0, 1, 2, 2):
        upsert_buckets(table, events.where(F.col("event_id") % 3 == batch), batch)
    compact_buckets(spark, table)
    return read_buckets(spark, table).select("user_id", "event_id", "value")


@query(
    """SELECT (user_id % 64)::INTEGER AS bucket, CASE WHEN user_id % 64 = 5 THEN 1 ELSE 0 END::BIGINT AS version,
    count(DISTINCT user_id)::BIGINT AS n FROM events GROUP BY 1, 2"""
)
def upsert_touched_buckets(spark, sf):
    """A batch with the keys of one bucket in 64: the version of every bucket, and its rows."""
    bucket = (F.col("user_id") % 64).cast("int")
    table = KeyedTable(_store(spark, "touched"), ["user_id"], ["ts", "event_id"], buckets=64, bucket=bucket)
    events = _events(spark, sf).select("user_id", "event_id", "ts")
    upsert_buckets(table, events, 0)
    upsert_buckets(table, events.where(bucket == 5), 1)
    versions = spark.createDataFrame(list(current_versions(spark, table)[1].items()), "bucket int, version bigint")
    rows = read_buckets(spark, table).withColumn("bucket", bucket)
    return rows.join(versions, "bucket").groupBy("bucket", "version").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT CASE WHEN event_type = 'purchase' THEN 'sales' ELSE 'web' END AS target, 'stored' AS state,
    CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS writes, count(*)::BIGINT AS n
    FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1, 3"""
)
def fan_out_ledger(spark, sf):
    """A batch one of whose targets fails: the second run writes that target only."""
    root, writes = _store(spark, "ledger"), []
    names = {"/events/click": "web", "/events/view": "web", "/events/purchase": "sales"}
    routes = [Route(topic, f"{root}/{name}") for topic, name in names.items()]
    ledger = Ledger(f"{root}/entries")
    inner = table_writer(lambda route, rows: rows.select("topic", "payload"), 0)

    def write(target, parts):
        writes.append(target)
        if target.endswith("sales") and writes.count(target) == 1:
            raise OSError("the store went away")
        inner(target, parts)

    messages = inputs.messages(_events(spark, sf)).select("topic", "payload")
    try:
        fan_out(messages, routes, write, 0, "drop", ledger=ledger, retry=Retry(1))
    except FanOutError:
        fan_out(messages, routes, write, 0, "drop", ledger=ledger)
    tried = spark.createDataFrame([(t, writes.count(t)) for t in sorted(set(writes))], "target string, writes int")
    rows = union_envelopes(*[spark.read.parquet(f"{root}/{n}").withColumn("target", F.lit(f"{root}/{n}")) for n in ("web", "sales")])
    counts = rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    found = ledger.entries(spark).join(counts, "target").join(tried, "target")
    return found.select(F.element_at(F.split("target", "/"), -1).alias("target"), "state", "writes", "n")


@query("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 18:30:00'")
def time_buckets(spark, sf):
    """A range of time from a table in buckets of days: Spark reads the days that overlap it."""
    path = _store(spark, "timed")
    write_timed(_events(spark, sf).select("event_id", "value", "ts"), path, "ts")
    return read_timed(spark, path, "ts", "2024-01-05 06:00:00", "2024-01-09 18:30:00").select("event_id", "value")


@query(
    """SELECT event_id, '/events/' || event_type AS topic, regexp_extract(props, '[0-9]+')::INTEGER AS k
    FROM events"""
)
def stream_to_table(spark, sf):
    """Events followed as a stream: routed, typed and stored by micro-batch."""
    path = _store(spark, "streamed")
    typed = project.project_fields(
        inputs.messages(_event_stream(spark, sf)), [FieldMapping("k", "k", "Int32", False)], keep=["event_id", "topic"]
    )
    run_stream(
        project.good_rows(typed),
        lambda rows, batch: write_batch(rows, f"{path}/table", batch),
        f"stream_to_table-{uuid.uuid4().hex}",
        checkpoint=f"{path}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{path}/table").select("event_id", "topic", "k")


@query(
    """SELECT event_id, regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events WHERE event_id % 7 <> 0"""
)
def jsonl_messages(spark, sf):
    """Events landed as lines of JSON, every seventh line blank, and read back."""
    path = _store(spark, "lines")
    line = F.to_json(F.struct("event_id", F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k")))
    blank = F.when(F.col("event_id") % 7 == 0, F.lit("  ")).otherwise(line)
    _events(spark, sf).select(blank.alias("value")).write.text(path)
    mappings = [FieldMapping("event_id", "event_id", "Int64", False), FieldMapping("k", "k", "Int64", False)]
    return project.good_rows(project.project_fields(read_jsonl(spark, path), mappings))


@query(
    """SELECT 'appended' AS kept, 2 * count(*)::BIGINT AS n, 2 * sum(o_orderkey)::BIGINT AS total FROM orders
    UNION ALL SELECT 'overwritten', count(*)::BIGINT, sum(o_orderkey)::BIGINT FROM orders"""
)
def append_and_overwrite(spark, sf):
    """The same batch appended twice to one table and written over another twice."""
    path = _store(spark, "modes")
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    ensure_table(spark, f"{path}/appended", orders.schema)
    for _ in range(2):
        write_append(orders, f"{path}/appended")
        write_overwrite(orders, f"{path}/overwritten")
    both = union_envelopes(
        *[
            read_table(spark, f"{path}/{name}").withColumn("kept", F.lit(name))
            for name in ("appended", "overwritten")
        ]
    )
    return both.groupBy("kept").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("total"))


def _landed(df: DataFrame, path: str, files: int = 4) -> None:
    """The rows as files in the order of ``received_at`` or ``ts``, which a stream takes one after the other."""
    at = F.col("received_at" if "received_at" in df.columns else "ts")
    span = df.agg(F.min(at), F.max(at)).first()
    edges = [span[0] + (span[1] - span[0]) * k / files for k in range(1, files)]
    part = sum(((at >= F.lit(e)).cast("int") for e in edges), F.lit(0))
    for k in range(files):
        df.where(part == k).coalesce(1).write.mode("append").parquet(path)


def _streamed(df: DataFrame, path: str, name: str) -> DataFrame:
    """What a stream stores until its input is read."""
    run_stream(
        df, lambda rows, batch: write_batch(rows, f"{path}/table", batch), f"{name}-{uuid.uuid4().hex}", checkpoint=f"{path}/checkpoint"
    ).awaitTermination()
    return df.sparkSession.read.parquet(f"{path}/table")


@query(_bucket_sql("event_type", 600 * 1_000_000, 5))
def rate_limit_streamed(spark, sf):
    """The bucket per event type with the events read as a stream of four micro-batches."""
    path = _store(spark, "limited")
    events = _events(spark, sf).select("event_id", "event_type", "ts")
    _landed(events, f"{path}/landed")
    landed = read_stream(spark, f"{path}/landed", events.schema, max_files=1)
    judged = rate_limit_stream(landed, ["event_type"], "ts", "event_id", 1, 5, per_seconds=600)
    return _streamed(judged, path, "rate_limit_streamed").select("event_id", "allowed")


_PERIOD = "(CASE WHEN event_type = 'click' THEN 300 WHEN event_type = 'view' THEN 1200 ELSE 600 END * 1000000)"


@query(
    f"""WITH RECURSIVE o AS MATERIALIZED (
        SELECT event_type AS key, event_id, {_US} AS t, {_PERIOD} AS period, (length(event_type) - 3) * {_PERIOD} AS room,
            row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
    run AS (
        SELECT key, event_id, n, true AS allowed, t + period AS tat FROM o WHERE n = 1
        UNION ALL
        SELECT o.key, o.event_id, o.n, r.tat - o.t <= room, CASE WHEN r.tat - o.t <= room THEN greatest(r.tat, o.t) + period ELSE r.tat END
        FROM run r JOIN o ON o.key = r.key AND o.n = r.n + 1)
    SELECT event_id, allowed FROM run"""
)
def rate_limit_streamed_rates(spark, sf):
    """A rate and a burst for each event type, in one stream whose state goes with the watermark."""
    path = _store(spark, "rates")
    events = _events(spark, sf).select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    _landed(events, f"{path}/landed")
    landed = read_stream(spark, f"{path}/landed", events.schema, max_files=1)
    rate = F.when(F.col("event_type") == "click", 4).when(F.col("event_type") == "view", 1).otherwise(2)
    judged = rate_limit_stream(
        landed, ["event_type"], "ts", "event_id", rate, F.length("event_type") - 2, per_seconds=1200, late="1 hour"
    )
    return _streamed(judged, path, "rate_limit_streamed_rates").select("event_id", "allowed")


@query(
    """SELECT event_id, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
    ORDER BY ts, event_id) <= 2 AS allowed FROM events"""
)
def window_limit_streamed(spark, sf):
    path = _store(spark, "windows")
    events = _events(spark, sf).select("event_id", "event_type", "ts")
    _landed(events, f"{path}/landed")
    landed = read_stream(spark, f"{path}/landed", events.schema, max_files=1)
    judged = window_limit_stream(landed, ["event_type"], "ts", "event_id", 2, seconds=3600)
    return _streamed(judged, path, "window_limit_streamed").select("event_id", "allowed")


@query(_ADMISSION_CHAIN)
def admission_streamed(spark, sf):
    """Requests admitted as they arrive: API key, a bucket for each endpoint, one for each address."""
    path = _store(spark, "admitted")
    requests = _faster_requests(spark, sf)
    _landed(requests, f"{path}/landed")
    landed = read_stream(spark, f"{path}/landed", requests.schema, max_files=1)
    spec = _admission("bucket", RateLimit(10, 4, per_ip=True, per_ip_rps=2))
    judged = admit.admit_requests(landed, spec)
    return _streamed(judged, path, "admission_streamed").select("request_id", "status", "error")


@query("SELECT event_id, '/events/' || event_type AS topic FROM events")
def stream_retried(spark, sf):
    """A stream whose second batch fails after it was stored, and that is started again."""
    path, tries = _store(spark, "retried"), []
    events = _events(spark, sf).select("event_id", "event_type", "ts")
    _landed(events, f"{path}/landed", 3)
    messages = read_stream(spark, f"{path}/landed", events.schema, max_files=1)
    routed = messages.select("event_id", F.concat(F.lit("/events/"), "event_type").alias("topic"))

    def sink(rows: DataFrame, batch: int) -> None:
        write_batch(rows, f"{path}/table", batch)
        tries.append(batch)
        if len(tries) == 2:
            raise OSError("the store went away")

    name = f"stream_retried-{uuid.uuid4().hex}"
    run_with_retries(lambda: run_stream(routed, sink, name, checkpoint=f"{path}/checkpoint"), backoff_seconds=0.01)
    return spark.read.parquet(f"{path}/table").select("event_id", "topic")


@query("SELECT 4::BIGINT AS batches, count(*)::BIGINT AS processed, (count(*) FILTER (WHERE event_id % 10 = 0))::BIGINT AS failed FROM events")
def stream_counters(spark, sf):
    """Counts of a stream that are stored by batch, with a batch that is run twice."""
    path, tries = _store(spark, "counted"), []
    events = _events(spark, sf).select("event_id", "ts")
    _landed(events, f"{path}/landed")
    landed = read_stream(spark, f"{path}/landed", events.schema, max_files=1)

    def sink(rows: DataFrame, batch: int) -> None:
        write_batch(rows, f"{path}/table", batch)
        tries.append(batch)
        if len(tries) == 3:
            raise OSError("the store went away")

    name = f"stream_counters-{uuid.uuid4().hex}"
    kept = counted(sink, f"{path}/counts", F.col("event_id") % 10 == 0)
    run_with_retries(lambda: run_stream(landed, kept, name, checkpoint=f"{path}/checkpoint"), backoff_seconds=0.01)
    return counter_totals(spark, f"{path}/counts")


@query(
    """SELECT i::BIGINT AS batch_id, least(n // 7, n - i * (n // 7))::BIGINT AS rows, n - i * (n // 7) >= n // 7 AS full
    FROM (SELECT count(*) AS n FROM events), generate_series(0, 7) s(i) WHERE i * (n // 7) < n"""
)
def batches_by_rows(spark, sf):
    """Events that landed in four files, taken in batches of a seventh of them; what is left leaves at the timeout."""
    path = _store(spark, "batches")
    events = _events(spark, sf).select("event_id", "ts")
    _landed(events, f"{path}/landed")
    landing = Landing(f"{path}/landed", events.schema, f"{path}/state", max(1, events.count() // 7), 3600)

    def sink(rows: DataFrame, batch: int) -> None:
        write_batch(rows, f"{path}/table", batch)

    run_batches(spark, landing, sink)
    run_batches(spark, landing, sink, lambda: 4_000_000_000_000)  # long after the timeout
    stored = spark.read.parquet(f"{path}/table").groupBy("batch_id").agg(F.count_distinct("event_id").alias("rows"))
    return stored.join(batch_log(spark, landing).select("batch_id", "full"), "batch_id").select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "rows", "full"
    )


# -- statistics ----------------------------------------------------------------

_DAY = "(epoch_us(ts) // 86400000000)"


def _delivered(spark: SparkSession, sf: str) -> DataFrame:
    """Events as delivered rows: one batch a day."""
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000)
    return _events(spark, sf).select(
        day.cast("bigint").alias("batch_id"), F.concat(F.lit("/t/"), "event_type").alias("to"), "event_id"
    )


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """A batch log: rows per day and target, some batches with an error."""
    per_batch = _delivered(spark, sf).groupBy("batch_id", "to").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("event_id") % 50).alias("duration_ms")
    )
    error = F.when((F.col("batch_id") + F.length("to")) % 3 == 0, F.concat(F.lit("lost "), "to"))
    return per_batch.withColumn("error", error)


_LOG = f"""(SELECT {_DAY} AS batch_id, '/t/' || event_type AS "to", count(*)::BIGINT AS rows,
    sum(event_id % 50)::BIGINT AS duration_ms,
    CASE WHEN ({_DAY} + length('/t/' || event_type)) % 3 = 0 THEN 'lost /t/' || event_type END AS error
    FROM events GROUP BY {_DAY}, event_type)"""


@query(
    f"""SELECT '/t/' || event_type AS "to", count(*)::BIGINT AS rows_written,
    count(DISTINCT {_DAY})::BIGINT AS batches_flushed FROM events GROUP BY 1"""
)
def route_stats(spark, sf):
    return stats.route_stats(_delivered(spark, sf))


@query(
    f"""SELECT sum(r)::BIGINT AS rows_written, sum(b)::BIGINT AS batches_flushed, count(*)::BIGINT AS routes
    FROM (SELECT event_type, count(*) AS r, count(DISTINCT {_DAY}) AS b FROM events GROUP BY 1)"""
)
def route_totals(spark, sf):
    return stats.route_totals(stats.route_stats(_delivered(spark, sf)))


@query(
    f"""SELECT "to", sum(rows)::BIGINT AS rows_written, count(DISTINCT batch_id)::BIGINT AS batches_flushed
    FROM {_LOG} WHERE error IS NULL GROUP BY 1"""
)
def log_stats(spark, sf):
    return stats.log_stats(_log(spark, sf))


@query(
    f"""SELECT "to", max(batch_id) AS batch_id, arg_max_null(error, batch_id) AS error FROM {_LOG} GROUP BY 1"""
)
def last_error(spark, sf):
    return stats.route_last_error(_log(spark, sf))


@query(
    f"""SELECT "to", count(*)::BIGINT AS batches, min(rows) AS min_rows, max(rows) AS max_rows,
    round(avg(rows), 6) AS avg_rows, quantile_disc(rows, 0.5) AS median_rows, min(duration_ms) AS min_ms,
    max(duration_ms) AS max_ms, quantile_disc(duration_ms, 0.95) AS p95_ms FROM {_LOG} GROUP BY 1"""
)
def batch_profile(spark, sf):
    return stats.batch_profile(_log(spark, sf)).withColumn("avg_rows", F.round("avg_rows", 6))


@query(
    f"""SELECT "to", count(*)::BIGINT AS n, count(DISTINCT batch_id)::BIGINT AS batch_id_distinct, sum(rows)::BIGINT AS rows_sum,
    min(rows) AS rows_min, max(rows) AS rows_max, quantile_disc(rows, 0.5) AS rows_median, quantile_disc(rows, 0.95) AS rows_p95
    FROM {_LOG} GROUP BY 1"""
)
def sketched_profile(spark, sf):
    """The batch log in four parts, each read once: figures come from their merged sketches."""
    path = _store(spark, "sketches")
    log = _log(spark, sf)
    for part in (0, 1, 2, 3, 3):
        sketches.store_sketches(log.where(F.col("batch_id") % 4 == part), path, part, ["to"], ["batch_id"], ["rows"])
    merged = sketches.read_sketches(spark, path, ["to"])
    return sketches.figures_of(merged, ["to"], {"median": 0.5, "p95": 0.95})


@query(
    """SELECT event_type, count(*)::BIGINT AS processed,
    count(*) FILTER (WHERE event_id % 10 = 0)::BIGINT AS failed FROM events GROUP BY 1"""
)
def quality_stats(spark, sf):
    devices = inputs.device_publishes(_events(spark, sf)).withColumn(
        "event_type", F.split_part("mqtt_topic", F.lit("/"), F.lit(2))
    )
    return stats.quality_stats(devices, ~decode.is_json_bytes(F.col("payload")), "event_type")


@query(
    """SELECT '/' || p_brand || '/' || p_type AS topic, arg_max(p_size, p_partkey) AS partitions,
    arg_max(p_retailprice > 1000, p_partkey) AS reliable FROM part GROUP BY 1"""
)
def topic_properties(spark, sf):
    routes = inputs.table(spark, sf, "part").select(
        F.col("p_partkey").alias("idx"),
        F.concat(F.lit("/"), "p_brand", F.lit("/"), "p_type").alias("to"),
        F.col("p_size").alias("partitions"),
        (F.col("p_retailprice") > 1000).alias("reliable"),
    )
    return stats.topic_properties(routes)


@query(
    """SELECT 'embeddings' AS name, count(*)::BIGINT AS points, max(len(embedding))::INTEGER AS stored_dimension,
    64::INTEGER AS dimension, 'cosine' AS distance FROM embeddings"""
)
def collection_info(spark, sf):
    catalog = catalog_frame(spark, [CollectionSpec("embeddings", 64), CollectionSpec("other", 8, "dot")])
    vectors = inputs.table(spark, sf, "embeddings").withColumnRenamed("embedding", "vector")
    return stats.collection_info(vectors, catalog, "embeddings")


# -- vector search -------------------------------------------------------------

_V = "list_transform({}.embedding, lambda x: x::DOUBLE)"
_SCORES = {
    "cosine": "list_cosine_similarity({a}, {b})",
    "dot": "list_inner_product({a}, {b})",
    "euclid": "list_distance({a}, {b})",
    "manhattan": "list_sum(list_transform(list_zip({a}, {b}), lambda p: abs(p[1] - p[2])))",
}


def _score_sql(metric: str) -> tuple[str, str]:
    score = _SCORES[metric].format(a=_V.format("e"), b=_V.format("q"))
    return f"round({score}, 6)", "DESC" if metric in ("cosine", "dot") else "ASC"


def _knn_sql(metric: str, k: int) -> str:
    score, way = _score_sql(metric)
    return f"""SELECT e.vec_id AS id, {score} AS score FROM embeddings e,
    (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY score {way}, id LIMIT {k}"""


def _collection(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )


def _knn(spark: SparkSession, sf: str, metric: str, k: int = 20) -> DataFrame:
    collection = _collection(spark, sf)
    asked = collection.orderBy("id").first()["vector"]
    return search.knn(collection, asked, k, metric).select("id", "score")


@query(_knn_sql("cosine", 20))
def knn_cosine(spark, sf):
    return _knn(spark, sf, "cosine")


@query(_knn_sql("dot", 20))
def knn_dot(spark, sf):
    return _knn(spark, sf, "dot")


@query(_knn_sql("euclid", 20))
def knn_euclid(spark, sf):
    return _knn(spark, sf, "euclid")


@query(_knn_sql("manhattan", 20))
def knn_manhattan(spark, sf):
    return _knn(spark, sf, "manhattan")


_MANY = f"""SELECT query_id, rank, id, score FROM (
    SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank
    FROM (SELECT q.label AS query_id, e.vec_id AS id, {_score_sql("cosine")[0]} AS score
    FROM embeddings e, (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) q)) WHERE rank <= 30"""


def _label_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One vector for each label, found in the whole table."""
    vectors = inputs.table(spark, sf, "embeddings")
    return vectors.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("vector"))


@query(_MANY)
def knn_many(spark, sf):
    """The nearest points of one vector for each label."""
    return search.knn_many(_collection(spark, sf), _label_queries(spark, sf), 30, "cosine")


@query(_MANY)
def knn_many_grid(spark, sf):
    """The same, with so little room for queries that they come in several blocks."""
    return search.knn_many(_collection(spark, sf), _label_queries(spark, sf), 30, "cosine", block_bytes=2000)


@query(
    f"""SELECT query_id, rank, id, score FROM (
    SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, id)::INTEGER AS rank
    FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, {_score_sql("euclid")[0]} AS score
    FROM embeddings e, (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0) q)) WHERE rank <= 10"""
)
def knn_indexed(spark, sf):
    """The nearest points of every twentieth vector, over a collection stored by its distances to pivots."""
    path = _store(spark, "pivots")
    vectors = inputs.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    index = pivots.index_points(vectors, path, 64, pivots=16, slice_points=128)
    asked = vectors.where(F.col("id") % 20 == 0).select(F.col("id").alias("query_id"), "vector")
    return pivots.search_points(spark, index, asked, 10)


@query(
    f"""SELECT row_number() OVER (ORDER BY s DESC, id)::INTEGER AS rank, round(s, 4) AS score, label,
    'set-1' AS "source.name", 'N/A' AS "text", 4::INTEGER AS metadata FROM (
    SELECT {_POINT_ID} AS id, label::VARCHAR AS label, {_score_sql("cosine")[0]} AS s
    FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q
    ORDER BY s DESC, id LIMIT 10)"""
)
def format_hits(spark, sf):
    stored = _points(spark, sf)
    asked = _collection(spark, sf).orderBy("id").first()["vector"]
    hits = search.knn(stored, asked, 10)
    shown = search.format_hits(hits, ["label", "source.name", "text"], metadata_prefix="_msg_")
    return shown.withColumn("metadata", F.size("metadata"))


@query(
    """SELECT doc_id, length(text)::INTEGER AS chars, (length(text) - length(replace(text, ' ', '')))::INTEGER AS spaces
    FROM documents"""
)
def embed_text(spark, sf):
    """The encoder hook, with an encoder whose vectors SQL can tell as well."""

    def encoder(text: pd.Series):
        return [[float(len(t)), float(t.count(" "))] for t in text]

    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    vector = search.embed(docs, "text", encoder)
    return vector.select(
        "doc_id",
        F.col("vector")[0].cast("int").alias("chars"),
        F.col("vector")[1].cast("int").alias("spaces"),
    )


# -- end to end ----------------------------------------------------------------


@query(
    f"""SELECT {_POINT_ID} AS id, label::VARCHAR AS label, 64 AS dimension,
    (SELECT count(*) FROM embeddings WHERE label % 2 <> 0)::BIGINT AS rejected FROM embeddings WHERE label % 2 = 0"""
)
def points_to_collection(spark, sf):
    """Vector messages routed, shaped and upserted; wrong dimensions set aside; the catalog stored."""
    root = _store(spark, "collection")
    spec = CollectionSpec("embeddings", 64)
    for _ in range(2):
        catalog = store_collection(spark, f"{root}/catalog", spec)
    cut = F.when(F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 60))
    vectors = inputs.table(spark, sf, "embeddings").withColumn("embedding", cut)
    routed = routing.route_exact(inputs.vector_messages(vectors), [Route("/vectors/embeddings", "embeddings")])
    made = points.to_points(routing.on_unrouted_rows(routed, "topic", "fail"), spec)
    label = as_string(F.col("payload_fields")["label"]).alias("label")
    # The second batch repeats the first.
    for batch in range(2):
        write_batch(project.good_rows(made).select("id", "vector", label), f"{root}/points", batch)
    write_batch(project.bad_rows(made).select(_joined().alias("errors")), f"{root}/rejected", 0)
    rejected = spark.read.parquet(f"{root}/rejected").groupBy(F.lit(spec.name).alias("name")).agg(
        F.count(F.lit(1)).alias("rejected")
    )
    about = catalog.join(rejected, "name", "left")
    current = read_latest(spark, f"{root}/points", ["id"]).withColumn("name", F.lit(spec.name))
    return current.join(about, "name").select("id", "label", "dimension", F.coalesce("rejected", F.lit(0)).alias("rejected"))


@query(
    """SELECT 'events:u' || user_id AS id, min(event_id) AS event_id FROM events
    WHERE event_id % 4 = 0 AND event_type IN ('click', 'view') GROUP BY user_id"""
)
def documents_to_table(spark, sf):
    """Messages routed, made documents and inserted; a document that is there stays."""
    path = _store(spark, "documents")
    messages = routing.route_exact(
        inputs.messages(_events(spark, sf)), [Route("/events/click", path), Route("/events/view", path)]
    )
    routed = routing.on_unrouted_rows(messages, "topic", "drop")
    batch = to_documents(routed, "events", keep=("event_id",)).where("id IS NOT NULL")
    target = ensure_table(spark, path, batch.schema)
    for _ in range(2):
        write_append(new_documents(target, batch, "events", ["event_id"]), path)
        target = spark.read.parquet(path)
    return target.select("id", "event_id")


@query(
    """SELECT (column_index - 1)::INTEGER AS position, column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'bigint'
    WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type
    FROM duckdb_columns() WHERE table_name = 'lineitem'"""
)
def table_columns(spark, sf):
    return stats.table_columns(inputs.table(spark, sf, "lineitem"))


@query("SELECT DISTINCT 'labels-' || label AS name FROM embeddings")
def collection_names(spark, sf):
    labels = inputs.table(spark, sf, "embeddings").select(
        F.concat(F.lit("labels-"), F.col("label").cast("string")).alias("name"), F.lit(64).alias("dimension")
    )
    return stats.list_collections(labels)


@query("SELECT user_id, 1::BIGINT AS partitions, count(*)::BIGINT AS n FROM events GROUP BY 1")
def partitions_by_key(spark, sf):
    """Equal keys stay together."""
    dealt = partition_by_key(_events(spark, sf), 5, "user_id").withColumn("p", F.spark_partition_id())
    return dealt.groupBy("user_id").agg(F.count_distinct("p").alias("partitions"), F.count(F.lit(1)).alias("n"))


@query(
    """SELECT topic, event_type, count(*)::BIGINT AS n, sum(k)::BIGINT AS total_k FROM (
    SELECT CASE WHEN user_id % 3 = 1 THEN '/iot/zone1' ELSE '/iot/rest' END AS topic, event_type,
    regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events WHERE event_id % 10 <> 0) WHERE k <= 80
    GROUP BY 1, 2"""
)
def device_to_table(spark, sf):
    """Publishes routed, decoded, checked, typed and counted, in one plan."""
    routes = [Route("sensors/+/zone1", "/iot/zone1"), Route("sensors/#", "/iot/rest")]
    messages = from_device_publishes(inputs.device_publishes(_events(spark, sf)), routes)
    parsed = messages.select("topic", "key", strict_json(F.col("payload")).alias("payload"))
    checked = validate.check_schema(parsed, _object(required=("k",), k={"type": "integer", "maximum": 80}))
    good = project.good_rows(checked).select(
        "topic", F.split_part("key", F.lit("/"), F.lit(2)).alias("event_type"), "payload"
    )
    typed = project.project_fields(good, [FieldMapping("k", "k", "Int64", False)], keep=["topic", "event_type"])
    return typed.groupBy("topic", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("total_k")
    )
