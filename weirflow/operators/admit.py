"""Which requests are let in, and why the others are not."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.headers import canonical_ip, client_ip, header, normalize_headers
from weirflow.operators.keyed_limit import limit_stream, period_column
from weirflow.operators.limit import NANOS, rate_limit, rate_limit_window
from weirflow.operators.routing import listed_frame
from weirflow.specs import AdmissionSpec


def check_api_key(headers: Column, name: str, secret: str | None) -> tuple[Column, Column]:
    """(status, error) of the API key header: NULL status when the key is right.

    ``headers`` are normalized. Without a configured secret every request gets 500. Digests
    are compared, so that plans and event logs do not hold the secret.
    """
    if secret is None:
        return F.lit(500), F.lit("API key secret is not configured")
    given = header(headers, name)
    # Message texts.
    error = F.when(given.isNull(), F.lit(f"Missing {name.lower()} header")).when(
        F.sha2(given, 256) != F.lit(hashlib.sha256(secret.encode()).hexdigest()), F.lit("Invalid API key")
    )
    return F.when(error.isNotNull(), F.lit(401)), error


def check_body_size(body: Column, max_bytes: int) -> Column:
    """True when the body is longer than allowed; equal passes."""
    return F.octet_length(body) > max_bytes


def flag_content_type(headers: Column) -> Column:
    """True for a content type that is not JSON. Such requests are still accepted."""
    kind = header(headers, "content-type")
    return F.coalesce(~F.contains(kind, F.lit("application/json")), F.lit(False))


def _endpoint_table(df: DataFrame, spec: AdmissionSpec) -> DataFrame:
    rows = []
    for e in spec.endpoints:
        limit = spec.limit_for(e)
        rows.append(
            (
                e.path,
                e.to,
                limit.effective_rps if limit else None,
                limit.effective_burst if limit else None,
                limit.effective_ip_rps if limit and limit.per_ip else None,
            )
        )
    return listed_frame(
        df.sparkSession, rows, "path string, to string, _rps int, _burst int, _ip_rps int"
    )


def _address_rates(candidates: DataFrame, spec: AdmissionSpec, request_id: str, ts: str) -> DataFrame:
    """The candidates with the one rate and burst of their address.

    An address has one bucket for all endpoints, set up by the endpoint of its first
    request. Where all endpoints give addresses the same limit there is nothing to find out.
    """
    limits = [x for e in spec.endpoints if (x := spec.limit_for(e)) and x.per_ip]
    if len({(x.effective_ip_rps, x.effective_burst) for x in limits}) == 1:
        return candidates
    first = candidates.groupBy("_ip").agg(
        F.min_by(F.struct("_ip_rps", "_burst"), F.struct(F.col(ts), F.col(request_id))).alias("_first")
    )
    rates = first.select("_ip", F.col("_first._ip_rps").alias("_ip_rps"), F.col("_first._burst").alias("_burst"))
    return candidates.drop("_ip_rps", "_burst").join(rates, "_ip")


def _over_limit(
    candidates: DataFrame, spec: AdmissionSpec, request_id: str, ts: str, chunk_seconds: int | None
) -> DataFrame:
    """Requests over a limit: ``request_id, _over`` where _over is the error text.

    The endpoint's bucket comes first; only what passes it counts for the address, which
    has one bucket for all endpoints. All of it is lazy: both limiters read the stored
    exchange of the first one.
    """
    limits = [spec.limit_for(e) for e in spec.endpoints]
    limits = [x for x in limits if x]
    most = max(x.effective_rps for x in limits)

    def judge(df: DataFrame, key: list[str], rate: str, top: int, timeless: bool) -> DataFrame:
        if spec.limiter == "window":
            return rate_limit_window(df, key, ts, request_id, F.col(rate), top)
        return rate_limit(
            df, key, ts, request_id, F.col(rate), F.col("_burst"), 1, df.columns, chunk_seconds, timeless
        )

    # Message texts.
    def refused(judged: DataFrame, what: str, name: str) -> DataFrame:
        text = F.when(F.col("allowed").isNull(), F.lit("Request time is missing")).otherwise(
            F.concat(F.lit(f"Rate limit exceeded for {what}: "), name)
        )
        return judged.where(~F.coalesce("allowed", F.lit(False))).select(request_id, text.alias("_over"))

    by_endpoint = judge(candidates, ["path"], "_rps", most, True)
    over = refused(by_endpoint, "endpoint", "path")
    if any(x.per_ip for x in limits):
        most_ip = max(x.effective_ip_rps for x in limits if x.per_ip)
        passed = by_endpoint.where("allowed AND _ip_rps IS NOT NULL AND _ip IS NOT NULL").drop("allowed")
        by_ip = judge(_address_rates(passed, spec, request_id, ts), ["_ip"], "_ip_rps", most_ip, False)
        over = over.unionByName(refused(by_ip, "IP", "_ip"))
    return over


def _judged_stream(requests: DataFrame, asks: Column, spec: AdmissionSpec, request_id: str, ts: str, late: str | None) -> DataFrame:
    """The requests of a stream with ``_over``: two keyed states, endpoint then address, in one query.

    All columns go along, as a stream has no other way back to a request; requests that use up no
    limit are handed on under many keys.
    """

    def judge(df: DataFrame, key: str, rate: str, skip: Column) -> DataFrame:
        window = spec.limiter == "window"
        period = NANOS if window else period_column(F.col(rate), 1)
        tokens = F.col(rate) if window else F.col("_burst")
        kind = "window" if window else "bucket"
        return limit_stream(df, [key], ts, request_id, period, tokens, df.columns, kind, late=late, skip=skip)

    # Message texts.
    def too_many(what: str, name: str) -> Column:
        return F.when(~F.col("allowed"), F.concat(F.lit(f"Rate limit exceeded for {what}: "), name))

    address = canonical_ip(client_ip(F.col("_headers"), strict=True))
    first = judge(requests.withColumn("_asks", asks).withColumn("_ip", address).drop("_headers"), "path", "_rps", ~F.col("_asks"))
    missing = F.when(F.col("_asks") & F.col(ts).isNull(), F.lit("Request time is missing"))
    first = first.withColumn("_over", F.coalesce(missing, too_many("endpoint", "path"))).drop("allowed")
    if any(x.per_ip for e in spec.endpoints if (x := spec.limit_for(e))):
        done = ~F.col("_asks") | F.col("_over").isNotNull() | F.col("_ip").isNull() | F.col("_ip_rps").isNull()
        second = judge(first, "_ip", "_ip_rps", done)
        first = second.withColumn("_over", F.coalesce("_over", too_many("IP", "_ip")))
    return first.withColumn("_headers", normalize_headers(F.col("headers")))


def admit_requests(
    df: DataFrame,
    spec: AdmissionSpec,
    request_id: str = "request_id",
    ts: str = "received_at",
    chunk_seconds: int | None = 300,
    late: str | None = None,
) -> DataFrame:
    """Add ``to, status, error`` to requests ``request_id, path, headers, body, ts``, of a table or a stream.

    Order of the checks: API key (401, or 500 without a secret), rate limits (429),
    unknown path (404), body size (413), else 200. Only requests with the right key
    use up a limit, and one without a time is refused as over it. Over a table the limits look
    at narrow columns and join back by request id, so bodies are not moved for them; buckets are
    cut by ``chunk_seconds``, or by count with None, which reads the requests first. Over a
    stream they are two keyed states, through which the requests pass whole; an address keeps
    the limit of the endpoint that it used first, and with ``late`` the time column gets that
    watermark and state goes when it has no effect any more.
    """
    requests = df.join(_endpoint_table(df, spec), "path", "left").withColumn(
        "_headers", normalize_headers(F.col("headers"))
    )
    no_error = F.lit(None).cast("string")
    auth_status, auth_error = F.lit(None).cast("int"), no_error
    if spec.auth == "apikey":
        auth_status, auth_error = check_api_key(F.col("_headers"), spec.header, spec.secret)
    over = no_error
    limited = spec.limiter != "off" and any(spec.limit_for(e) for e in spec.endpoints)
    if limited and df.isStreaming:
        asks = auth_status.isNull() & F.col("_rps").isNotNull()
        requests = _judged_stream(requests, asks, spec, request_id, ts, late)
        over = F.col("_over")
    elif limited:
        candidates = requests.where(auth_status.isNull() & F.col("_rps").isNotNull()).select(
            request_id,
            ts,
            "path",
            "_rps",
            "_burst",
            "_ip_rps",
            canonical_ip(client_ip(F.col("_headers"), strict=True)).alias("_ip"),
        )
        requests = requests.join(
            _over_limit(candidates, spec, request_id, ts, chunk_seconds), request_id, "left"
        )
        over = F.col("_over")
    unknown = F.col("to").isNull()
    too_large = check_body_size(F.col("body"), spec.max_body_size)
    status = (
        F.when(auth_status.isNotNull(), auth_status)
        .when(over.isNotNull(), 429)
        .when(unknown, 404)
        .when(too_large, 413)
        .otherwise(200)
    )
    # Message texts.
    error = (
        F.when(auth_status.isNotNull(), auth_error)
        .when(over.isNotNull(), over)
        .when(unknown, F.concat(F.lit("Endpoint not found: "), "path"))
        .when(
            too_large,
            F.concat(
                F.lit("Payload size "),
                F.octet_length("body").cast("string"),
                F.lit(f" exceeds maximum {spec.max_body_size}"),
            ),
        )
    )
    return requests.select(
        *df.columns, "to", status.cast("int").alias("status"), error.alias("error")
    )
