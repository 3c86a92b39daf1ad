"""Rate limits over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from weirflow.operators.keyed_limit import limit_stream, period_column
from weirflow.operators.limit import NANOS, _at_least_one


def rate_limit_stream(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    id: str,
    rate: int | Column,
    burst: int | Column,
    per_seconds: int = 1,
    keep: Sequence[str] = (),
    ttl_seconds: int | None = None,
    late: str | None = None,
) -> DataFrame:
    """Streaming form of rate_limit: rows ``id, *keep, allowed``.

    ``rate`` and ``burst`` may be columns; a key keeps those of its first event for as long as it
    has state. Inside a micro-batch events are taken in (ts, id) order; bound a micro-batch by rows
    (see :mod:`weirflow.streaming.batches`) to bound what a task holds of one key. An event older
    than what an earlier micro-batch brought is judged against the state as it is. With
    ``ttl_seconds`` the state of a key not seen for that long is dropped by Spark; by then the
    bucket is full again if that is more than ``burst`` refill periods. With ``late`` it goes
    when the watermark has passed the time at which the bucket is full, which changes no verdict.
    """
    return limit_stream(
        df, key, ts, id, period_column(rate, per_seconds), _at_least_one(burst, "burst"), keep, "bucket", ttl_seconds, late
    )


def window_limit_stream(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    id: str,
    rps: int | Column,
    seconds: int = 1,
    keep: Sequence[str] = (),
    ttl_seconds: int | None = None,
    late: str | None = None,
) -> DataFrame:
    """Streaming form of rate_limit_window: the first ``rps`` events of each key and window of ``seconds``."""
    return limit_stream(df, key, ts, id, seconds * NANOS, _at_least_one(rps, "rate"), keep, "window", ttl_seconds, late)
