"""Rate limits over a stream: a few numbers of state per key.

``transformWithState`` keeps a value for each key and hands over the key's rows of a micro-batch
as an iterator of frames. Every key has the rate that its first event brings, so streams with
several rates need one operator.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirflow.operators.limit import NANOS, UNUSED, _at_least_one, _column, decide
from weirflow.specs import SpecError

#: Rows of a key that leave at once.
_SLICE = 10_000
#: Where a key stands: a bucket's tat, or a window and how many it let in; then the key's limit.
STATE = "at bigint, used bigint, period bigint, tokens bigint, timer bigint"
KINDS = ("bucket", "window")


def decide_window(at: int, used: int, times: np.ndarray, period: int, tokens: int) -> tuple[int, int, np.ndarray]:
    """The first ``tokens`` events of each window of ``period``: (last window, let in there, allowed).

    Events of an older window than the one that was reached count for that one.
    """
    window = np.maximum.accumulate(np.maximum(times // period, at))
    begin = np.searchsorted(window, window)
    place = np.arange(len(window)) - begin + np.where(window == at, used, 0)
    allowed = place < tokens
    last = int(window[-1])
    return last, int(min(place[-1] + 1, tokens)), allowed


class Limiter(StatefulProcessor):
    """One key's limit. Its events of a micro-batch are taken in (time, id) order.

    Their times, ids and kept columns are held as they are read, in arrays, and leave in slices:
    about 40 bytes an event besides what is kept, for as long as the micro-batch takes.
    """

    def __init__(self, kind: str, id: str, wanted: list[str], ttl_seconds: int | None, timers: bool) -> None:
        self.kind, self.id, self.wanted, self.ttl_seconds, self.timers = kind, id, wanted, ttl_seconds, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = None if self.ttl_seconds is None else self.ttl_seconds * 1000
        self.state = handle.getValueState("limit", STATE, ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asking, first, found = [], None, self.state.get() if self.state.exists() else None
        for chunk in rows:
            skipped = chunk["skip"].to_numpy(bool)
            if skipped.any():
                yield chunk.loc[skipped, self.wanted].assign(allowed=None)
                chunk = chunk.loc[~skipped]
            if len(chunk):
                limits = chunk[["t", self.id, "period", "tokens"]].sort_values(["t", self.id]).iloc[0]
                if found is None and (first is None or (limits["t"], limits[self.id]) < (first["t"], first[self.id])):
                    first = limits
                asking.append(chunk[["t", *self.wanted]])
        if not asking:
            return
        held = asking[0].copy() if len(asking) == 1 else pd.concat(asking, ignore_index=True)
        asking.clear()
        times, ids = held.pop("t").to_numpy(np.int64), held[self.id].to_numpy()
        if ids.dtype == object:
            order = pd.DataFrame({"t": times, "id": ids}).sort_values(["t", "id"]).index.to_numpy()
        else:
            order = np.lexsort((ids, times))
        times = times[order]
        if found is None:
            period, tokens = int(first["period"]), int(first["tokens"])
            at, used, timer = (UNUSED if self.kind == "bucket" else -(2**62)), 0, None
        else:
            at, used, period, tokens, timer = found
        if self.kind == "bucket":
            at, allowed = decide(at, times, period, tokens)
        else:
            at, used, allowed = decide_window(at, used, times, period, tokens)
        if self.timers and timer is None:
            timer = self._free_at(at, period)
            self.handle.registerTimer(timer)
        self.state.update((at, used, period, tokens, timer))
        for a in range(0, len(order), _SLICE):
            part = order[a : a + _SLICE]
            yield held[self.wanted].iloc[part].assign(allowed=allowed[a : a + _SLICE])

    def _free_at(self, at: int, period: int) -> int:
        """The time, in milliseconds, from which the key is as if it had never been seen."""
        end = at if self.kind == "bucket" else (at + 1) * period
        return end // 1_000_000 + 1

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, used, period, tokens, _ = self.state.get()
        free = self._free_at(at, period)
        if free <= timerValues.getCurrentWatermarkInMs():
            self.state.clear()
        else:
            self.handle.registerTimer(free)
            self.state.update((at, used, period, tokens, free))
        return iter(())

    def close(self) -> None:
        pass


def limit_stream(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    id: str,
    period: int | Column,
    tokens: int | Column,
    keep: Sequence[str] = (),
    kind: str = "bucket",
    ttl_seconds: int | None = None,
    late: str | None = None,
    skip: Column | None = None,
) -> DataFrame:
    """Rows ``id, *keep, allowed`` of a stream: a bucket of ``tokens`` that get one more each
    ``period`` nanoseconds, or windows of ``period`` nanoseconds with ``tokens`` events each.

    Rows where ``skip`` is true, or without a time, are handed on with a NULL verdict and use up
    nothing. With ``late`` (such as '10 minutes') the time column gets a watermark, and a key's
    state goes by a timer as soon as the watermark shows that the key is as if never seen; events
    that are later than that are dropped by Spark, which counts them in the query's progress.
    """
    if kind not in KINDS:
        raise SpecError(f"unknown limiter {kind!r}")
    if late is not None and ttl_seconds is not None:
        raise SpecError("late and ttl_seconds are two ways to drop state: give one")
    wanted = list(dict.fromkeys([id, *keep]))
    # Spark's frames lose names with a leading underscore, so columns travel under others.
    plain = [f"c{i}" for i in range(len(wanted))]
    # A map would become a Python dict for each row, twice; as text it only passes through.
    text = {c for c in wanted if c != id and _is_text_map(df.schema[c].dataType)}
    types = [T.StringType() if c in text else df.schema[c].dataType for c in wanted]
    out = T.StructType([T.StructField(p, t) for p, t in zip(plain, types, strict=True)]).add("allowed", "boolean")
    if late is not None:
        df = df.withWatermark(ts, late)
    idle = F.col(ts).isNull()
    if skip is not None:
        idle = idle | F.coalesce(skip, F.lit(False))
    # Rows that are only handed on are spread over many keys.
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(id), F.lit(1024)).cast("string"))
    narrow = df.select(
        F.when(idle, spread).otherwise(F.to_json(F.struct(*key))).alias("limit_key"),
        F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")) * 1000, F.lit(0)).alias("t"),
        idle.alias("skip"),
        _column(period).cast("bigint").alias("period"),
        _column(tokens).cast("bigint").alias("tokens"),
        *[(F.to_json(c, {"ignoreNullFields": "false"}) if c in text else F.col(c)).alias(p) for p, c in zip(plain, wanted, strict=True)],
    )
    mode = "EventTime" if late is not None else "None" if ttl_seconds is None else "ProcessingTime"
    processor = Limiter(kind, plain[0], plain, ttl_seconds, late is not None)
    judged = narrow.groupBy("limit_key").transformWithStateInPandas(processor, out, "append", mode)
    back = [F.from_json(p, df.schema[c].dataType) if c in text else F.col(p) for p, c in zip(plain, wanted, strict=True)]
    return judged.select(*[x.alias(c) for x, c in zip(back, wanted, strict=True)], "allowed")


def _is_text_map(kind: T.DataType) -> bool:
    return isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType) and isinstance(kind.valueType, T.StringType)


def period_column(rate: int | Column, per_seconds: int) -> int | Column:
    """Nanoseconds until a token comes back."""
    rate = _at_least_one(rate, "rate")
    if isinstance(rate, Column):
        return F.floor(F.lit(per_seconds * NANOS) / rate).cast("bigint")
    return per_seconds * NANOS // rate
