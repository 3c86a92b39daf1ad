"""Rate limits as operators over tables of timed events.

``rate_limit`` is a token bucket (the generic cell rate algorithm): an event at time
t is allowed when ``tat - t <= (burst - 1) * period``, and then moves ``tat`` to
``max(tat, t) + period``. The bucket of a key is a chain through all its events, so a
plain group per key would put a hot key into one task. Here the events of a key are cut
into chunks, by count or by time, and the chain is solved in three steps that each spread
over the cluster:

1. per (key, chunk), what the chunk does to *any* incoming ``tat``: a function of a
   few linear pieces, one small row;
2. per key, these rows in time order give every chunk its incoming ``tat``;
3. per (key, chunk), the events are decided from that.

The result equals a single pass over each key in (time, id) order. Tasks stream over
sorted Arrow batches and hold one bucket at a time, never a group.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weirflow.session import checkpoint_root
from weirflow.specs import SpecError

NANOS = 1_000_000_000
# Above so many pieces arrays are faster than a loop.
_MANY_PIECES = 24


def period_nanos(rate: int, per_seconds: int = 1) -> int:
    """Time one token takes to come back, in whole nanoseconds."""
    if rate < 1:
        raise SpecError("a rate must be at least 1")
    return per_seconds * NANOS // rate


class BucketMap:
    """What a run of events does to every possible incoming ``tat``.

    The incoming value lies in [start, start + burst * period]: earlier ones act like
    a full bucket at ``start``. The pieces partition that range; on each the outgoing
    value is either fixed or the incoming value plus a constant. There are about
    three pieces per token at most, and one as soon as the bucket was full once.
    """

    def __init__(self, start: int, period: int, burst: int):
        self.period, self.burst = period, burst
        self.room = (burst - 1) * period
        self.pieces: list[tuple[int, int, bool, int]] = [(start, start + burst * period, False, 0)]

    def feed(self, times: Sequence[int]) -> None:
        i = 0
        while i < len(times):
            if len(self.pieces) == 1 and self.pieces[0][2]:
                self._feed_fixed(times[i:])
                return
            self._step(times[i])
            i += 1
            # Events that every incoming value refuses change nothing.
            least = min(value if fixed else low + value for low, _, fixed, value in self.pieces)
            if i < len(times) and times[i] + self.room < least:
                i = bisect_left(times, least - self.room, i)

    def _feed_fixed(self, times: Sequence[int]) -> None:
        low, high, _, tat = self.pieces[0]
        self.pieces = [(low, high, True, decide(tat, times, self.period, self.burst)[0])]

    def _step(self, t: int) -> None:
        if len(self.pieces) > _MANY_PIECES:
            self._step_many(t)
            return
        last = t + self.room  # the largest tat that still lets the event in
        out: list[tuple[int, int, bool, int]] = []

        def put(low: int, high: int, fixed: bool, value: int) -> None:
            if low > high:
                return
            if out and out[-1][2:] == (fixed, value):
                out[-1] = (out[-1][0], high, fixed, value)
            else:
                out.append((low, high, fixed, value))

        for low, high, fixed, value in self.pieces:
            if fixed:
                put(low, high, True, max(value, t) + self.period if value <= last else value)
                continue
            # Incoming x leaves the earlier events as x + value.
            put(low, min(high, t - value), True, t + self.period)
            put(max(low, t - value + 1), min(high, last - value), False, value + self.period)
            put(max(low, last - value + 1), high, False, value)
        self.pieces = out

    def _step_many(self, t: int) -> None:
        """The same on arrays: its cost hardly depends on the number of pieces."""
        low, high, fixed, value = (np.array(x) for x in zip(*self.pieces, strict=True))
        last, period = t + self.room, self.period
        one, two = np.where(fixed, high, t - value), np.where(fixed, high, last - value)
        moved = np.where(value <= last, np.maximum(value, t) + period, value)
        lows = np.stack([low, np.maximum(low, one + 1), np.maximum(low, two + 1)], axis=1)
        highs = np.stack([np.minimum(high, one), np.minimum(high, two), high], axis=1)
        fixes = np.stack([np.ones(len(low), bool), fixed, fixed], axis=1)
        values = np.stack([np.where(fixed, moved, t + period), value + period, value], axis=1)
        keep = lows <= highs
        low, high, fixed, value = lows[keep], highs[keep], fixes[keep], values[keep]
        new = np.ones(len(low), bool)
        new[1:] = (fixed[1:] != fixed[:-1]) | (value[1:] != value[:-1])
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(low)) - 1
        self.pieces = list(
            zip(low[at].tolist(), high[ends].tolist(), fixed[at].tolist(), value[at].tolist(), strict=True)
        )

    def apply(self, tat: int) -> int:
        tat = max(tat, self.pieces[0][0])
        for low, high, fixed, value in self.pieces:
            if tat <= high:
                return value if fixed else tat + value
        raise ValueError("incoming value out of range")


def decide(tat: int, times: Sequence[int] | np.ndarray, period: int, burst: int) -> tuple[int, np.ndarray]:
    """Run one bucket over sorted times: (outgoing tat, allowed flags).

    A run of allowed events is one running maximum: with y(k) = tat(k) - k * period each
    event gives y(k+1) = max(y(k), t(k) - k * period). After a refusal all events before
    ``tat - room`` are refused too, which a binary search finds.
    """
    room = (burst - 1) * period
    times = np.asarray(times, dtype=np.int64)
    allowed = np.zeros(len(times), dtype=bool)
    i, width = 0, 64
    while i < len(times):
        part = times[i : i + width]
        spent = np.arange(len(part) + 1, dtype=np.int64) * period
        before = np.maximum.accumulate(np.concatenate([[tat], part - spent[:-1]])) + spent
        refused = before[:-1] - part > room
        n = int(refused.argmax()) if refused.any() else len(part)
        allowed[i : i + n] = True
        tat = int(before[n])
        i += n
        if n < len(part):
            i += int(np.searchsorted(times[i:], tat - room))
            width = max(16, min(width, 4 * n))
        else:
            width = min(4 * width, 65_536)
    return tat, allowed


# tat of a bucket that was never used: full at any time.
UNUSED = -(2**62)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """((key, chunk), from, to) of equal neighbours in a sorted batch."""
    key = batch["_key"].to_numpy(zero_copy_only=False)
    chunk = batch["_chunk"].to_numpy()
    if len(key) == 0:
        return
    cuts = np.flatnonzero((key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])) + 1
    edges = [0, *cuts.tolist(), len(key)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield (key[a], int(chunk[a])), a, b


_PIECES = pa.schema(
    [
        ("_key", pa.string()),
        ("_chunk", pa.int64()),
        ("start", pa.int64()),
        ("high", pa.list_(pa.int64())),
        ("fixed", pa.list_(pa.bool_())),
        ("value", pa.list_(pa.int64())),
    ]
)
_STARTS = pa.schema([("_key", pa.string()), ("_chunk", pa.int64()), ("_tat", pa.int64())])


def _limits(batch: pa.RecordBatch, row: int, fixed: dict[str, int]) -> list[int]:
    """Period and burst of a row, where they are not the same for all."""
    return [fixed[n] if n in fixed else batch[n][row].as_py() for n in ("_period", "_tokens")]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _chunk_maps(fixed: dict[str, int]):
    """Step 1: sorted events to one row of pieces per (key, chunk), for any bucket at its first event."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        bucket: BucketMap | None = None

        def row() -> dict:
            low, high, fixed, value = (list(x) for x in zip(*bucket.pieces, strict=True))
            return dict(_key=now[0], _chunk=now[1], start=low[0], high=high, fixed=fixed, value=value)

        for batch in batches:
            done = []
            times = batch["_t"].to_numpy()
            for group, a, b in _runs(batch):
                if group != now:
                    if now is not None:
                        done.append(row())
                    now = group
                    period, burst = _limits(batch, a, fixed)
                    bucket = BucketMap(int(times[a]), period, burst)
                bucket.feed(times[a:b].tolist())
            if done:
                yield _batch(done, _PIECES)
        if now is not None:
            yield _batch([row()], _PIECES)

    return run


def _incoming():
    """Step 2: pieces in (key, chunk) order to the tat each chunk starts with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tat = None, UNUSED
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["_key"] != now:
                    now, tat = r["_key"], UNUSED
                rows.append(dict(_key=now, _chunk=r["_chunk"], _tat=tat))
                tat = max(tat, r["start"])
                at = bisect_left(r["high"], tat)
                tat = r["value"][at] + (0 if r["fixed"][at] else tat)
            if rows:
                yield _batch(rows, _STARTS)

    return run


def _decide_chunks(keep: list[str], fixed: dict[str, int]):
    """Step 3: sorted events, each with its chunk's incoming tat, to events with their verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tat = None, UNUSED
        for batch in batches:
            times = batch["_t"].to_numpy()
            allowed = np.zeros(batch.num_rows, dtype=bool)
            for group, a, b in _runs(batch):
                if group != now:
                    now, tat = group, batch["_tat"][a].as_py()
                period, burst = _limits(batch, a, fixed)
                tat, allowed[a:b] = decide(tat, times[a:b], period, burst)
            yield batch.select(keep).append_column("allowed", pa.array(allowed))

    return run


def _column(x: int | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _at_least_one(rate: int | Column, what: str) -> int | Column:
    """A rate or burst; one below 1 is refused, at once or when it is met."""
    if not isinstance(rate, Column):
        if rate < 1:
            raise SpecError(f"{what} must be at least 1")
        return rate
    stop = F.raise_error(F.lit(f"{what} must be at least 1")).cast("bigint")
    return F.when(rate < 1, stop).otherwise(rate.cast("bigint"))


#: At most so many chunks of one key: what its map of chunks takes in one task.
MOST_CHUNKS = 4096


def _passed(cuts: Column, t: Column, chunks: int) -> Column:
    """How many of fewer than ``chunks`` sorted cuts are not after ``t``, found by halving."""
    strides = F.array(*[F.lit(2**i) for i in reversed(range((chunks - 1).bit_length()))])
    # A place beyond the last cut is NULL, which is not passed.
    return F.aggregate(
        strides, F.lit(0), lambda at, stride: F.when(F.get(cuts, at + stride - 1) <= t, at + stride).otherwise(at)
    )


def _cut_by_count(events: DataFrame, chunk_events: int) -> DataFrame:
    """Events with ``_chunk``: keys with more than ``chunk_events`` events are cut at quantiles of time.

    The times are found by sketches that tasks merge, and stored: every reader sees the same cuts.
    Events of the same time stay together.
    """
    spark = events.sparkSession
    place = f"{checkpoint_root(spark)}/weirflow/cuts-{uuid.uuid4().hex}"
    counts = events.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk_events)
    counts.write.parquet(f"{place}/hot")
    hot = spark.read.schema(counts.schema).parquet(f"{place}/hot")
    most = hot.agg(F.max("_n")).first()[0]
    if most is None:
        # No literal, which Spark would move past the exchange for one of its readers only.
        return events.withColumn("_chunk", F.when(F.col("_key").isNull(), 1).otherwise(0).cast("bigint"))
    chunks = min(MOST_CHUNKS, -(-most // chunk_events))
    shares = [i / chunks for i in range(1, chunks)]
    times = events.join(hot.select("_key"), "_key", "left_semi").groupBy("_key").agg(
        F.percentile_approx("_t", shares, 10 * max(1000, chunks)).alias("_at")
    )
    # A key with fewer events takes every so manieth cut.
    mine = F.ceil(F.col("_n") / F.lit(chunk_events))
    wanted = F.filter("_at", lambda _, i: F.floor((i + 1) * mine / chunks) != F.floor(i * mine / chunks))
    times = times.join(hot, "_key").select("_key", wanted.alias("_cuts"))
    times.write.parquet(f"{place}/cuts")
    cuts = spark.read.schema(times.schema).parquet(f"{place}/cuts")
    chunk = F.when(F.col("_cuts").isNull(), 0).otherwise(_passed(F.col("_cuts"), F.col("_t"), chunks)).cast("bigint")
    return events.join(cuts, "_key", "left").withColumn("_chunk", chunk).drop("_cuts")


def rate_limit(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    id: str,
    rate: int | Column,
    burst: int | Column,
    per_seconds: int = 1,
    keep: Sequence[str] = (),
    chunk_seconds: int | None = None,
    timeless: bool = True,
    chunk_events: int = 50_000,
) -> DataFrame:
    """Token bucket per key over a batch: rows ``id, *keep, allowed``.

    Events of a key are taken in (ts, id) order; id must be unique. ``rate`` events
    per ``per_seconds`` refill a bucket of ``burst``; both may be columns that are
    constant per key, and must be 1 or more. An event without a time has no place in the
    order: its verdict is NULL (``timeless=False`` when there is none). Pass only narrow
    columns in ``keep`` and join the verdicts back by id. A key with more than ``chunk_events``
    events is cut into chunks of about as many, wherever in time they lie; the events are
    counted for that. With ``chunk_seconds`` all keys are cut by time instead, which needs no
    count. The events are shuffled once, by (key, chunk); both passes over them read that exchange.
    """
    if chunk_events < 1 or (chunk_seconds is not None and chunk_seconds < 1):
        raise SpecError("chunks must hold something")
    wanted = list(dict.fromkeys([id, *keep]))
    # Constants go with the functions: in a column Spark would move them past the exchange
    # for one of its readers only.
    limits: dict[str, int | Column] = {"_period": _at_least_one(rate, "rate"), "_tokens": _at_least_one(burst, "burst")}
    each = limits["_period"]
    limits["_period"] = (
        F.floor(F.lit(per_seconds * NANOS) / each).cast("bigint") if isinstance(each, Column) else period_nanos(each, per_seconds)
    )
    fixed = {n: c for n, c in limits.items() if not isinstance(c, Column)}
    nanos = F.unix_micros(F.col(ts).cast("timestamp")) * 1000
    timed = df.where(F.col(ts).isNotNull())
    events = timed.select(
        F.to_json(F.struct(*key)).alias("_key"),
        nanos.alias("_t"),
        *[c.alias(n) for n, c in limits.items() if isinstance(c, Column)],
        *wanted,
    )
    if chunk_seconds is None:
        events = _cut_by_count(events, chunk_events)
    else:
        events = events.withColumn("_chunk", F.floor(F.col("_t") / F.lit(chunk_seconds * NANOS)).cast("bigint"))
    dealt = events.repartition("_key", "_chunk")
    # All columns go through, so that both readers of the exchange ask for the same one.
    pieces = dealt.sortWithinPartitions("_key", "_chunk", "_t").mapInArrow(
        _chunk_maps(fixed),
        "_key string, _chunk bigint, start bigint, high array<bigint>, fixed array<boolean>, value array<bigint>",
    )
    starts = (
        pieces.repartition("_key")
        .sortWithinPartitions("_key", "_chunk")
        .mapInArrow(_incoming(), "_key string, _chunk bigint, _tat bigint")
    )
    out = T.StructType(
        [*[df.schema[c] for c in wanted], T.StructField("allowed", T.BooleanType())]
    )
    # One start for each chunk of events; an outer join adds no filter to the events' side, so
    # that both readers ask for the same exchange. It was asked for by name, so Spark never
    # splits one of its partitions, and a chunk stays in one task.
    judged = (
        dealt.join(starts, ["_key", "_chunk"], "left")
        .sortWithinPartitions("_key", "_chunk", "_t", id)
        .mapInArrow(_decide_chunks(wanted, fixed), out)
    )
    if not timeless:
        return judged
    unknown = df.where(F.col(ts).isNull()).select(*wanted, F.lit(None).cast("boolean").alias("allowed"))
    return judged.unionByName(unknown)


def rate_limit_window(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    id: str,
    rps: int | Column,
    max_rps: int | None = None,
    unit: str = "second",
) -> DataFrame:
    """Add ``allowed``: the first ``rps`` events of each key and second, by (ts, id).

    The last allowed event of every full second is found first; the rank limit is
    applied before the shuffle, so a hot second sends ``max_rps`` rows per task. All
    events are then compared with it by a join that may be split on skew. With a
    column as ``rps``, give its upper bound as ``max_rps``. ``unit`` takes another
    window, such as 'minute'. Rates must be 1 or more; an event without a time gets a
    NULL verdict.
    """
    top = rps if max_rps is None else max_rps
    if isinstance(top, Column):
        raise ValueError("max_rps is needed when rps is a column")
    if top < 1:
        raise SpecError("rate must be at least 1")
    timed = df.withColumn("_window", F.date_trunc(unit, F.col(ts)))
    place = Window.partitionBy(*key, "_window").orderBy(ts, id)
    last = (
        timed.select(*key, "_window", F.col(ts), F.col(id), _column(_at_least_one(rps, "rate")).alias("_rps"))
        .withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") <= top)
        .where(F.col("_place") == F.col("_rps"))
        .select(*key, "_window", F.struct(F.col(ts), F.col(id)).alias("_last"))
    )
    in_time = F.col("_last").isNull() | (F.struct(F.col(ts), F.col(id)) <= F.col("_last"))
    allowed = F.when(F.col(ts).isNotNull(), in_time)
    return (
        timed.join(last, [*key, "_window"], "left")
        .withColumn("allowed", allowed)
        .select(*df.columns, "allowed")
    )
