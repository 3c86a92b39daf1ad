"""One batch into many targets."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from weirflow.operators.routing import route_exact
from weirflow.operators.stats import BATCH_LOG
from weirflow.sinks.ledger import DEAD, STORED, Ledger, Retry, attempt, is_fatal
from weirflow.sinks.tables import write_append, write_batch
from weirflow.sources.envelope import union_envelopes
from weirflow.specs import Route, SpecError, check_routes


class FanOutError(RuntimeError):
    """Some routes of a batch could not be written; ``log`` tells which."""

    def __init__(self, message: str, log: DataFrame):
        super().__init__(message)
        self.log = log


#: Stores the rows of all routes that share a target, once: (target, [(route, rows), ...]).
TargetWriter = Callable[[str, list[tuple[Route, DataFrame]]], None]


def fan_out(
    df: DataFrame,
    routes: Sequence[Route],
    write: TargetWriter,
    batch_id: int = 0,
    on_unrouted: str = "fail",
    quarantine: Callable[[DataFrame], None] | None = None,
    duplicates: str = "reject",
    parallel: int = 4,
    log_path: str | None = None,
    empty_targets: bool = True,
    ledger: Ledger | None = None,
    retry: Retry = Retry(attempts=1),
    dead_letter: Callable[[DataFrame, int], None] | None = None,
) -> DataFrame:
    """Group a batch by topic, find each topic's route and write every target once.

    ``write(target, parts)`` stores what several topics bring to one table in one write;
    make it idempotent per batch (see write_batch), because a failed batch is run again,
    without a ``ledger`` as a whole. With ``empty_targets`` it is also called for targets without rows, so that a
    repeat that brings nothing replaces what the first attempt stored. The batch is held
    once (memory, then disk) and read per target. Unrouted messages stop the batch before
    anything is written ('fail'), are left out ('drop'), or are handed to ``quarantine``.
    Returns the batch log, one row per route that had rows; the routes of a target share
    its time and error.

    A target is tried as ``retry`` says. With a ``ledger`` a batch that is run again leaves out
    the targets that are entered there, so only those that failed are written. Rows that a target
    refuses for good (bad data or settings) go to ``dead_letter(rows, batch_id)``, with the target
    and the error as ``_target`` and ``_error``; the target then counts as done.
    """
    kept = check_routes(routes, duplicates)
    if on_unrouted not in ("fail", "drop", "quarantine"):
        raise SpecError(f"unknown on_unrouted {on_unrouted!r}")
    spark = df.sparkSession
    finished = ledger.done(spark, batch_id) if ledger else set()
    targets: dict[str, list[Route]] = {}
    for route in kept:
        if route.to not in finished:
            targets.setdefault(route.to, []).append(route)
    if finished and not targets:
        return spark.createDataFrame([], BATCH_LOG)
    routed = route_exact(df, kept).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        label = F.when(F.col("to").isNotNull(), F.col("topic"))
        # One row per route at most, plus one for all that is unrouted.
        counts = {
            r.source: r.n
            for r in routed.groupBy(label.alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()
        }
        if counts.get(None) and on_unrouted == "fail":
            raise SpecError(f"No route for {counts[None]} messages of batch {batch_id}")
        if counts.get(None) and on_unrouted == "quarantine" and not finished:
            if quarantine is None:
                raise SpecError("on_unrouted='quarantine' needs a quarantine writer")
            quarantine(routed.where(F.col("to").isNull()).drop("to"))

        def run(target: str) -> list[tuple]:
            started, clock = datetime.now(timezone.utc), time.monotonic()
            parts = [(r, routed.where(F.col("topic") == r.source).drop("to")) for r in targets[target]]
            # Every target is tried, then all errors are raised.
            tries, failure = attempt(lambda: write(target, parts), retry)
            error = failure and f"{type(failure).__name__}: {failure}"
            state = STORED if failure is None else None
            if failure is not None and dead_letter is not None and is_fatal(failure):
                refused = union_envelopes(*[rows for _, rows in parts])
                dead_letter(refused.withColumns({"_target": F.lit(target), "_error": F.lit(error)}), batch_id)
                state = DEAD
            if ledger and state:
                ledger.enter(spark, batch_id, target, state, tries, error)
            settled[target] = state
            took = int((time.monotonic() - clock) * 1000)
            return [
                (batch_id, r.source, target, counts.get(r.source, 0), started, took, error)
                for r in targets[target]
                if counts.get(r.source) or error
            ]

        settled: dict[str, str | None] = {}
        todo = [t for t, own in targets.items() if empty_targets or any(counts.get(r.source) for r in own)]
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            rows = [x for found in pool.map(inheritable_thread_target(spark)(run), todo) for x in found]
    finally:
        routed.unpersist()
    log = spark.createDataFrame(rows, BATCH_LOG)
    if log_path:
        write_append(log, log_path)
    failed = [r for r in rows if r[-1] and settled[r[2]] is None]
    if failed:
        raise FanOutError("; ".join(f"{r[2]}: {r[-1]}" for r in failed), log)
    return log


def write_partitioned(
    df: DataFrame,
    routes: Sequence[Route],
    path: str,
    batch_id: int | None = None,
    fmt: str = "parquet",
) -> None:
    """All targets in one job, as partitions ``to=...`` of one table.

    For routes that store the same columns: one pass, nothing held, no shuffle.
    """
    routed = route_exact(df, check_routes(routes)).where(F.col("to").isNotNull())
    if batch_id is None:
        write_append(routed, path, fmt, ["to"])
        return
    (
        routed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", "to")
        .mode("overwrite")
        .save(path)
    )


def table_writer(
    shape: Callable[[Route, DataFrame], DataFrame],
    batch_id: int,
    fmt: str = "parquet",
    declared: T.StructType | None = None,
) -> TargetWriter:
    """A ``write`` for fan_out: shape the rows of each route, store a target's rows once.

    ``declared`` is the schema of the tables, which are made and checked with it.
    """

    def write(target: str, parts: list[tuple[Route, DataFrame]]) -> None:
        rows = union_envelopes(*[shape(route, part) for route, part in parts])
        write_batch(rows, target, batch_id, fmt, target, declared)

    return write
