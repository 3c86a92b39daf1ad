"""Micro-batches: reading, starting, retrying.

Offsets are committed by the checkpoint after a batch is stored, so delivery is at
least once; a sink that stores each batch under its id (write_batch) makes a repeated
batch harmless.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weirflow.session import checkpoint_root
from weirflow.sinks.ledger import is_fatal


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """A growing folder as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_stream(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    name: str,
    every: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``sink(rows, batch_id)``.

    ``every`` is a processing interval such as '5 seconds'; without it all that is
    available is processed and the query ends. The checkpoint goes under the folder
    the cluster names unless given.
    """
    place = checkpoint or f"{checkpoint_root(df.sparkSession)}/{name}"
    errors: list[Exception] = []

    def run(rows: DataFrame, batch_id: int) -> None:
        try:
            sink(rows, batch_id)
        except Exception as error:
            errors.append(error)
            raise

    writer = df.writeStream.foreachBatch(run).queryName(name).option("checkpointLocation", place)
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    # Spark passes on only the text of what a sink raised.
    query.sink_errors = errors
    return query


def observed(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """The rows, counted as they pass: ``processed`` and ``failed`` of each micro-batch.

    The counts are in the query's progress (``observedMetrics``) and cost no further pass.
    """
    failed = F.count_if(F.coalesce(bad, F.lit(True)))
    return df.observe(name, F.count(F.lit(1)).alias("processed"), failed.alias("failed"))


def counters(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums of what :func:`observed` counted in the micro-batches that the query still reports.

    For sums that last, see :mod:`weirflow.streaming.counters`.
    """
    total = {"processed": 0, "failed": 0}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        for key in total if row else ():
            total[key] += row[key]
    return total


def run_with_retries(
    start: Callable[[], StreamingQuery],
    max_retries: int = 3,
    backoff_seconds: float = 1.0,
    max_backoff_seconds: float = 30.0,
) -> StreamingQuery:
    """Run a query to its end and start it again after an error that may pass.

    A restart goes on from the checkpoint with the failed batch. The wait doubles each
    time up to a limit. Settings and data errors, told by their conditions, are raised at once.
    """
    wait = backoff_seconds
    for attempt in range(max_retries + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException as error:
            raised = getattr(query, "sink_errors", [])
            if is_fatal(raised[-1] if raised else error) or attempt == max_retries:
                raise
            time.sleep(wait)
            wait = min(wait * 2, max_backoff_seconds)
    raise AssertionError("not reached")


def partition_by_key(df: DataFrame, partitions: int, key: str = "key") -> DataFrame:
    """Spread a topic over partitions so that equal keys stay together; 0 leaves it."""
    return df.repartition(partitions, key) if partitions > 0 else df
