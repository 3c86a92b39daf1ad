"""Counts of a stream that outlive its progress reports and its restarts.

The counts of a micro-batch are taken while its rows pass to the sink, and stored under the
batch's id after the sink is done. A batch that is run again replaces its counts, so sums over
the stored batches are right whatever was repeated.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weirflow.sinks.tables import _NO_TABLE, write_batch

COUNTS = "processed bigint, failed bigint"
#: How long counts may take to arrive after the sink is done. They are there at once if it read the rows.
_WAIT_SECONDS = 5.0


def _measures(bad: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("processed"), F.count_if(F.coalesce(bad, F.lit(True))).alias("failed")]


def counted(sink: Callable[[DataFrame, int], None], path: str, bad: Column) -> Callable[[DataFrame, int], None]:
    """The sink, with the rows of each micro-batch and those that are ``bad`` counted into ``path``.

    What the sink's first action over the rows reads is counted as it passes, and costs no further
    pass. Rows of a sink that reads nothing are counted by a pass of their own.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        seen = Observation(f"counts-{batch_id}")
        sink(df.observe(seen, *_measures(bad)), batch_id)
        found: list[dict] = []
        # Asking waits for as long as nothing was read, which may be for ever.
        waiting = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
        waiting.start()
        waiting.join(_WAIT_SECONDS)
        counts = found[0] if found else df.agg(*_measures(bad)).first().asDict()
        row = [(counts["processed"], counts["failed"])]
        write_batch(df.sparkSession.createDataFrame(row, COUNTS).coalesce(1), path, batch_id)

    return run


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, processed, failed): one row for each micro-batch that was stored."""
    try:
        found = spark.read.schema(COUNTS).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _NO_TABLE:
            raise
        return spark.createDataFrame([], f"batch_id bigint, {COUNTS}")
    return found.select(F.col("batch_id").cast("bigint").alias("batch_id"), "processed", "failed")


def counter_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row: micro-batches, rows and bad rows since the stream began."""
    return stored_counts(spark, path).agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    )
