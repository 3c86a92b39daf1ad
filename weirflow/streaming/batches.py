"""Micro-batches of a bounded number of rows, held until they are full or have waited long enough.

Files that land in a folder are cut into ranges of rows. A batch is a list of such ranges with
``max_rows`` rows in all; what is left over waits for more rows until the oldest of it has lain
for ``timeout_seconds``. The ranges of a batch are written down before it is handed to the sink
and it is marked as done afterwards, so a batch that failed is run again with the same rows under
the same id, and nothing is left out or taken twice.

Files are listed on the driver, as Spark's own file source does; their rows are not. Rows are
found again by file and row index, which Spark tells for Parquet files.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.sinks.tables import _NO_TABLE
from weirflow.specs import SpecError

PLAN = "file string, first bigint, last bigint, landed_ms bigint"
LOG = "rows bigint, full boolean, waited_ms bigint"


@dataclass(frozen=True)
class Landing:
    """A folder of Parquet files with the columns ``schema``, cut into batches; ``state`` is the folder of the plan."""

    path: str
    schema: T.StructType
    state: str
    max_rows: int
    timeout_seconds: float

    def __post_init__(self):
        if self.max_rows < 1:
            raise SpecError("max_rows must be at least 1")
        if self.timeout_seconds < 0:
            raise SpecError("a timeout cannot be negative")


def _stored(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A table of batches, or no rows if there is none yet."""
    try:
        found = spark.read.schema(columns).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _NO_TABLE:
            raise
        return spark.createDataFrame([], f"{columns}, batch_id bigint")
    return found.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def batch_log(spark: SparkSession, landing: Landing) -> DataFrame:
    """The batches that are done: batch_id, rows, whether they were full, and how long their oldest file had lain."""
    return _stored(spark, f"{landing.state}/done", LOG)


def _waiting(spark: SparkSession, landing: Landing, planned: DataFrame) -> list[tuple[str, int, int, int]]:
    """(file, first row, rows, landed at) of what is in no batch yet, oldest first. Counts come from file footers."""
    try:
        landed = spark.read.schema(landing.schema).parquet(landing.path)
    except AnalysisException as error:
        if error.getCondition() not in _NO_TABLE:
            raise
        return []
    if not landed.inputFiles():
        return []
    file = F.col("_metadata.file_path")
    at = F.unix_millis(F.col("_metadata.file_modification_time"))
    files = landed.groupBy(file.alias("file"), at.alias("landed_ms")).agg(F.count(F.lit(1)).alias("rows"))
    taken = planned.groupBy("file").agg((F.max("last") + 1).alias("first"))
    open_files = files.join(taken, "file", "left").select("file", F.coalesce("first", F.lit(0)).alias("first"), "rows", "landed_ms")
    rows = open_files.where("first < rows").orderBy("landed_ms", "file").collect()
    return [tuple(r) for r in rows]


def cut(waiting: list[tuple[str, int, int, int]], max_rows: int, timeout_ms: float, now_ms: float) -> list[list[tuple[str, int, int, int]]]:
    """Ranges (file, first, last, landed at) of each batch that may leave: all full ones, and a last one that is due."""
    batches, now, room = [], [], max_rows
    for file, first, rows, landed in waiting:
        while first < rows:
            last = min(rows, first + room) - 1
            now.append((file, first, last, landed))
            room -= last + 1 - first
            first = last + 1
            if room == 0:
                batches.append(now)
                now, room = [], max_rows
    if now and now_ms - min(r[3] for r in now) >= timeout_ms:
        batches.append(now)
    return batches


def _rows_of(spark: SparkSession, landing: Landing, ranges: list[tuple[str, int, int, int]]) -> DataFrame:
    """The rows of a batch. Its files are read, others are not; a file is read by all its splits."""
    wanted = spark.createDataFrame([r[:3] for r in ranges], "_file string, _first bigint, _last bigint")
    read = spark.read.schema(landing.schema).parquet(*sorted({r[0] for r in ranges}))
    placed = read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    inside = placed.join(F.broadcast(wanted), "_file").where("_row BETWEEN _first AND _last")
    return inside.select(*landing.schema.names)


def run_batches(
    spark: SparkSession, landing: Landing, sink: Callable[[DataFrame, int], None], now_ms: Callable[[], float] = lambda: time.time() * 1000
) -> list[int]:
    """Hand every batch that is full or due to ``sink(rows, batch_id)``; returns their ids.

    Call it again and again, or from a scheduled job. A batch that an earlier call wrote down but
    did not finish comes first, with the same rows.
    """
    planned = _stored(spark, f"{landing.state}/plan", PLAN)
    done = batch_log(spark, landing).select("batch_id").distinct()
    todo: dict[int, list[tuple]] = {}
    for r in planned.join(done, "batch_id", "left_anti").orderBy("batch_id", "landed_ms", "file", "first").collect():
        todo.setdefault(r.batch_id, []).append((r.file, r.first, r.last, r.landed_ms))
    last = planned.agg(F.max("batch_id")).first()[0]
    next_id = 0 if last is None else last + 1
    fresh = cut(_waiting(spark, landing, planned), landing.max_rows, landing.timeout_seconds * 1000, now_ms())
    ran = []
    for batch_id, ranges in [*sorted(todo.items()), *enumerate(fresh, next_id)]:
        if batch_id not in todo:
            spark.createDataFrame(ranges, PLAN).coalesce(1).write.mode("overwrite").parquet(f"{landing.state}/plan/batch_id={batch_id}")
        sink(_rows_of(spark, landing, ranges), batch_id)
        rows = sum(b + 1 - a for _, a, b, _ in ranges)
        entry = [(rows, rows == landing.max_rows, int(now_ms() - min(r[3] for r in ranges)))]
        spark.createDataFrame(entry, LOG).coalesce(1).write.mode("overwrite").parquet(f"{landing.state}/done/batch_id={batch_id}")
        ran.append(batch_id)
    return ran
