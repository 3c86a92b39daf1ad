"""Which targets of a batch are stored: read before writing, so that a batch that is run again
writes only what failed.

An entry is one small file, written after its target's rows. Retries are told from what would
fail again by the error's conditions, never by its text.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.sinks.tables import _NO_TABLE
from weirflow.specs import SpecError

ENTRY = "target string, state string, attempts int, error string"
STORED, DEAD = "stored", "dead"

#: Conditions of errors that the same rows would raise again. Any analysis error is one, too.
FATAL_CONDITIONS = frozenset(
    {
        "USER_RAISED_EXCEPTION",
        "CAST_INVALID_INPUT",
        "CAST_OVERFLOW",
        "ARITHMETIC_OVERFLOW",
        "DIVIDE_BY_ZERO",
        "NOT_NULL_ASSERT_VIOLATION",
        "MALFORMED_RECORD_IN_PARSING",
    }
)


def conditions(error: BaseException) -> set[str]:
    """The conditions that an error and its causes name, on both sides of the bridge to the JVM."""
    found: set[str] = set()
    seen: BaseException | None = error
    while seen is not None:
        if isinstance(seen, PySparkException) and seen.getCondition():
            found.add(seen.getCondition())
        thrown = getattr(seen, "_origin", None)
        while thrown is not None:
            name = getattr(thrown, "getCondition", None)
            try:
                if name is not None and name():
                    found.add(name())
            except Exception:  # noqa: BLE001 - a Java error without conditions
                pass
            thrown = thrown.getCause()
        seen = seen.__cause__ or seen.__context__
    return found


def is_fatal(error: BaseException) -> bool:
    """Whether the same batch would fail in the same way again: settings, plans and data, not the store."""
    seen: BaseException | None = error
    while seen is not None:
        if isinstance(seen, (SpecError, AnalysisException)):
            return True
        seen = seen.__cause__ or seen.__context__
    return any(c in FATAL_CONDITIONS or c.split(".")[0] in FATAL_CONDITIONS for c in conditions(error))


@dataclass(frozen=True)
class Retry:
    """How often a target is tried, and the wait between tries, which doubles up to a limit."""

    attempts: int = 3
    wait_seconds: float = 1.0
    longest_seconds: float = 30.0

    def __post_init__(self):
        if self.attempts < 1 or self.wait_seconds < 0:
            raise SpecError("attempts must be at least 1, waits cannot be negative")


def attempt(work: Callable[[], None], retry: Retry) -> tuple[int, Exception | None]:
    """(tries, last error): runs ``work`` until it succeeds, fails for good, or all tries are used."""
    wait = retry.wait_seconds
    for n in range(1, retry.attempts + 1):
        try:
            work()
            return n, None
        except Exception as error:  # noqa: BLE001 - told apart by is_fatal
            if n == retry.attempts or is_fatal(error):
                return n, error
            time.sleep(wait)
            wait = min(wait * 2, retry.longest_seconds)
    raise AssertionError("not reached")


@dataclass(frozen=True)
class Ledger:
    """Entries for each (batch, target) at ``path``."""

    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        """batch_id, target, state ('stored', or 'dead' where its rows were set aside), attempts, error."""
        try:
            found = spark.read.schema(ENTRY).option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in _NO_TABLE:
                raise
            return spark.createDataFrame([], f"batch_id bigint, {ENTRY}")
        return found.select(F.col("batch_id").cast("bigint").alias("batch_id"), "target", "state", "attempts", "error")

    def done(self, spark: SparkSession, batch_id: int) -> set[str]:
        """Targets of the batch that need no writing any more. At most one for each route."""
        return {r.target for r in self.entries(spark).where(F.col("batch_id") == batch_id).select("target").distinct().collect()}

    def enter(self, spark: SparkSession, batch_id: int, target: str, state: str, attempts: int, error: str | None = None) -> None:
        row = spark.createDataFrame([(target, state, attempts, error)], ENTRY).coalesce(1)
        # A folder of its own: targets are written side by side, and Spark's writers share no folder.
        name = hashlib.sha256(target.encode()).hexdigest()[:16]
        row.write.mode("overwrite").parquet(f"{self.path}/batch_id={int(batch_id)}/entry=t{name}")
