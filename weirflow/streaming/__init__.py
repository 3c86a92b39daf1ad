"""Running the operators over streams."""

from weirflow.streaming.batches import Landing, batch_log, run_batches
from weirflow.streaming.counters import counted, counter_totals, stored_counts
from weirflow.streaming.limiter import rate_limit_stream, window_limit_stream
from weirflow.streaming.run import counters, observed, partition_by_key, read_stream, run_stream, run_with_retries

__all__ = [
    "Landing",
    "batch_log",
    "counted",
    "counter_totals",
    "counters",
    "observed",
    "partition_by_key",
    "rate_limit_stream",
    "read_stream",
    "run_batches",
    "run_stream",
    "run_with_retries",
    "stored_counts",
    "window_limit_stream",
]
