"""Sharding: a two-pass external shuffle.

Pass one scatters rows uniformly into memory-sized buckets by a seeded hash and stores
them. Pass two reads bucket by bucket, shuffles each by Fisher-Yates (Spark's
``shuffle``) and numbers the rows: bucket after bucket they form one random order, whose
row ``r`` goes to shard ``r mod n`` at slot ``r div n``. Shard counts are at most one
apart and slots have no gaps, whatever keys or texts repeat.

The scatter hash takes the row's place in the scan besides its id, so that a third of all
rows under one id spread like the rest. Storing pass one fixes that choice: a task that
runs again reads the same buckets. A bucket is one array in one task; its expected size
is ``bucket_bytes``, whatever the table's size.

Defined results: a null id hashes like any value, a null text has no bytes, repeated rows
are separate rows, an empty table gives an empty result. Input columns named like a
result column (shard, slot) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirflow.llm.common import shuffle_parts, stored

SEED = 20240229


def row_bytes(docs: DataFrame, text_col: str = "text"):
    """UTF-8 bytes of the text and 16 for the rest of the row."""
    return F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + 16


def shard_rows(
    docs: DataFrame,
    shards: int,
    size: str | None = None,
    id_col: str = "doc_id",
    bucket_bytes: int = 8 << 20,
    row_overhead: int = 64,
    seed: int = SEED,
) -> DataFrame:
    """All rows with ``shard`` and ``slot``, in a random order.

    The order follows the seed for the same partitions of the input only: the scatter takes a
    row's place in the scan, and Spark's shuffle draws by partition and arrival. It is fixed
    where buckets and result are stored. Shards and counts are right for any partitions.

    ``size`` names a column with the bytes of a row, ``row_overhead`` what a row takes
    besides. Buckets are made for ``bucket_bytes`` each, and at least one for each
    shuffle partition.
    """
    if shards < 1:
        raise ValueError("shards: at least 1")
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    payload = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    of_row = F.col(f"`{size}`") if size else F.lit(0)
    point = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.monotonically_increasing_id())
    scattered = stored(
        docs.select(point.alias("point"), (of_row + row_overhead).cast("long").alias("bytes"), payload),
        "scatter",
    )
    total = scattered.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = max(-(-int(total) // bucket_bytes), shuffle_parts(spark))
    scattered = scattered.withColumn("bucket", F.pmod("point", F.lit(buckets)))
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # Sorting first makes the order depend on the rows alone, not on their arrival.
    held = F.array_sort(F.collect_list(F.struct("point", "row"))).alias("rows")
    bags = scattered.groupBy("bucket").agg(held).join(starts, "bucket")
    mixed = bags.select("start", F.posexplode(F.shuffle("rows", seed)).alias("at", "item"))
    rank = F.col("start") + F.col("at")
    return mixed.select(
        "item.row.*",
        F.pmod(rank, F.lit(shards)).cast("int").alias("shard"),
        F.floor(rank / shards).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str, shards: int) -> None:
    """One folder for each shard, its rows in slot order.

    A shard is sorted by range of slots, so that its rows never meet in one task unless
    they fit one partition of the sort.
    """
    ordered = sharded.repartitionByRange(max(shards, shuffle_parts(sharded.sparkSession)), "shard", "slot")
    ordered.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
