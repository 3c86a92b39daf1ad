"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.session import checkpoint_root

#: What separates words: space and the ASCII controls tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared place that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_root(spark)}/weirflow-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder, and read from there.

    A lost executor then costs a re-read, never a second computation that might
    deal rows out differently.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id (long) and text, a null text being empty. Other columns are left out."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def release() -> None:
    """Give memory that Arrow and the C library keep for later back to the machine, at the end of a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
