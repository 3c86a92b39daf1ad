"""Computing costly columns once.

Spark moves a filter below the projection that computes its column and puts the whole
expression into the filter, where parts that were shared are computed again and again.
For a parsed and typed row that can cost many parses per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows, with ``columns`` behind a one-row generator.

    Filters on these columns stay above it, so they read finished values; filters on
    all other columns still reach the scan. The columns must exist in ``df``.
    """
    rest = [c for c in df.columns if c not in columns]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    fenced = df.select(*[F.col(f"`{c}`") for c in rest], F.inline_outer(F.array(row)))
    return fenced.select(*[F.col(f"`{c}`") for c in df.columns])


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and generators shall not compute again."""
    return fence(df.withColumns(columns), list(columns))
