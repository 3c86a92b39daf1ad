"""Connected components by star contraction, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import stored


def _toward_min(pairs: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """Links each partner of a node to the least of the node and its partners.

    ``pairs`` (u, v) are read as partners v of u; ``keep`` picks the partners moved.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved, least


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node reachable.

    Large-star and small-star rounds in turn; each keeps at most as many links as it got,
    and is stored in the shared folder. Rounds grow with the logarithm of a component.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    links = stored(links.distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = _toward_min(both, "v > u")
        large = large.where("u != v").distinct()
        small, least = _toward_min(large, F.lit(True))
        down = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        after = stored(down, "links")
        # Nothing changed: every node hangs on its component's least node.
        same = _digest(after) == _digest(links)
        links = after
        if same:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _digest(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = links.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.x, row.s
