"""Topic patterns: ``+`` stands for one level, ``#`` for all that follow."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_pattern(pattern: str) -> tuple[list[str], bool]:
    """Levels before the first ``#`` and whether there is one; the rest is unused."""
    levels = pattern.split("/")
    if "#" in levels:
        return levels[: levels.index("#")], True
    return levels, False


def topic_matches(topic: Column, pattern: str, hash_matches_parent: bool = False) -> Column:
    """Whether a topic matches a pattern.

    ``+`` also takes an empty level. ``#`` needs at least one level, unless
    ``hash_matches_parent`` lets ``a/#`` match ``a`` too. Plain equality and prefix
    tests are used where they say the same as the regular expression.
    """
    head, rest = split_pattern(pattern)
    if "+" not in head:
        prefix = "/".join(head)
        if not rest:
            return topic == F.lit(prefix)
        if not head:
            return topic.isNotNull()
        hit = topic.startswith(prefix + "/")
        return hit | (topic == F.lit(prefix)) if hash_matches_parent else hit
    body = "/".join("[^/]*" if level == "+" else re.escape(level) for level in head)
    if rest:
        body += "(?:/(?s:.)*)?" if hash_matches_parent else "/(?s:.)*"
    return F.rlike(topic, F.lit(rf"\A{body}\z"))


def valid_topic(topic: Column) -> Column:
    """Exactly ``/{namespace}/{name}``."""
    return F.rlike(topic, F.lit(r"\A/[^/]+/[^/]+\z"))


def effective_reliable(qos: Column, explicit: Column) -> Column:
    """Delivery class: the explicit flag, else any quality of service above zero."""
    return F.coalesce(explicit, qos != 0)
