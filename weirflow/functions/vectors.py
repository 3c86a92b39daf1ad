"""Similarity of two arrays, as expressions. Computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.specs import DISTANCES


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _pairwise(a: Column, b: Column, f) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double"))))


def dot(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(_pairwise(a, b, lambda x, y: (x - y) * (x - y)))


def manhattan(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: F.abs(x - y))


_METRICS = {"cosine": cosine, "dot": dot, "euclid": euclid, "manhattan": manhattan}


def similarity(metric: str, a: Column, b: Column) -> Column:
    return _METRICS[metric](a, b)


def higher_is_better(metric: str) -> bool:
    return DISTANCES[metric]
