"""Scores and classes computed per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine.functions.columns import ColumnLike, as_column
from incident_engine.schemas import HIT_THRESHOLD


def classify(value: ColumnLike, classes: dict[str, list[str]], default: str) -> Column:
    """Name of the first class that lists ``value``; null and the rest take the default."""
    first, *others = classes.items()
    start = F.when(as_column(value).isin(first[1]), first[0])
    chain = reduce(lambda acc, kv: acc.when(as_column(value).isin(kv[1]), kv[0]), others, start)
    return chain.otherwise(default)


def chance_of_any(mean: ColumnLike) -> Column:
    """Poisson probability of at least one event at the given mean."""
    return 1 - F.exp(-as_column(mean))


def hit_flag(chance: ColumnLike, actual: ColumnLike, threshold: float = HIT_THRESHOLD) -> Column:
    hit = (as_column(chance) > threshold) & (as_column(actual) > 0)
    return F.when(hit, 1).otherwise(0)


def at_least_zero(value: ColumnLike) -> Column:
    return F.greatest(as_column(value), F.lit(0.0))
