"""Set operations: every merge is by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL of any number of frames, columns matched by name."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def preview(df: DataFrame, count: int = 20) -> DataFrame:
    """Some rows to look at: of as few partitions as hold ``count`` of them, without a shuffle of
    the rest. Which rows is not defined; for the newest see ``latest_updates``."""
    return df.limit(count)
