"""Incremental pull: rows changed since a high-water mark.

The mark is of the same type as the update column and is compared as that
type; a time is stored in UTC, so the session zone does not matter. Marks are
kept per feed in a commit log, where a new one is added only behind the one it
was compared with: of two pullers that started from the same mark one moves it
and the other is told. The log folds itself, so it stays short.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampType

from incident_engine.schemas import PAGE_SIZE
from incident_engine.sources.commit_log import CommitLog


class MarkMovedError(RuntimeError):
    """Another puller moved the mark meanwhile; the rows of this cycle were sent by both."""


def rows_since(table: DataFrame, update_field: str, mark: str | None, inclusive: bool = False,
               key: str | None = None) -> DataFrame:
    """Rows past the mark; everything when there is none.

    ``inclusive`` also takes rows that share the mark, for feeds whose late rows
    do; ``key`` then removes the copies of rows seen in the same pull.
    """
    if mark is None:
        return table
    updated = F.col(update_field)
    limit = F.lit(mark).cast(table.schema[update_field].dataType)
    rows = table.filter(updated >= limit if inclusive else updated > limit)
    return rows.dropDuplicates([key]) if inclusive and key else rows


def page(table: DataFrame, update_field: str, key: str, offset: int = 0,
         limit: int = PAGE_SIZE) -> DataFrame:
    """One page, latest change first; the key makes the order total."""
    return table.orderBy(F.desc(update_field), key).offset(offset).limit(limit)


def next_mark(table: DataFrame, update_field: str, mark: str | None) -> DataFrame:
    """Greatest update value or the old mark, whichever is later."""
    old = F.lit(mark).cast(table.schema[update_field].dataType)
    return table.agg(F.greatest(F.max(update_field), old).alias("next_mark"))


def mark_log(spark: SparkSession, path: str, feed: str) -> CommitLog:
    return CommitLog(spark, f"{path}/{quote(feed, safe='')}", fold=lambda entries: entries[-1:])


def _last(log: CommitLog) -> tuple[int, str | None]:
    number, entries = log.read()
    return number, entries[-1]["mark"] if entries else None


def load_mark(spark: SparkSession, path: str, feed: str) -> str | None:
    """Last saved mark of the feed, or nothing when none was ever saved."""
    return _last(mark_log(spark, path, feed))[1]


def _moves(spark: SparkSession, mark: str | None, old: str | None, kind: DataType) -> bool:
    return mark is not None and (old is None or spark.range(1).select(
        F.lit(mark).cast(kind) > F.lit(old).cast(kind)).first()[0])


def save_mark(spark: SparkSession, path: str, feed: str, mark: str | None,
              kind: DataType = StringType()) -> bool:
    """Add the mark if it is ahead of the last one, whoever saved that; tells whether it was."""
    log = mark_log(spark, path, feed)
    while True:
        number, old = _last(log)
        if not _moves(spark, mark, old, kind):
            return False
        if log.commit(number, {"mark": mark}):
            return True


def pull_once(table: DataFrame, update_field: str, state: str, feed: str, sink,
              inclusive: bool = False, key: str | None = None) -> int:
    """One pull cycle; returns the number of rows handed to ``sink(rows)``.

    The sink runs over the table once; the new mark is observed on the way and
    saved only after the sink came back. A failed sink leaves the mark alone,
    so the next cycle sends the same rows again and none is lost. If another
    puller moved the mark while the sink ran, MarkMovedError is raised and the
    mark is left to the other. ``inclusive`` and ``key`` are those of ``rows_since``.
    """
    spark = table.sparkSession
    kind = table.schema[update_field].dataType
    log = mark_log(spark, state, feed)
    number, old = _last(log)
    rows = rows_since(table, update_field, old, inclusive, key)
    seen = Observation(f"pull-{feed}")
    latest = F.max(update_field)
    timed = isinstance(kind, TimestampType)
    latest = F.unix_micros(latest) if timed else latest.cast("string")
    sink(rows.observe(seen, F.count(F.lit(1)).alias("rows"), latest.alias("mark")))
    mark = seen.get["mark"]
    if timed and mark is not None:
        mark = (datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=mark)).isoformat()
    if _moves(spark, mark, old, kind) and not log.commit(number, {"mark": mark}):
        raise MarkMovedError(f"the mark of {feed} is no longer {old}")
    return seen.get["rows"]
