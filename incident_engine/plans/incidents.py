"""The merged incident table and the refresh of the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_engine.functions import text, timestamps
from incident_engine.operators import records
from incident_engine.operators.sets import union_all
from incident_engine.schemas import CHICAGO_RECORD, LA_RECORD, UK_RECORD
from incident_engine.sinks.files import write_csv


def unified_incidents(la_messages: DataFrame, uk_messages: DataFrame) -> DataFrame:
    """LA and UK messages as one incident table. Map-only: no shuffle."""
    return union_all(
        records.la_incidents(records.parse_records(
            la_messages, LA_RECORD, fields=records.LA_INCIDENT_FIELDS)),
        records.uk_incidents(records.parse_records(
            uk_messages, UK_RECORD, fields=records.UK_INCIDENT_FIELDS)),
    )


def archive_rows(archive: DataFrame) -> DataFrame:
    """Archive rows with their 12-hour date texts parsed."""
    return archive.withColumns({
        name: timestamps.parse_12h(name) for name in ("Date", "Updated On")
    })


def updated_until(df: DataFrame, cutoff: Column | str, column: str = "Updated On") -> DataFrame:
    """Snapshot filter; a text cut-off is taken as a time."""
    limit = F.lit(cutoff).cast("timestamp") if isinstance(cutoff, str) else cutoff
    return df.filter(F.col(column) <= limit)


def streamed_rows(messages: DataFrame) -> DataFrame:
    """Chicago messages under the archive's column names, coordinates as numbers."""
    rows = records.align_titles(records.parse_records(messages, CHICAGO_RECORD))
    return rows.withColumns({name: text.to_double(name) for name in ("latitude", "longitude")})


def archive_merge(archive: DataFrame, streamed: DataFrame) -> DataFrame:
    """Archive and streamed rows by name; columns of one side only are null on the other."""
    return union_all(archive, streamed, allow_missing=True)


def audit_counts(df: DataFrame, **stages: Column) -> DataFrame:
    """Row counts at named stages in one pass: ``stage, n``.

    A stage is a condition; its count is the rows that meet it.
    """
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in stages.items()])
    return counts.unpivot([], list(stages), "stage", "n")


def latest_updates(df: DataFrame, column: str, key: str, count: int = 5) -> DataFrame:
    """Newest rows first; Spark keeps only ``count`` rows per task."""
    return df.orderBy(F.desc(column), key).limit(count)


def refresh_archive(archive: DataFrame, messages: DataFrame, cutoff: str, output: str,
                    files: int | None = None) -> None:
    """Rewrite the archive: rows up to the cut-off, then the streamed ones.

    ``output`` must not be a folder that ``archive`` reads from.
    """
    kept = updated_until(archive_rows(archive), cutoff)
    write_csv(archive_merge(kept, flat(streamed_rows(messages))), output, files)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is what a CSV file can hold."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    return df.withColumns({name: F.to_json(name) for name in nested})
