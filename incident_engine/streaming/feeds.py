"""Live feeds: messages in, CSV out, one checkpoint per feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from incident_engine.operators.records import (
    chicago_file_layout,
    chicago_view,
    parse_records,
    seattle_view,
)
from incident_engine.schemas import CHICAGO_RECORD, SEATTLE_RECORD
from incident_engine.sinks.batch_log import logged_batch_writer
from incident_engine.sinks.files import csv_batch_writer
from incident_engine.sources.changes import stream_changes
from incident_engine.sources.messages import MessageSource, stream_messages

POLL = "1 minute"


@dataclass(frozen=True)
class FeedSpec:
    """A feed: its record schema, the fields it reads, the layout it writes."""

    name: str
    schema: StructType
    layout: Callable[[DataFrame], DataFrame]
    fields: tuple[str, ...] | None = None
    bad_rows: str = "keep"

    def rows(self, messages: DataFrame) -> DataFrame:
        """Messages to output rows; the same for batch and stream."""
        return self.layout(parse_records(messages, self.schema, self.bad_rows, self.fields))


# The Chicago files do not hold the location, so it is not parsed.
CHICAGO = FeedSpec(
    "chicago", CHICAGO_RECORD, lambda df: chicago_file_layout(chicago_view(df)),
    fields=tuple(name for name in CHICAGO_RECORD.fieldNames() if name != "location"),
)
SEATTLE = FeedSpec("seattle", SEATTLE_RECORD, seattle_view)


def start_feed(spark: SparkSession, feed: FeedSpec, source: MessageSource, output: str,
               checkpoint: str, files: int | None = None, poll: str | None = POLL,
               writer: Callable = csv_batch_writer) -> StreamingQuery:
    """Start one feed. With ``poll=None`` it takes what is there and ends.

    The layout is applied before ``foreachBatch``, so that the batch holds the
    written columns only. ``checkpoint`` must be this feed's own. ``writer`` is
    ``csv_batch_writer`` (a folder per batch id) or ``logged_csv_writer`` (a folder
    per attempt and a log of those that count).
    """
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    return (
        feed.rows(stream_messages(spark, source))
        .writeStream.queryName(f"feed-{feed.name}")
        .foreachBatch(writer(output, files))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_feeds(spark: SparkSession, feeds: dict[FeedSpec, MessageSource], root: str,
                **options) -> list[StreamingQuery]:
    """Independent queries in one session; output and checkpoint folders by feed name."""
    return [
        start_feed(spark, feed, source, f"{root}/{feed.name}/rows",
                   f"{root}/{feed.name}/checkpoint", **options)
        for feed, source in feeds.items()
    ]


def start_pull_stream(spark: SparkSession, path: str, schema: StructType | str, update: str,
                      output: str, checkpoint: str, poll: str | None = POLL) -> StreamingQuery:
    """Pull the changed rows of the table at ``path`` into committed Parquet batches.

    The offset of the query is the mark: a restart goes on behind the last committed
    batch, and a batch that is replayed has the same rows and is written once.
    """
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    return (
        stream_changes(spark, path, schema, update)
        .writeStream.queryName("pull-changes")
        .foreachBatch(logged_batch_writer(output, lambda rows, to: rows.write.parquet(to)))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_pull(spark: SparkSession, pull: Callable[[], int], checkpoint: str,
               poll: str = "1 hour") -> StreamingQuery:
    """Run a pull cycle at every poll, as a streaming query that can be watched and stopped.

    ``pull`` is a cycle such as ``pull_once`` on a table; the rows it moves never
    pass through this query, whose own rows only mark the time.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.queryName("pull")
        .foreachBatch(lambda _batch, _id: pull())
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=poll)
        .start()
    )
