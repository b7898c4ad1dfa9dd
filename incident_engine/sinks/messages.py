"""Keyed JSON messages, and sinks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.sources.messages import MessageSource


def keyed_json(records: DataFrame, key: str, keep_null_key: bool = False) -> DataFrame:
    """``key, value``: the record id and the record as JSON.

    Rows without an id are left out, or sent with a null key.
    """
    has_key = F.col(key).isNotNull() & (F.col(key) != "")
    rows = records if keep_null_key else records.filter(has_key)
    return rows.select(
        F.when(has_key, F.col(key).cast("string")).alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


def table_json(table: DataFrame) -> DataFrame:
    """Every row as a JSON message without a key; nulls are written as ``null``."""
    return table.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


def routed_by_month(records: DataFrame, month: str = "month") -> DataFrame:
    """Messages whose topic is the month text of their own row."""
    return records.select(
        F.col(month).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


def write_messages(messages: DataFrame, sink: MessageSource, mode: str = "append",
                   compact: bool = False) -> None:
    """Write to Kafka, or to files; a ``topic`` column becomes the file partition.

    With one topic named by the sink every row goes there. Files are written
    where the rows are, one per task and topic. ``compact`` has Spark gather
    each topic first, which costs a shuffle; it splits big topics over tasks.
    """
    rows = messages
    if sink.topics:
        if len(sink.topics) > 1:
            raise ValueError("a sink takes one topic; give each row its own in a topic column")
        rows = rows.withColumn("topic", F.lit(sink.topics[0]))
    if sink.format == "kafka":
        rows.write.format("kafka").options(**sink.options).save()
        return
    if compact and "topic" in rows.columns:
        rows = rows.hint("rebalance", "topic")
    writer = rows.write.format(sink.format).mode(mode).options(**sink.options)
    if "topic" in rows.columns:
        writer = writer.partitionBy("topic")
    writer.save()
