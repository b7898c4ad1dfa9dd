"""Message sources: Kafka when its connector is on the class path, files else.

Every source yields ``key binary, value binary, topic string`` (Kafka adds its
own columns), so the rest of the library does not know the difference.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_DDL = "key binary, value binary, topic string"


@dataclass(frozen=True)
class MessageSource:
    """Where messages come from; ``options`` go to Spark as they are."""

    format: str = "kafka"
    topics: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)


def read_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """All messages from the earliest to the current end, all topics in one scan."""
    return _load(spark.read, source, "earliest")


def stream_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """New messages; the checkpoint decides the start from the second run on."""
    return _load(spark.readStream, source, "latest")


def _load(reader, source: MessageSource, start: str) -> DataFrame:
    if source.format == "kafka":
        defaults = {"subscribe": ",".join(source.topics), "startingOffsets": start}
        if start == "latest":
            defaults["failOnDataLoss"] = "false"
        return reader.format("kafka").options(**(defaults | source.options)).load()
    messages = reader.format(source.format).schema(MESSAGE_DDL).options(**source.options).load()
    return only_topics(messages, *source.topics) if source.topics else messages


def only_topics(messages: DataFrame, *topics: str) -> DataFrame:
    """Messages of the given topics; prunes files that are partitioned by topic."""
    return messages.filter(F.col("topic").isin(*topics))


def as_messages(df: DataFrame, key: Column, value: Column, topic: Column) -> DataFrame:
    """Shape any frame like a message source."""
    return df.select(
        key.cast("binary").alias("key"), value.cast("binary").alias("value"), topic.alias("topic")
    )
