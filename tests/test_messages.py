"""Message sources and sinks. The Kafka connector is not on the test class path,
so files of the same shape stand in for it."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from incident_engine.sinks import messages as sinks
from incident_engine.sources.messages import MessageSource, as_messages, read_messages


@pytest.fixture(scope="module")
def message_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topics") / "messages")
    df = spark.range(12).withColumn("month", F.format_string("2024-%02d", F.col("id") % 4 + 1))
    sinks.write_messages(sinks.routed_by_month(df), MessageSource("parquet", options={"path": path}))
    return path


def test_rows_go_to_the_topic_of_their_month(spark, message_files):
    raw = spark.read.parquet(message_files)
    assert raw.filter(F.get_json_object("value", "$.month") != F.col("topic")).count() == 0
    assert raw.select("topic").distinct().count() == 4


def test_many_topics_in_one_scan(spark, message_files, tmp_path):
    table = str(tmp_path / "binary")
    as_messages(spark.read.parquet(message_files), F.col("key"), F.col("value"), F.col("topic")
                ).write.partitionBy("topic").parquet(table)
    source = MessageSource("parquet", ("2024-01", "2024-03"), {"path": table})
    df = read_messages(spark, source)
    assert df.columns == ["key", "value", "topic"] and df.count() == 6
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [topic" in plan
    assert read_messages(spark, MessageSource("parquet", options={"path": table})).count() == 12


def test_kafka_options(spark):
    """Without the connector, the request names Kafka and fails there."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_messages(spark, MessageSource(topics=("a", "b"), options={"kafka.bootstrap.servers": "x:1"}))


def rows(df):
    return [(r["key"], json.loads(r["value"])) for r in df.collect()]


def test_keyed_json(spark):
    df = spark.createDataFrame([("1", "a"), ("", "b"), (None, "c")], "id string, v string")
    assert rows(sinks.keyed_json(df, "id")) == [("1", {"id": "1", "v": "a"})]
    assert rows(sinks.keyed_json(df, "id", keep_null_key=True)) == [
        ("1", {"id": "1", "v": "a"}), (None, {"id": "", "v": "b"}), (None, {"v": "c"})]


def test_table_json_keeps_nulls(spark):
    df = spark.createDataFrame([("1", None)], "`DR_NO` string, `Cross Street` string")
    assert rows(sinks.table_json(df)) == [(None, {"DR_NO": "1", "Cross Street": None})]


def test_one_topic_for_all(spark, tmp_path):
    path = str(tmp_path / "m")
    sink = MessageSource("parquet", ("only",), {"path": path})
    sinks.write_messages(sinks.keyed_json(spark.range(3).withColumn("id", F.col("id").cast("string")), "id"), sink)
    assert [r["topic"] for r in spark.read.parquet(path).collect()] == ["only"] * 3
    with pytest.raises(ValueError, match="one topic"):
        sinks.write_messages(spark.range(1), MessageSource("parquet", ("a", "b")))


def test_compact_gathers_a_topic(spark, tmp_path):
    df = spark.range(0, 400, 1, 8).selectExpr("concat('t', id % 2) as month", "id")
    counts = {}
    for compact in (False, True):
        path = str(tmp_path / f"compact-{compact}")
        sinks.write_messages(sinks.routed_by_month(df), MessageSource("parquet", options={"path": path}),
                             compact=compact)
        out = spark.read.parquet(path)
        assert out.count() == 400
        counts[compact] = len(out.inputFiles())
    assert counts == {False: 16, True: 2}
