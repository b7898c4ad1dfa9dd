"""Streams equal batch; restart and replay add nothing."""

import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from incident_engine.catalog import feeds as catalog
from incident_engine.plans.collect import collect_changes
from incident_engine.schemas import CHICAGO_FILE, SEATTLE_VIEW
from incident_engine.sources.messages import MessageSource, stream_messages
from incident_engine.sources.pull import load_mark
from incident_engine.streaming.feeds import (
    CHICAGO,
    SEATTLE,
    FeedSpec,
    start_feed,
    start_feeds,
    start_pull,
)
from incident_engine.streaming.supervise import run_with_restart


def split_files(messages, path, files, seed):
    rng = random.Random(seed)
    shares = [rng.uniform(0.2, 1) for _ in range(files)]
    for part in messages.randomSplit(shares, seed):
        part.coalesce(1).write.mode("append").parquet(path)


def source(path, *topics):
    return MessageSource("parquet", topics, {"path": path, "maxFilesPerTrigger": "2"})


@pytest.mark.parametrize("feed, columns, make", [
    (CHICAGO, CHICAGO_FILE, catalog.chi_messages), (SEATTLE, SEATTLE_VIEW, catalog.sea_messages)])
def test_stream_equals_batch_and_restart_adds_nothing(spark, small, tmp_path, feed, columns, make):
    messages = make(spark, small)
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    split_files(messages, inbox, 5, seed=7)
    for _ in range(2):
        query = start_feed(spark, feed, source(inbox), out, checkpoint, poll=None)
        query.awaitTermination()
        df = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(out)
        batch = feed.rows(messages)
        want = batch.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
        assert df.select(*[f"`{c}`" for c in columns]).exceptAll(want).count() == 0
        assert df.count() == messages.count()
    # New messages alone are read by a later run.
    split_files(messages.limit(10), inbox, 1, seed=8)
    start_feed(spark, feed, source(inbox), out, checkpoint, poll=None).awaitTermination()
    assert spark.read.csv(out).count() == messages.count() + 10


def test_two_feeds_are_independent(spark, small, tmp_path):
    inbox = str(tmp_path / "in")
    catalog.chi_messages(spark, small).write.parquet(inbox)
    catalog.sea_messages(spark, small).write.mode("append").parquet(inbox)
    sources = {CHICAGO: source(inbox, "chicago"), SEATTLE: source(inbox, "seattle")}
    queries = start_feeds(spark, sources, str(tmp_path / "root"), poll=None)
    for query in queries:
        query.awaitTermination()
    assert {q.name for q in queries} == {"feed-chicago", "feed-seattle"}
    n = catalog.chi_messages(spark, small).count()
    for name in ("chicago", "seattle"):
        assert spark.read.csv(str(tmp_path / "root" / name / "rows")).count() == n


def test_only_written_fields_are_parsed(spark, small):
    df = CHICAGO.rows(catalog.chi_messages(spark, small))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    parse = plan[plan.index("from_json("):plan.index("StructsToJson")]
    assert "StructField(updated_on,TimestampType" in parse and "StructField(location," not in parse


def test_restart_after_failure_resumes_from_the_checkpoint(spark, small, tmp_path):
    messages = catalog.chi_messages(spark, small)
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    split_files(messages, inbox, 4, seed=1)
    fails = {"left": 2}

    def start():
        rows = CHICAGO.rows(stream_messages(spark, source(inbox)))

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            if batch_id == 1 and fails["left"]:
                fails["left"] -= 1
                raise IOError("the store is away")

        return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())

    assert run_with_restart(start, max_restarts=3, wait_seconds=0) == 2
    df = spark.read.parquet(out)
    assert df.count() == messages.count() and df.select("ID").distinct().count() == messages.count()


def test_restarts_are_bounded(spark, small, tmp_path):
    inbox = str(tmp_path / "in")
    catalog.chi_messages(spark, small).limit(5).coalesce(1).write.parquet(inbox)
    starts = []
    bad = FeedSpec("bad", CHICAGO.schema, lambda df: df.select(F.raise_error(F.lit("broken")).alias("x")))

    def start():
        starts.append(1)
        return start_feed(spark, bad, source(inbox), str(tmp_path / "o"), str(tmp_path / "c"), poll=None)

    with pytest.raises(StreamingQueryException):
        run_with_restart(start, max_restarts=1, wait_seconds=0)
    assert len(starts) == 2


def test_pull_emits_each_change_once_and_moves_the_mark(spark, tmp_path):
    table, state, out = (str(tmp_path / n) for n in ("table", "marks", "out"))
    row = "select '{}' as id, '2025-01-0{}' as updated_on"
    spark.sql(row.format("a", 1)).write.parquet(table)
    sink = MessageSource("parquet", ("feed",), {"path": out})
    cycles = []

    def pull():
        spark.catalog.refreshByPath(table)
        cycles.append(collect_changes(spark.read.parquet(table), "updated_on", "id", state, "feed", sink))

    def wait(count):
        deadline = time.time() + 60
        while sum(cycles) < count and time.time() < deadline:
            time.sleep(0.2)

    query = start_pull(spark, pull, str(tmp_path / "cp"), poll="1 second")
    try:
        wait(1)
        spark.sql(row.format("b", 2)).write.mode("append").parquet(table)
        wait(2)
        done = len(cycles)
        while len(cycles) < done + 2:
            time.sleep(0.2)
    finally:
        query.stop()
    assert sum(cycles) == 2 and len(cycles) >= 4
    assert sorted(r["key"] for r in spark.read.parquet(out).collect()) == ["a", "b"]
    assert load_mark(spark, state, "feed") == "2025-01-02"
