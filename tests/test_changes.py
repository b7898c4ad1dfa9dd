"""The mark as a stream's offset, the batch log, the commit log, and supervision of several queries."""

import threading
import time
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from incident_engine.catalog import feeds as catalog
from incident_engine.sinks.batch_log import batch_log, committed, logged_batch_writer, read_batches
from incident_engine.sources import pull
from incident_engine.sources.changes import ChangeReader, stream_changes
from incident_engine.sources.commit_log import CommitLog
from incident_engine.sources.messages import MessageSource, stream_messages
from incident_engine.streaming.feeds import CHICAGO, SEATTLE, start_feed, start_pull_stream
from incident_engine.streaming.supervise import Supervisor

# Commit log


def test_of_two_writers_behind_one_entry_one_wins(spark, tmp_path):
    one, two = (CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert one.read() == (0, [])
    assert one.commit(0, {"by": 1}) and not two.commit(0, {"by": 2})
    assert two.commit(1, {"by": 2}) and not one.commit(1, {"by": 1})
    assert one.read() == two.read() == (2, [{"by": 1}, {"by": 2}])


@pytest.mark.parametrize("fold", [list, lambda entries: entries[-1:]])
def test_log_stays_short_and_keeps_what_fold_keeps(spark, tmp_path, fold):
    log = CommitLog(spark, str(tmp_path / "log"), fold, compact_every=4)
    for n in range(1, 23):
        assert log.append({"n": n}) == n
        assert len(list((tmp_path / "log").glob("*.entry"))) < 4
        assert len(list((tmp_path / "log").glob("*.summary"))) <= 1
    last, entries = log.read()
    assert last == 22 and entries[-1] == {"n": 22}
    if fold is list:
        assert [e["n"] for e in entries] == list(range(1, 23))
    # a writer that slept through it cannot take a number whose file was folded away
    assert not log.commit(5, {"n": "late"}) and log.read() == (last, entries)


def test_many_writers_lose_nothing(spark, tmp_path):
    def work(name):
        log = CommitLog(spark, str(tmp_path / "log"), compact_every=4)
        for i in range(8):
            log.append({"by": name, "i": i})

    threads = [threading.Thread(target=work, args=(n,)) for n in range(3)]
    [t.start() for t in threads], [t.join() for t in threads]
    last, entries = CommitLog(spark, str(tmp_path / "log"), compact_every=4).read()
    assert last == 24
    assert sorted((e["by"], e["i"]) for e in entries) == [(n, i) for n in range(3) for i in range(8)]


def test_two_pullers_cannot_both_move_the_mark(spark, tmp_path):
    state = str(tmp_path / "marks")
    rows = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02")], "id string, u string")

    def slow(new):
        new.collect()
        # meanwhile another puller runs a whole cycle
        assert pull.pull_once(rows, "u", state, "f", lambda r: r.collect()) == 2

    with pytest.raises(pull.MarkMovedError):
        pull.pull_once(rows, "u", state, "f", slow)
    assert pull.load_mark(spark, state, "f") == "2025-01-02"
    assert pull.pull_once(rows, "u", state, "f", lambda r: r.collect()) == 0
    assert pull.load_mark(spark, state, "a/b") is None


# Changes


def run(spark, path, schema, update, out, checkpoint):
    query = start_pull_stream(spark, path, schema, update, out, checkpoint, poll=None)
    query.awaitTermination()
    return query


KINDS = {
    "timestamp": lambda i: datetime(2025, 1, 1, 0, 0, i), "timestamp_ntz": None, "long": None,
    "string": None, "date": None, "int": None, "double": None}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_every_change_comes_once_over_restarts(spark, tmp_path, kind):
    value = {"timestamp": "timestamp_seconds(1736000000 + id * 7)",
             "timestamp_ntz": "cast(timestamp_seconds(1736000000 + id * 7) as timestamp_ntz)",
             "date": "date_add(date '2024-12-30', cast(id as int))", "string": "lpad(id, 5, '0')",
             "long": "id", "int": "cast(id as int)", "double": "id / 8"}[kind]
    table, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "cp"))
    rows = spark.range(0, 90, 1, 3).selectExpr("id", f"{value} as u")
    for n, part in enumerate([rows.filter("id < 9"), rows.filter("id between 9 and 40"), None,
                              rows.filter("id > 40")]):
        if part is not None:
            part.write.mode("append").parquet(table)
        run(spark, table, rows.schema, "u", out, checkpoint)
        assert len(committed(spark, out)) == (n if n > 1 else n + 1)
    got = read_batches(spark, out, rows.schema, "parquet")
    assert got.groupBy("id").count().filter("count != 1").isEmpty()
    assert got.select("id", "u").exceptAll(rows).isEmpty() and got.count() == 90
    sizes = {r["batch_id"]: r["count"] for r in got.groupBy("batch_id").count().collect()}
    assert sizes == {0: 9, 1: 32, 2: 49}
    assert [e["rows"] for e in committed(spark, out)] == [9, 32, 49]


def test_marks_do_not_depend_on_the_session_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    table, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "cp"))
    rows = spark.range(4).selectExpr("id", "timestamp_seconds(1736000000 + id * 3600) as u")
    try:
        for n, at in enumerate(["UTC", "America/Chicago", "Asia/Tokyo", "UTC"]):
            spark.conf.set("spark.sql.session.timeZone", at)
            rows.filter(f"id = {n}").write.mode("append").parquet(table)
            run(spark, table, rows.schema, "u", out, checkpoint)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    got = read_batches(spark, out, rows.schema, "parquet")
    assert sorted((r["id"], r["batch_id"]) for r in got.collect()) == [(i, i) for i in range(4)]


def test_nulls_missing_columns_and_an_empty_folder(spark, tmp_path):
    table, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "cp"))
    schema = "id long, u string, extra int"
    run(spark, table, schema, "u", out, checkpoint)
    assert read_batches(spark, out, schema, "parquet").isEmpty()
    assert sum(e["rows"] for e in committed(spark, out)) == 0
    spark.sql("select 1L id, '2025' u union all select 2L, null").write.parquet(table)
    spark.sql("select 3L id, '2024' u, 5 extra, 'z' other").write.mode("append").parquet(table)
    run(spark, table, schema, "u", out, checkpoint)
    got = sorted(map(tuple, read_batches(spark, out, schema, "parquet").select("id", "extra").collect()))
    assert got == [(1, None), (2, None), (3, 5)]


def test_files_at_or_below_the_mark_are_not_opened(spark, tmp_path):
    table = str(tmp_path / "t")
    for n in range(5):
        spark.range(n * 10, n * 10 + 10).selectExpr("id", "id as u").coalesce(1) \
            .write.mode("append").parquet(table)
    schema = spark.read.parquet(table).schema
    reader = ChangeReader(schema, table, "u")
    assert reader.latestOffset() == {"mark": "49"}
    assert len(reader.partitions({"mark": None}, {"mark": "49"})) == 5
    pieces = reader.partitions({"mark": "25"}, {"mark": "39"})
    assert len(pieces) == 2
    assert sum(b.num_rows for p in pieces for b in reader.read(p)) == 14
    with pytest.raises(ValueError, match="no column"):
        ChangeReader(schema, table, "v")


def test_a_replayed_batch_has_the_same_rows_and_is_written_once(spark, tmp_path):
    """The write of the second batch is killed after its data are there; a restart replays it."""
    table, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "cp"))
    rows = spark.range(30).selectExpr("id", "id as u")
    rows.filter("id < 10").write.parquet(table)
    run(spark, table, rows.schema, "u", out, checkpoint)
    rows.filter("id >= 10").write.mode("append").parquet(table)

    def killed(batch, to):
        batch.write.parquet(to)
        raise IOError("killed")

    query = (stream_changes(spark, table, rows.schema, "u").writeStream
             .foreachBatch(logged_batch_writer(out, killed))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert len(committed(spark, out)) == 1
    # rows past the planned end of the batch come with the next one
    spark.range(30, 33).selectExpr("id", "id as u").write.mode("append").parquet(table)
    for _ in range(2):
        run(spark, table, rows.schema, "u", out, checkpoint)
    got = read_batches(spark, out, rows.schema, "parquet")
    assert sorted(r["id"] for r in got.collect()) == list(range(33))
    assert [e["batch_id"] for e in committed(spark, out)] == [0, 1, 2]


def test_a_committed_batch_that_is_replayed_writes_nothing(spark, tmp_path):
    out, written = str(tmp_path / "out"), []

    def write(batch, to):
        written.append(to)
        batch.write.parquet(to)

    send = logged_batch_writer(out, write)
    for _ in range(3):
        send(spark.range(5), 7)
    assert len(written) == 1 and batch_log(spark, out).read()[0] == 1
    assert read_batches(spark, out, "id long", "parquet").filter("batch_id = 7").count() == 5


# Supervision


def inbox(spark, small, path):
    catalog.chi_messages(spark, small).repartition(4).write.parquet(path)
    catalog.sea_messages(spark, small).write.mode("append").parquet(path)


def test_one_feed_fails_twice_and_the_other_never_stops(spark, small, tmp_path):
    box = str(tmp_path / "in")
    inbox(spark, small, box)
    fails, seen = {"left": 2}, []
    n = catalog.chi_messages(spark, small).count()

    def source(topic):
        return MessageSource("parquet", (topic,), {"path": box, "maxFilesPerTrigger": "2"})

    def chicago():
        def write(batch, to):
            batch.write.parquet(to)
            if fails["left"]:
                fails["left"] -= 1
                raise IOError("the store is away")

        return (CHICAGO.rows(stream_messages(spark, source("chicago"))).writeStream
                .queryName("chicago").foreachBatch(logged_batch_writer(str(tmp_path / "c"), write))
                .option("checkpointLocation", str(tmp_path / "cc")).trigger(availableNow=True).start())

    def seattle():
        query = start_feed(spark, SEATTLE, source("seattle"), str(tmp_path / "s"),
                           str(tmp_path / "sc"), poll="1 second")
        seen.append(query.runId)
        return query

    supervisor = Supervisor(spark, {"chicago": chicago, "seattle": seattle}, 5, wait_seconds=0.2)

    def finish():
        deadline = time.time() + 90
        while time.time() < deadline and (
                sum(e["rows"] for e in committed(spark, str(tmp_path / "c"))) < n
                or "chicago" in supervisor.active):
            time.sleep(0.2)
        assert supervisor.active["seattle"].isActive
        supervisor.stop()

    watcher = threading.Thread(target=finish)
    watcher.start()
    assert supervisor.run(poll_seconds=0.2) == {"chicago": 2, "seattle": 0}
    watcher.join()
    assert len(seen) == 1
    schema = CHICAGO.rows(catalog.chi_messages(spark, small)).schema
    assert read_batches(spark, str(tmp_path / "c"), schema, "parquet").count() == n
    assert spark.read.csv(str(tmp_path / "s")).count() == n


def test_a_feed_that_keeps_failing_is_given_up_and_told(spark, small, tmp_path):
    box = str(tmp_path / "in")
    inbox(spark, small, box)
    starts = []

    def broken():
        starts.append(1)
        rows = stream_messages(spark, MessageSource("parquet", ("chicago",), {"path": box}))
        return (rows.select(F.raise_error(F.lit("broken")).alias("x")).writeStream
                .foreachBatch(lambda b, _: b.collect())
                .option("checkpointLocation", str(tmp_path / "b")).trigger(availableNow=True).start())

    def fine():
        return start_feed(spark, SEATTLE, MessageSource("parquet", ("seattle",), {"path": box}),
                          str(tmp_path / "s"), str(tmp_path / "sc"), poll=None)

    supervisor = Supervisor(spark, {"broken": broken, "fine": fine}, max_restarts=2, wait_seconds=0)
    with pytest.raises(Exception, match="broken"):
        supervisor.run(poll_seconds=0.1)
    assert len(starts) == 3 and supervisor.restarts == {"broken": 2, "fine": 0}
    assert spark.read.csv(str(tmp_path / "s")).count() == catalog.sea_messages(spark, small).count()
