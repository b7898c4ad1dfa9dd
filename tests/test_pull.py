"""Incremental pull: marks, pages, and no loss over cycles."""

import pytest

from incident_engine.sources import pull


@pytest.fixture()
def table(spark):
    rows = [("a", "2025-01-01T00:00:00.000"), ("b", "2025-01-02T00:00:00.000"),
            ("c", "2025-01-02T00:00:00.000"), ("d", "2025-01-03T00:00:00.000"), ("e", None)]
    return spark.createDataFrame(rows, "id string, updated_on string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_rows_since(table):
    assert ids(pull.rows_since(table, "updated_on", None)) == list("abcde")
    mark = "2025-01-02T00:00:00.000"
    assert ids(pull.rows_since(table, "updated_on", mark)) == ["d"]
    assert ids(pull.rows_since(table, "updated_on", mark, inclusive=True)) == ["b", "c", "d"]
    twice = table.union(table)
    assert ids(pull.rows_since(twice, "updated_on", mark, inclusive=True, key="id")) == ["b", "c", "d"]


def test_pages_cover_the_table_once(table):
    pages = [[r["id"] for r in pull.page(table, "updated_on", "id", offset, 2).collect()]
             for offset in (0, 2, 4, 6)]
    assert pages == [["d", "b"], ["c", "a"], ["e"], []]


@pytest.mark.parametrize("mark, expected", [
    (None, "2025-01-03T00:00:00.000"), ("2024-01-01", "2025-01-03T00:00:00.000"),
    ("2026-01-01T00:00:00.000", "2026-01-01T00:00:00.000")])
def test_next_mark(table, mark, expected):
    assert pull.next_mark(table, "updated_on", mark).first()[0] == expected
    nulls = table.filter("updated_on is null")
    assert pull.next_mark(nulls, "updated_on", mark).first()[0] == mark


def test_marks_only_move_forward(spark, tmp_path):
    state = str(tmp_path / "marks")
    assert pull.load_mark(spark, state, "chi") is None
    assert not pull.save_mark(spark, state, "chi", None)
    assert pull.save_mark(spark, state, "chi", "2025-01-02")
    assert not pull.save_mark(spark, state, "chi", "2025-01-02")
    assert not pull.save_mark(spark, state, "chi", "2025-01-01")
    assert pull.save_mark(spark, state, "sea", "2024-01-01")
    assert pull.load_mark(spark, state, "chi") == "2025-01-02"
    assert pull.load_mark(spark, state, "sea") == "2024-01-01"


def test_cycles_lose_nothing(spark, table, tmp_path):
    state, out = str(tmp_path / "marks"), str(tmp_path / "out")
    sink = lambda rows: rows.write.mode("append").parquet(out)
    first = table.filter("id in ('a', 'b', 'c')")
    assert pull.pull_once(first, "updated_on", state, "chi", sink) == 3
    assert pull.pull_once(first, "updated_on", state, "chi", sink) == 0
    assert pull.pull_once(table, "updated_on", state, "chi", sink) == 1
    assert ids(spark.read.parquet(out)) == list("abcd")
    assert pull.load_mark(spark, state, "chi") == "2025-01-03T00:00:00.000"


def test_failed_sink_leaves_the_mark(spark, table, tmp_path):
    state = str(tmp_path / "marks")

    def broken(rows):
        rows.count()
        raise IOError("sink is down")

    with pytest.raises(IOError):
        pull.pull_once(table, "updated_on", state, "chi", broken)
    assert pull.load_mark(spark, state, "chi") is None
    got = []
    assert pull.pull_once(table, "updated_on", state, "chi", lambda rows: got.extend(rows.collect())) == 5
    assert len(got) == 5


def test_time_columns_work_like_text(spark, table, tmp_path):
    state = str(tmp_path / "marks")
    times = table.selectExpr("id", "cast(updated_on as timestamp) as u")
    assert pull.pull_once(times, "u", state, "t", lambda rows: rows.collect()) == 5
    later = times.union(spark.sql("select 'z', timestamp '2025-01-03 00:00:00.5'"))
    assert pull.pull_once(later, "u", state, "t", lambda rows: rows.collect()) == 1


def test_filter_reaches_the_scan(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    df = pull.rows_since(spark.read.parquet(str(tmp_path / "t")), "updated_on", "2025-01-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_on,2025-01-02)" in plan


def test_late_rows_at_the_mark_are_pulled_when_inclusive(spark, tmp_path):
    state, sent = str(tmp_path / "marks"), []
    early = spark.createDataFrame([("a", "2024-01-01")], "id string, updated string")
    late = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01")], early.schema)

    def sink(rows):
        sent.append(sorted(r["id"] for r in rows.collect()))

    assert pull.pull_once(early, "updated", state, "f", sink, inclusive=True, key="id") == 1
    assert pull.pull_once(late, "updated", state, "f", sink) == 0
    assert pull.pull_once(late, "updated", state, "f", sink, inclusive=True, key="id") == 2
    assert sent == [["a"], [], ["a", "b"]]


def test_marks_hold_across_session_zones(spark, tmp_path):
    state, zone = str(tmp_path / "marks"), spark.conf.get("spark.sql.session.timeZone")
    times = spark.range(2).selectExpr("id", "timestamp_micros(1736000000000000 + id * 3600000000) as t")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert pull.pull_once(times.filter("id = 0"), "t", state, "x", lambda rows: rows.collect()) == 1
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        assert pull.pull_once(times, "t", state, "x", lambda rows: rows.collect()) == 1
        assert pull.pull_once(times, "t", state, "x", lambda rows: rows.collect()) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_marks_of_numbers_are_compared_as_numbers(spark, tmp_path):
    state = str(tmp_path / "marks")
    for n, sent in ((9, 1), (10, 1), (10, 0)):
        rows = spark.createDataFrame([(n,)], "n long")
        assert pull.pull_once(rows, "n", state, "x", lambda r: r.collect()) == sent
