"""Archive refresh, audit and previews."""

import datetime as dt

from pyspark.sql import functions as F

from incident_engine.plans import incidents
from incident_engine.sources.messages import as_messages


def test_archive_refresh(spark):
    archive = spark.createDataFrame([
        ("1", "05/01/2025 01:02:03 PM", "05/14/2025 01:00:00 AM", 7),
        ("2", "05/01/2025 01:02:03 AM", "05/14/2025 01:00:01 AM", 8)],
        "ID string, Date string, `Updated On` string, Ward int")
    kept = incidents.updated_until(incidents.archive_rows(archive), "2025-05-14T01:00:00.000")
    messages = as_messages(
        spark.sql("""select '{"id": "3", "date": "2025-05-15T00:00:00.000", "latitude": "1.5"}' as v"""),
        F.lit("3"), F.col("v"), F.lit("t"))
    merged = incidents.archive_merge(kept, incidents.streamed_rows(messages)).orderBy("ID").collect()
    assert [r["ID"] for r in merged] == ["1", "3"]
    assert merged[0]["Date"] == dt.datetime(2025, 5, 1, 13, 2, 3) and merged[0]["Ward"] == 7
    assert merged[1]["latitude"] == 1.5 and merged[1]["Updated On"] is None


def test_audit_counts_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    df = incidents.audit_counts(spark.read.parquet(path), all=F.lit(True), low=F.col("id") < 3,
                                none=F.lit(None).cast("boolean"))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["stage"]: r["n"] for r in df.collect()} == {"all": 10, "low": 3, "none": 0}


def test_latest_updates_is_a_top_k(spark):
    df = incidents.latest_updates(spark.range(100), "id", "id", 5)
    assert [r["id"] for r in df.collect()] == [99, 98, 97, 96, 95]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
