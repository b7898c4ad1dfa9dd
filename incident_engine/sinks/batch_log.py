"""Micro-batches written once, proven by a log.

A batch is written to a folder of its own attempt and counts from the moment its
entry stands in the commit log under the batch id. A batch that was killed before
leaves a folder that nobody reads; the replay writes a new one. A batch that is
replayed although it was committed finds its entry and writes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from incident_engine.sinks.files import write_csv
from incident_engine.sources.commit_log import CommitLog

Write = Callable[[DataFrame, str], None]


def batch_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/_log")


def committed(spark: SparkSession, path: str) -> list[dict]:
    """``batch_id, folder, rows`` of every batch that counts, in order of commit."""
    return batch_log(spark, path).read()[1]


def logged_batch_writer(path: str, write: Write) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function around ``write(batch, folder)``. One writer per path at a time is
    the rule of a checkpoint; should two run, the batch ids keep them apart as well."""
    def run(batch: DataFrame, batch_id: int) -> None:
        log = batch_log(batch.sparkSession, path)
        while True:
            last, entries = log.read()
            if any(e["batch_id"] == batch_id for e in entries):
                return
            folder = f"batch-{batch_id}-{uuid.uuid4().hex[:12]}"
            seen = Observation(f"batch-{batch_id}")
            write(batch.observe(seen, F.count(F.lit(1)).alias("rows")), f"{path}/{folder}")
            if log.commit(last, {"batch_id": batch_id, "folder": folder, "rows": seen.get["rows"]}):
                return

    return run


def logged_csv_writer(path: str, files: int | None = None) -> Callable[[DataFrame, int], None]:
    """Headerless CSV, one folder per committed batch."""
    return logged_batch_writer(path, lambda rows, to: write_csv(rows, to, files, header=False))


def read_batches(spark: SparkSession, path: str, schema: StructType | str,
                 file_format: str = "csv") -> DataFrame:
    """Rows of all committed batches with their ``batch_id``."""
    done = committed(spark, path)
    if not done:
        schema = schema if isinstance(schema, str) else schema.toDDL()
        return spark.createDataFrame([], f"{schema}, batch_id long")
    rows = spark.read.schema(schema).format(file_format).load([f"{path}/{e['folder']}" for e in done])
    folder = F.regexp_extract(F.input_file_name(), r"batch-([0-9]+)-[0-9a-f]{12}/[^/]*$", 1)
    return rows.withColumn("batch_id", folder.cast("long"))
