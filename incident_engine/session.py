"""Session helper and the shared workspace for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_SCOPE: ContextVar[list[str] | None] = ContextVar("tables_of_scope", default=None)


def build_session(app: str = "incident-engine", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    # one machine runs all of this session, so a folder of its own will do
    spark = builder.config(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="incident-engine-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Feed timestamps carry no zone; pin the session so text and values agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def workspace_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it.

    Without a checkpoint folder it is the warehouse, which executors share as well.
    """
    context = spark.sparkContext
    shared = (spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
              or spark.conf.get("spark.sql.warehouse.dir"))
    return os.path.join(shared, "incident_engine", context.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Used where a small aggregate of a large scan feeds several consumers: the
    scan then runs once, the lineage is cut, and a lost executor costs nothing.
    """
    path = os.path.join(workspace_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return load_or_build(df.sparkSession, path, lambda: df)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, built and written first when no finished one is there."""
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df = build()
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return spark.read.parquet(path)


@contextmanager
def tables_noted() -> Iterator[list[str]]:
    """Paths of the tables that ``materialize`` writes inside the block, for ``drop_tables`` once
    nothing reads them any more. A block around this one notes them as well."""
    noted: list[str] = []
    outer = _SCOPE.get()
    token = _SCOPE.set(noted)
    try:
        yield noted
    finally:
        _SCOPE.reset(token)
        if outer is not None:
            outer.extend(noted)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``materialize``."""
    for path in paths:
        table = spark._jvm.org.apache.hadoop.fs.Path(path)
        table.getFileSystem(spark._jsc.hadoopConfiguration()).delete(table, True)
