"""The corpus pipeline: toxicity, near-dedup, suffix-array dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Stages are
written to Parquet and read again. All but the last return the columns they were given.

A stage's result reads tables that the stage made on its way. When the next stage is called, what it
is given has been written, so the tables of the stage before are deleted then.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.llm import decontaminate, near_dups, packing, suffixes, toxicity
from incident_engine.llm.common import read, text_hash
from incident_engine.llm.queries import TOKENIZER
from incident_engine.session import drop_tables, tables_noted, workspace_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: A passage of this many bytes that occurs twice goes: what some fifty words take.
PASSAGE_BYTES = 240
#: application -> tables of the stage called last
_TABLES: dict[str, list[str]] = {}


def _stage(run: Stage) -> Stage:
    @functools.wraps(run)
    def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _TABLES.pop(spark.sparkContext.applicationId, []))
        with tables_noted() as noted:
            out = run(spark, docs, sf_dir)
        _TABLES[spark.sparkContext.applicationId] = noted
        return out

    return clean


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose id and text are not among those of ``rejected`` (doc_id, hash)."""
    keys = rejected.select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash")).distinct()
    return docs.withColumn("__text", text_hash()).join(
        keys, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
        & (F.col("__text") == F.col("__hash")), "left_anti").drop("__text")


@_stage
def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    held = (3, 1)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), held)
    return _without(docs, toxicity.score(docs, model, held, keyed=True).filter("predicted = 1"))


@_stage
def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near_dups.keep_first(docs)


@_stage
def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of long repeated passages go; every document stays, with its new length."""
    return suffixes.strip_repeats(docs, length=PASSAGE_BYTES).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_stage
def benchmarks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    found = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), keyed=True)
    return _without(docs, found.filter("contaminated"))


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [("toxicity", toxic_out), ("near_dedup", near_copies_out), ("suffix_dedup", repeats_out),
          ("decontamination", benchmarks_out), ("packing", packed)]
#: Models, hashes and local search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = os.path.join(workspace_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
