"""What the operators of this subpackage share: narrow inputs, hashing, distributed ranks."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from incident_engine.session import materialize

__all__ = ["components", "fold", "materialize", "narrow", "prefix_sums", "read", "text_hash",
           "words_of"]

#: Bytes that end a word; A-Z become a-z. Bytes of other characters stay as they are.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
#: Rows of prefix sums that one task adds up.
RUN_ROWS = 4096


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           names: tuple[str, str] = ("doc_id", "text")) -> DataFrame:
    """The two columns an operator needs under its own names; further columns, whatever they
    are called, are left behind."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias(names[0]),
                       F.col(f"`{text_col}`").cast("string").alias(names[1]))


def text_hash(text: str = "text"):
    """Tells texts apart; with the id it is the key of a row. A null text counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), 1, 32))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of letters, digits and characters beyond ASCII."""
    return text.encode().translate(_FOLD).split() if text else []


def fold(df: DataFrame, modulus: int, key: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus))


def fold_of(doc_id, modulus: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def prefix_sums(totals: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows of smaller ``order`` (a non-negative
    integer, one row each). Runs of ``RUN_ROWS`` numbers are summed in tasks of their own, the
    sums of the runs likewise, so that no task gets all rows.
    """
    runs = totals.withColumn("__run", F.floor(F.col(order) / RUN_ROWS))
    per_run = runs.groupBy("__run").agg(F.sum(value).alias("__sum"))
    blocks = per_run.withColumn("__block", F.floor(F.col("__run") / RUN_ROWS))
    per_block = blocks.groupBy("__block").agg(F.sum("__sum").alias("__block_sum"))
    ahead = lambda part, by, of: F.coalesce(
        F.sum(of).over(Window.partitionBy(part).orderBy(by).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))
    per_block = per_block.select(
        "__block", ahead(F.lit(0), "__block", "__block_sum").alias("__a"))
    per_run = blocks.join(per_block, "__block").select(
        "__run", (F.col("__a") + ahead("__block", "__run", "__sum")).alias("__b"))
    return runs.join(per_run, "__run").withColumn(
        out, F.col("__b") + ahead("__run", order, value)).drop("__run", "__b")


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b) as (id, root), root being the smallest id.

    Each round takes the smallest label among the neighbours and then follows that label's own
    label, so that a chain of n links needs about log n rounds. Labels are written after each
    round. Minima are combined before the shuffle, so that a hub costs one row per task.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(),
                       f"{name}-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("id"), F.min("b")).alias("root")), f"{name}-labels")
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("id").alias("b"), "root"), "b") \
            .groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        nearer = labels.join(seen, "id").select(
            "id", "root", F.least("root", "near").alias("next"))
        up = labels.select(F.col("id").alias("next"), F.col("root").alias("far"))
        after = materialize(nearer.join(up, "next").select(
            "id", F.least("next", "far").alias("root"),
            (F.least("next", "far") != F.col("root")).alias("moved")), f"{name}-labels")
        labels = after.select("id", "root")
        if after.filter("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
