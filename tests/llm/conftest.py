import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i * 7919 % 1009}" for i in range(30_000))
TEXTS = [None, "", " ", "a", "one two three", "!!! ???", "x\x1cy", "Ünïcödé naïve 日本語", LONG,
         "same words here again and again " * 30, "same words here again and again " * 30,
         "line\nline\nline\n\n", "don't stop 12ab <|endoftext|> now", "a" * 5000]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, a row given twice, and columns whose names clash
    with those that operators use inside."""
    rows = [(None if i == 3 else i, t) for i, t in enumerate(TEXTS)] + [(0, None), (10, TEXTS[10])]
    return spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(7).cast("long").alias("n_chars"), F.lit(1).alias("hash"), F.lit(2).alias("id"),
        F.lit(3).alias("part"), F.lit("z").alias("words"), F.lit(0).alias("shard"),
        F.lit(0).alias("length"), F.lit(0).alias("n"))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, medium):
    return spark.read.parquet(f"{medium}/documents.parquet")
