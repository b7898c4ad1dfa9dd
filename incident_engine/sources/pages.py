"""Pages of an ordered table from an index, whatever the offset.

The rows are written once in ranges of their order, and the number of rows ahead of
each range is kept beside them. A page then reads the ranges that hold it and sorts
no more than those, instead of sorting all rows up to its end in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from incident_engine.schemas import PAGE_SIZE

#: Rows of a range, and the most ranges; a larger table has larger ranges.
PART_ROWS, MOST_PARTS = 100_000, 50_000
_PART, _TIE = "__part", "__tie"


@dataclass(frozen=True)
class PageIndex:
    """Rows by range under ``path``/rows, the ranges with their start under ``path``/parts."""

    spark: SparkSession
    path: str
    update_field: str
    key: str
    schema: StructType

    @property
    def parts(self) -> DataFrame:
        return self.spark.read.schema("part int, start long, n long").parquet(f"{self.path}/parts")

    @property
    def rows(self) -> int:
        return self.parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, offset: int = 0, limit: int = PAGE_SIZE) -> DataFrame:
        """Latest change first, rows without one last; the key orders equal changes."""
        table = self.spark.read.schema(StructType([*self.schema, StructField(_PART, IntegerType())])) \
            .parquet(f"{self.path}/rows")
        low, high, start = self.parts.filter(
            (F.col("start") < offset + limit) & (F.col("start") + F.col("n") > offset)).agg(
            F.min("part"), F.max("part"), F.min("start")).first()
        if low is None:
            return table.drop(_PART).limit(0)
        held = table.filter(F.col(_PART).between(low, high)).drop(_PART)
        return held.orderBy(F.desc(self.update_field), self.key).offset(offset - start).limit(limit)


def build_page_index(table: DataFrame, update_field: str, key: str, path: str,
                     part_rows: int = PART_ROWS) -> PageIndex:
    """Order ``table`` once; it is counted, sampled for the ranges, and written."""
    spark = table.sparkSession
    n = table.count()
    parts = max(1, min(MOST_PARTS, -(-n // part_rows)))
    # rows equal in both are told apart, so that a long run of them is cut as well
    ordered = table.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(
        parts, F.desc(update_field), F.col(key), F.col(_TIE)).drop(_TIE)
    ordered.withColumn(_PART, F.spark_partition_id()).write.mode("overwrite") \
        .partitionBy(_PART).parquet(f"{path}/rows")
    counts = spark.read.schema(f"{_PART} int").parquet(f"{path}/rows").groupBy(
        F.col(_PART).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # MOST_PARTS rows
    counts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"), "n") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")
    return PageIndex(spark, path, update_field, key, table.schema)
