"""Pages from an order index equal a slice of the ordered table, and read their own ranges alone."""

import pytest
from pyspark.sql import functions as F

from incident_engine.sources.pages import build_page_index
from incident_engine.sources.pull import page


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(0, 5000, 1, 6).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 11 > 0, F.xxhash64("id") % 40).alias("u"), F.lit("x").alias("v"))


@pytest.fixture(scope="module")
def index(spark, table, tmp_path_factory):
    return build_page_index(table, "u", "k", str(tmp_path_factory.mktemp("pages")), part_rows=300)


@pytest.mark.parametrize("offset, limit", [
    (0, 10), (0, 0), (299, 2), (1234, 1000), (4990, 100), (5000, 10), (9999, 1), (0, 5000)])
def test_pages_equal_the_sorted_table(table, index, offset, limit):
    want = [tuple(r) for r in page(table, "u", "k", offset, limit).collect()]
    assert [tuple(r) for r in index.page(offset, limit).collect()] == want
    assert len(want) == max(0, min(limit, 5000 - offset))


def test_a_deep_page_reads_its_ranges_alone(index):
    assert index.rows == 5000
    parts = index.parts.orderBy("part").collect()
    assert len(parts) > 10 and max(r["n"] for r in parts) < 900
    assert [r["start"] for r in parts] == [sum(p["n"] for p in parts[:i]) for i in range(len(parts))]
    plan = index.page(4000, 100)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__part" in plan and "TakeOrderedAndProject" in plan
    files = index.page(4000, 100).select(F.input_file_name()).distinct().count()
    assert files <= 2


def test_a_run_of_equal_rows_is_cut(spark, tmp_path):
    same = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("k"), F.lit(2).alias("u"))
    index = build_page_index(same, "u", "k", str(tmp_path / "p"), part_rows=500)
    assert max(r["n"] for r in index.parts.collect()) < 1500
    assert index.page(3500, 1000).count() == 500


def test_an_empty_table_has_empty_pages(spark, table, tmp_path):
    index = build_page_index(table.limit(0), "u", "k", str(tmp_path / "p"))
    assert index.rows == 0 and index.page().count() == 0 and index.page().columns == table.columns
