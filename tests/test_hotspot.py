"""Hot spots against a plain computation in Python, and the special cases."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_engine.functions.geo import GridSpec
from incident_engine.operators import counts as op
from incident_engine.plans.hotspot import HotSpotModel, hot_cells

GRID = GridSpec(0.0, 0.0, 1.0, 1.0, 0.25)


def cells(spark):
    return spark.sql("""
        select ix, iy, ix * 4 + iy as grid_id from (select explode(sequence(0L, 3L)) as ix),
          (select explode(sequence(0L, 3L)) as iy) where not (ix = 3 and iy = 3)""")


def incident(cell, year, month, day=5):
    ix, iy = divmod(cell, 4)
    return dt.datetime(year, month, day), ix * 0.25 + 0.1, iy * 0.25 + 0.1


def model(spark, rows, **options):
    points = spark.createDataFrame(rows, "occurred_at timestamp, lon double, lat double")
    return HotSpotModel.fit(points, cells(spark), GRID, **options)


def months_from(year, month, count):
    return [(year + (month - 1 + i) // 12, (month - 1 + i) % 12 + 1) for i in range(count)]


def scores_by_hand(rows, kept=range(15)):
    """Cell -> (hit rate or none, count in the latest month), over present months."""
    by = Counter()
    for when, x, y in rows:
        cell = int(x / 0.25) * 4 + int(y / 0.25)
        if cell in kept:
            by[cell, (when.year, when.month)] += 1
    axis = sorted({m for _, m in by})
    last = max(r[0] for r in rows)
    out = {}
    for cell in {c for c, _ in by}:
        series = [by[cell, m] for m in axis]
        flags = [1 if 1 - math.exp(-sum(series[i - 12:i]) / 12) > 0.5 and series[i] > 0 else 0
                 for i in range(12, len(series))]
        rate = sum(flags) / len(flags) if flags else None
        out[cell] = (rate, by[cell, (last.year, last.month)])
    return out


def random_rows(seed, n=600, months=20):
    rng = random.Random(seed)
    spread = [(c, 1 / (c + 1)) for c in range(16)]
    picked = rng.choices([c for c, _ in spread], [w for _, w in spread], k=n)
    calendar = months_from(2020, 3, months)
    return [incident(c, *rng.choice(calendar), day=rng.randint(1, 28)) for c in picked]


@pytest.mark.parametrize("seed", range(3))
def test_rank_equals_plain_computation(spark, seed):
    rows = random_rows(seed)
    expected = scores_by_hand(rows)
    m = model(spark, rows)
    got = {r["grid_id"]: (r["avg_tp"], r["prev_n"]) for r in m.cell_scores().collect()}
    assert got.keys() == expected.keys()
    for cell, (rate, n) in expected.items():
        assert got[cell] == (pytest.approx(rate), n)
    order = sorted(expected, key=lambda c: (-expected[c][0], -expected[c][1], c))
    for count in (3, 120):
        ranked = m.rank(count).orderBy("rk").collect()
        assert [r["grid_id"] for r in ranked] == order[:count]
        assert [r["rk"] for r in ranked] == list(range(1, len(ranked) + 1))
        assert {r["grid_id"] for r in hot_cells(cells(spark), m.rank(count)).collect()} == set(order[:count])


def test_dense_counts_add_up_to_the_rows_on_the_grid(spark):
    rows = random_rows(9)
    m = model(spark, rows)
    total = m.dense().agg(F.sum("n")).first()[0]
    assert total == sum(1 for _, x, y in rows if not (x > 0.75 and y > 0.75))
    per_cell = m.dense().groupBy("grid_id").count().select("count").distinct().collect()
    assert len(per_cell) == 1


def test_fewer_than_thirteen_months_have_no_rate(spark):
    rows = [incident(c, y, m) for c in (1, 2) for y, m in months_from(2020, 1, 12)]
    rows.append(incident(2, 2020, 12))
    ranked = model(spark, rows).rank().collect()
    assert [r["avg_tp"] for r in ranked] == [None, None]
    assert [r["grid_id"] for r in ranked] == [2, 1]


def test_month_without_any_event(spark):
    """Present months only by default; ``calendar`` fills the gap with zeros."""
    present = [m for m in months_from(2020, 1, 15) if m != (2020, 6)]
    rows = [incident(1, y, m) for y, m in present]
    plain, filled = model(spark, rows), model(spark, rows, calendar=True)
    assert plain.dense().count() == 14 and filled.dense().count() == 15
    means = lambda m: [r["mu"] for r in m.scored().orderBy("month").collect() if r["mu"] is not None]
    assert means(plain) == [1.0, 1.0]
    assert means(filled) == [pytest.approx(11 / 12)] * 3


def test_all_cells_adds_cells_without_events(spark):
    rows = [incident(1, y, m) for y, m in months_from(2020, 1, 14)]
    m = model(spark, rows, all_cells=True)
    got = {r["grid_id"]: (r["avg_tp"], r["prev_n"]) for r in m.cell_scores().collect()}
    assert len(got) == 15 and got[1] == (1.0, 1) and got[0] == (0.0, 0)


def test_tie_goes_to_the_lower_id(spark):
    rows = [incident(c, y, m) for c in (7, 3, 11) for y, m in months_from(2020, 1, 14)]
    assert [r["grid_id"] for r in model(spark, rows).rank(2).orderBy("rk").collect()] == [3, 7]


def test_latest_date_counts_rows_in_no_cell(spark):
    """The newest row lies off the grid, so its month has no counts: an error."""
    rows = [incident(1, y, m) for y, m in months_from(2020, 1, 14)]
    rows.append((dt.datetime(2021, 9, 9), 0.0, 0.3))
    m = model(spark, rows)
    row = spark.range(1).select(m.forecast_month.alias("f"), m.previous_month.alias("p")).first()
    assert (str(row["f"]), str(row["p"])) == ("2021-10-01", "2021-09-01")
    with pytest.raises(PySparkException, match="previous month 2021-09-01"):
        m.rank().collect()


def test_threshold_is_a_parameter(spark):
    rows = [incident(1, y, m) for y, m in months_from(2020, 1, 14)]
    m = model(spark, rows)
    assert m.rank(threshold=0.5).first()["avg_tp"] == 1.0
    assert m.rank(threshold=0.7).first()["avg_tp"] == 0.0


def test_wide_counts(spark):
    frame = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "b", 1), (2, "z", 9)],
                                  "grid_id long, month string, n long")
    rows = op.wide_counts(frame, ["grid_id"], ["a", "b"]).orderBy("grid_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3), (2, 0, 1)]
