"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Each query is
planned and run in full, twice; its rows go to the no-op sink, so nothing is
collected. ``queries`` holds the second run, with the JVM warm, and ``first_run``
the first, which for the first query that needs them includes building the
shared grid and polygon cover. ``grid_cells`` builds its grid in both runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from incident_engine.catalog.queries import QUERIES  # noqa: E402
from incident_engine.session import build_session  # noqa: E402

HEADLINE = [
    "src_multi_topic", "csv_to_messages", "pull_since_mark", "sink_keyed_json",
    "chi_sink_layout", "sea_format", "uk_normalize", "la_normalize", "unified_incidents",
    "archive_merge", "audit_counts", "grid_cells", "spatial_point_cell", "spatial_point_polygon",
    "collect_in_polygon", "hotspot_dense", "hotspot_rank", "hotspot_cells",
    "area_month_features", "forecast_mse", "forecast_horizon", "forecast_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    first, seconds = {}, {}
    for runs in (first, seconds):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total time, warm", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else None,
        "first_run": first,
    }))


if __name__ == "__main__":
    main()
