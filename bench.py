"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hazecast.plans import QUERIES  # noqa: E402
from hazecast.session import local_session  # noqa: E402

HEADLINE = [
    "station_feature_table",
    "station_feature_table_filled",
    "daily_feature_table",
    "tick_feature_table",
    "lag_rows",
    "lead_target",
    "forward_filled",
    "last_rows_per_station",
    "trailing_days",
    "forecast_frame",
    "keep_first_per_hour",
    "high_water_append",
    "chunk_feature_table_with_history",
    "describe_ticks",
    "index_histogram",
    "index_box",
    "reading_correlations",
    "trend_lines",
    "fold_metrics",
    "ridge_all_features",
    "ridge_cross_validation",
    "forecast_scoring",
    "linear_attribution",
    "typed_payload_rows",
    "csv_round_trip",
    "forest_forecast",
    "tree_fit_metrics",
    "kernel_cv_averages",
    "sampled_shapley",
    "streamed_append",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_row"].build(spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        begun = time.perf_counter()
        QUERIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
