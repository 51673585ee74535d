"""Times the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewheel.plans import catalogue  # noqa: E402
from tidewheel.session import session  # noqa: E402

HEADLINE = [
    "kn28_map_masks", "ag15_bin_tod_to_map", "ag23_median_mjd", "wn21_cumulative_maps", "kn21_right_side", "kn23_destriper_matvec", "ag12_auto_rms", "wn5_moving_median",
    "wn10_gap_fill", "jn12_asof_backward", "jn13_nearest_join", "jn14_linear_join", "kn1_atmosphere", "ag14_frequency_bins", "kn7_gain_solution", "jn1_flags_catalogue",
    "jn6_reconcile", "ag4_coverage_by_group", "ag37_residuals", "kn40_polynomial_fit", "mu1_insert_or_update", "mu14_observer_flags", "jn16_nearest_field", "sf14_equatorial_to_galactic",
    "jn11_interval_join", "wn5_long_median", "ag28_best_fold", "kn15_noise_fit", "kn16_detrend", "kn18_process_scan", "kn47_gain_filter_and_bin",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", "bench", **{"spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalogue.queries(), {}
    for name in HEADLINE:
        best = []
        for _ in range(2):  # the second run has compiled code
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - began)
        took[name] = round(min(best), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
