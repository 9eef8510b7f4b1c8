"""Headline-query benchmark.

Runs a fixed set of registered queries at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is executed to completion with the ``noop`` sink, so the timing
covers the whole plan without funnelling rows through the driver; one run each
counts, after a warm-up run of the first.
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.catalog import QUERIES  # noqa: E402
from tessera.session import build  # noqa: E402

RUNS = 1

HEADLINE = [
    "log_top_error_paths",     # parse CLF text, filter, aggregate, top-k
    "log_daily_requests_per_host",
    "wc_top",                  # word count over every line of every document
    "join_broadcast",          # fact x dimension join + aggregate
    "agg_group_count",
    "er_cosine_inverted",      # TF-IDF + inverted-index cosine over all record pairs
    "er_pr_curve",             # gold pairs (k-gram containment) + threshold sweep
    "rat_item_stats",
    "als_train_select_rank",   # ALS, ranks 4/8/12, validation RMSE
    "reg_rmse",
    "lin_gradient_descent",
    "ctr_ohe_encode",          # distributed dense dictionary + encode
    "ctr_hash_features",
    "ctr_roc",                 # running sums without a single-partition window
    "pca_covariance",          # per-batch partial Gram matrices
    "ts_fold_by_phase",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build(shuffle_partitions=2 * int(os.environ.get("BENCH_CPUS", "8")),
                  extra={"spark.driver.memory": os.environ.get("TESSERA_DRIVER_MEMORY", "8g")})

    def run(key):
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(HEADLINE[0])  # start-up and first code generation are not a query's time
    times = {key: round(statistics.median(run(key) for _ in range(RUNS)), 3) for key in HEADLINE}
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
