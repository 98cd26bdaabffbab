"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Each query is warmed up on the smallest tables and then timed once, writing its whole result to
a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom import catalog  # noqa: E402
from riskloom.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_features",
    "dedup_rows",
    "coerce_types",
    "ip_country_asof",
    "velocity_user",
    "velocity_device",
    "velocity_user_chunked",
    "velocity_batches",
    "ecommerce_prepared",
    "card_prepared",
    "profile_columns",
    "describe_numeric",
    "histogram50",
    "density_curve",
    "box_by_category",
    "iqr_outliers",
    "corr_matrix",
    "crosstab",
    "monthly_trend",
    "pair_bins",
    "metrics_binary",
    "roc_curve",
    "stratified_split",
    "one_hot_sparse",
    "smote_points",
    "near_in_class",
    "train_logistic",
    "train_tree",
    "batch_score",
    "shapley_linear",
    "shapley_sampled",
    "shapley_trees",
    "shapley_kernel",
]

#: Trainings of many trees, which take minutes each: added with BENCH_LONG=1.
LONG = ["train_light_boosted", "train_boosted", "train_forest", "training_run"]


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    warm = os.path.join(os.path.dirname(tables.rstrip("/")), "sf0.001")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "riskloom-bench")
    catalog.load_all()

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in [*HEADLINE, *(LONG if os.environ.get("BENCH_LONG") else [])]:
        if os.path.isdir(warm):
            run(name, warm)
        seconds[name] = round(run(name, tables), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(tables.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores) if cores.isdigit() else cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
