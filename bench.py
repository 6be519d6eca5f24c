"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1: best of N runs per query).

Each query is timed from building its DataFrame (which includes the Gram
pass for the ridge queries) to a full ``noop`` write, so every row of the
plan is computed and nothing is collected to the driver. Before timing, the
same queries run once on the smallest tables (BENCH_WARMUP_DIR, default the
sibling ``sf0.001`` folder) to warm the JVM and code generation; set it to
an empty string to time cold.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "baseline_top_n",
    "season_totals",
    "feature_table",
    "next_season_dataset",
    "average_rank",
    "ridge_fit_6feat",
    "ridge_vs_naive",
    "ridge_by_position_metrics",
    "slice_top_n_per_position",
    "spearman_by_position",
    "forecast_next_season",
    "forecast_pipeline",
)


def forecast_pipeline(spark, sf_dir):
    """The whole train / evaluate / forecast run: one materialized feature
    table feeds both fits, every metric table and the forecast."""
    from seasonlab.plans import pipelines as pl
    from seasonlab.plans.queries import FORECAST_SEASON, TRAIN_END
    from seasonlab.sources.base import TestbedSource

    feats = pl.load_and_build_features(TestbedSource(spark, sf_dir), seasons=None)
    res = pl.run_forecast(feats, train_end_season=TRAIN_END, forecast_season=FORECAST_SEASON)
    return [res.ridge_vs_naive, res.winner, res.position_metrics, res.slice_top_per_position,
            res.slice_top_overall, res.spearman, res.forecast]


def run(name, spark, sf_dir, queries):
    frames = forecast_pipeline(spark, sf_dir) if name == "forecast_pipeline" else [queries[name](spark, sf_dir)]
    for df in frames:
        df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    from seasonlab.plans.queries import QUERIES
    from seasonlab.session import build_session, use_local_scratch

    spark = build_session(f"local[{cpus}]", app_name="seasonlab-bench", shuffle_partitions=max(cpus, 1),
                          extra={"spark.driver.memory": "8g"})
    use_local_scratch(spark)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    if warm_dir and os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:  # JVM / codegen warm-up on other, tiny tables (not timed)
            run(name, spark, warm_dir, QUERIES)
    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(name, spark, sf_dir, QUERIES)
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
