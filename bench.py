"""Time the headline queries: one JSON line with the median of warm runs per query."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "p3_cutoff_at_share", "p10_drop_duplicate_columns", "a1_distinct_rows", "a2_corr_with_target", "a5_a6_column_profile",
    "j1_outer_join_on_time", "j3_join_shared_calendar", "j8_asof_hourly_grid", "f18_resample_forward_fill",
    "w1_w2_fill_both_ways", "w5_back_from_percent_change", "w6_dense_time_rank", "w7_position", "w11_encoder_decoder_samples",
    "f13_train_only_scaling", "f16_factorize", "f17_preprocess", "f20_option_chain", "s3_payload_keyed_dates",
    "e_metrics_naive_drift", "e_metrics_all_models_windows", "m4_one_lag_regression", "m7_simple_smoothing", "m7_smoothing_grid",
    "m8_croston", "m9_theta", "m10_arima_auto", "m12_strongest_frequencies", "m14_nlinear", "m16_local_level",
    "m17_exact_quantiles", "m19_smoothing_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from panelloom.plans import QUERIES

    times = {}
    for name in HEADLINE:
        taken = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # the first run warms up
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
