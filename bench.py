"""Time the headline queries and the layout scenarios; print one JSON line.

Tables come from $BENCH_SF_DIR, cores from $BENCH_CPUS. Each query writes
every column to a no-op sink, so no column can be pruned away. The layout
scenarios read a stored warehouse, as a real run would.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from ledgerline.operators import joins as J, layout as L, segments as S
from ledgerline.plans import queries as Q
from ledgerline.session import fresh_dir, stream_session
from ledgerline.sources import warehouse as W
from ledgerline.streaming import runner, windows as T

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3

HEADLINE = [
    "seg_job", "seg_month", "seg_balance_bucket", "seg_education", "seg_contact",
    "seg_housing_loan", "seg_poutcome", "seg_duration_cohort", "seg_poutcome_rank",
    "clean_full", "prof_duplicates", "prof_null_summary", "prof_cardinality", "prof_describe",
    "prof_quantiles", "dist_hist_age", "dist_kde_age", "dist_density_duration_by_y",
    "dist_box_balance_by_y", "stat_correlation", "hyp_welch_duration", "hyp_chi2_education",
    "eval_bundle", "sample_exact", "split_stratified", "join_sector_sortmerge",
    "txn_window_batch",
]


def seconds(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def typical(run) -> float:
    """Median of a few runs after one warm-up."""
    run()
    return round(statistics.median(seconds(run) for _ in range(REPEATS)), 3)


def layout_scenarios(spark) -> dict[str, float]:
    """Group-by and join under different layouts of three copies of the table."""
    path = fresh_dir(spark, "bench")
    W.write_warehouse(Q.clients(spark, FOLDER), path)
    big = L.times(spark.read.parquet(path).select("row_id", "job", "balance"), 3)
    sectors = Q.sectors(spark)
    cores = spark.sparkContext.defaultParallelism

    def average(df):
        L.run_only(S.mean_by(df, "job", "balance"))

    def thrice(df):
        for _ in range(3):
            average(df)

    times = {
        "layout_default": typical(lambda: average(big)),
        "layout_repartition": typical(
            lambda: average(L.repartition_by(big, 2 * cores, "job", ["row_id"]))),
        "layout_coalesce": typical(lambda: average(big.coalesce(max(2, cores // 4)))),
        "layout_3x_uncached": typical(lambda: thrice(big)),
    }
    with L.cached(big) as held:
        held.count()
        times["layout_3x_cached"] = typical(lambda: thrice(held))
    times["join_shuffle"] = typical(
        lambda: L.run_only(J.shuffle_join(big, sectors, "job", ["row_id"])))
    times["join_broadcast"] = typical(
        lambda: L.run_only(J.broadcast_join(big, sectors, "job")))
    return times


def stream_rate(spark) -> float:
    """Rows per second of the windowed stream, start-up included."""
    _, out, state = Q.stream_paths(spark, "bench-stream")
    result = T.flatten(Q.windows_of(Q.event_stream(stream_session(spark), FOLDER)))
    spent = seconds(lambda: runner.run_available(runner.to_files(result, out, state)))
    return round(spark.read.parquet(f"{FOLDER}/events.parquet").count() / spent, 1)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: typical(lambda: L.run_only(Q.REGISTRY[name](spark, FOLDER))) for name in HEADLINE
    }
    times.update(layout_scenarios(spark))
    rate = stream_rate(spark)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "stream_rows_per_sec": rate,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
