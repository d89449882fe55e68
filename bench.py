"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "price_stats_nation_year", "price_evolution_nation", "keep_largest_lot",
    "exact_medians_by_segment", "percent_rank_of_balance", "age_group_shares",
    "zone_weighted_means", "star_enrichment", "incremental_orders", "points_in_areas",
    "bike_density", "transit_density", "cycle_density", "dissolve_boundary",
    "model_crime_total", "zone_rollup", "price_evolution",
    "serving_region_price_by_department", "serving_ring_price_series_with_city",
    "quality_relationship",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("territory")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from contract import derive, queries as Q
    from territory.plans.build import build_models

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark, seconds = session(), {}

    def timed(run) -> float:
        started = time.time()
        run()
        return time.time() - started

    def build_all() -> None:
        models = build_models(derive.raw_tables(spark, sf_dir), derive.LIMITS)
        models["zones"].collect()
        models["evolution"].write.format("noop").mode("overwrite").save()

    registered = Q.all_queries()
    Q.models(spark, sf_dir)
    seconds["build_models"] = round(statistics.median(timed(build_all) for _ in range(runs)), 3)
    for name in HEADLINE:
        def run(name=name):
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline queries, median of warm runs", "value": total, "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
