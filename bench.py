"""Times the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS say where and on how many cores."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

from clickloom.plans import registry

HEADLINE = ("silver_dedup", "gold_hourly_brand", "gold_daily_brand", "gold_daily_category", "gold_hourly_price_band", "top_brands", "brand_kpis", "anomalies_zscore", "features_rolling", "features_lag", "ensemble_summary", "rca_report", "iforest_scores", "stream_tumbling_funnel")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            began = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
