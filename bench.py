"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from linemart.plans import registry

HEADLINES = ["monthly_line_summary", "interior_locf", "resolve_licences", "market_share", "hhi", "band_share", "reconcile_hashes", "scd2_apply", "asof_dimension_join", "stopped_reporting", "anomalous_variation", "point_in_parish"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # wide plans fill the default of 100, and warm runs compile again
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINES:
        runs = []
        for _ in range(2):  # the first run compiles
            began = time.perf_counter()
            registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(min(runs), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
