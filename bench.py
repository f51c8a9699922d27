"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8). Results go
to Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from reviewlens.session import configured
from reviewlens.testbed.catalog import queries

HEADLINE = [
    "user_features",
    "user_category_agg",
    "business_review",
    "user_locations",
    "locations_per_user",
    "user_pair_distances",
    "near_place_counts",
    "user_city_state_counts",
    "user_frequent_cities",
    "avg_rating_per_user",
    "stars_vs_checkins",
    "business_region",
    "region_by_category",
    "all_categories",
    "elite_score",
    "months_yelping",
    "geo_distance",
    "spherical_centroid",
    "dbscan_centers",
    "rank_businesses",
    "rank_topk",
    "rank_from_stored_centers",
    "rank_batch",
    "local_vs_overall_rating",
    "metric_weighted_f1",
    "assembled_features",
    "dt_predictions",
    "rf_predictions",
    "lr_predictions",
    "all_category_predictions",
    "gmm_centers",
    "affinity_exemplars",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        configured(SparkSession.builder.master(f"local[{cpus}]").appName("reviewlens-bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    catalog = queries()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
