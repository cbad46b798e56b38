"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Every query runs
twice from the order tables on: ``first`` in a session that has not seen it, ``queries`` warm.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from monthloom.sources.scratch import discard

HEADLINE = (
    "merge_training",
    "merge_scoring",
    "merge_profile_months",
    "field_avg",
    "minmax_stats",
    "max_change_stats",
    "column_presence",
    "row_presence",
    "category_rate",
    "category_values",
    "tree_block_avg",
    "tree_rate",
    "onehot_ratio_pair",
    "missing_count",
    "profile_onehot",
    "layout_full_year",
    "layout_three_seasons",
    "layout_half_year",
    "layout_one_season",
    "layout_year_and_half",
    "layout_linear",
    "sparse_row_text",
    "blend_scores",
    "auc",
    "grid_association",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("monthloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="monthloom-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 1)))
    spark = session(cpus)
    first = {name: seconds(spark, name, folder) for name in HEADLINE}
    warm = {name: seconds(spark, name, folder) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)$", folder)
    result = {
        "metric": "total_warm_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "first": first,
        "sf": float(scale.group(1)) if scale else folder,
        "cpus": int(cpus) if cpus.isdigit() else cpus,
    }
    discard(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
