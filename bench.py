"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from affinis.plans import REGISTRY  # noqa: E402

HEADLINE = [
    "clean_measurements",
    "wide_measurements",
    "value_shares",
    "feature_table",
    "document_vectors",
    "vocabulary",
    "frozen_transform",
    "cosine_to_references",
    "nearest_cosine",
    "similar_profiles",
    "dense_nearest_cosine",
    "recommend_by_entity",
    "recommend_by_text",
    "explain_best_match",
    "search_names",
    "gradient_step",
    "training_history",
    "class_probabilities",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["value_counts"].run(spark, sf_dir).collect()  # start the JVM's workers outside the timing
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
