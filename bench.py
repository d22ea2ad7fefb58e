"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "plan_status", "sentences", "clip_spans", "new_words", "word_coverage", "token_counts", "word_digest", "classify_native", "classify_full", "sound_codes", "sound_groups", "pack_totals", "passage_lengths",
    "timeline", "islands", "median_by_length", "settle_ladder", "last_outcome", "reconciled", "outstanding", "cumulative_remaining", "first_resolving_giver", "slow_streak", "sessions", "stream_rate",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lectern.plans import QUERIES

    spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr("sum(o_totalprice)").collect()
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
