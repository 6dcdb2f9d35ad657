"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the cores to use.
Each query's whole result is computed and thrown away; the time includes building
the query, so eager steps count.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from reviewlab.queries import RUNS

HEADLINE = [
    "sentiment_counts",
    "label_sentiment",
    "clean_text",
    "normalize_tokens",
    "describe_lengths",
    "length_outliers",
    "hist_word_len",
    "profile_report",
    "flag_duplicates",
    "top_repeated_texts",
    "activity_per_product",
    "rank_curve",
    "majority_label",
    "quota_sample",
    "stratified_subset",
    "row_split",
    "group_split",
    "folds",
    "vocabulary",
    "tfidf_long",
    "lexicon_compound",
    "compare_models",
    "summarize_long",
    "generate_errors",
    "adjustment_summary",
    "smote",
    "logreg_holdout",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewlab-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="reviewlab-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM's own start is not a query's time.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()

    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        RUNS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
