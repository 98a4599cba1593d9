"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from lodestone import catalog

HEADLINE = ["q_keyword_topk", "q_knn", "q_hybrid_search", "q_rule_match", "q_categories", "q_fingerprint_groups", "q_consensus", "q_correlation", "q_doom_loop", "q_latest_wins", "q_degree_centrality", "q_import_refs", "q_corpus_stats", "q_prf"]


def main() -> None:
    d, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    queries, took = catalog.queries(), {}
    for name in HEADLINE:
        queries[name](spark, d).write.format("noop").mode("overwrite").save()  # compiles the plan's code
        start = time.time()
        queries[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": d.rstrip("/").rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
