"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query's full result is computed and discarded with the ``noop`` sink (nothing is
collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "process_tweet", "stem_vocab", "html_unescape", "tfidf", "nb_predict", "stream_classify",
    "kmeans_update", "kmeans_stream", "eval_precision", "eval_onepass", "parse_csv",
    "stream_decode", "positional_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from sentimill.plans.catalog import QUERIES
    from sentimill.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.ui.showConsoleProgress": "false"})
    # warm-up: JVM start and the first code generation are not query time
    QUERIES["eval_precision"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
           "cpus": cpus}
    if "process_tweet" in times:
        out["process_tweet_docs_per_sec"] = round(docs / times["process_tweet"], 1)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
