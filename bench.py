"""Headline timings: prints one JSON line.

Runs the flagship text pipeline and the main operators at $BENCH_SF_DIR
(default /root/testdata/sf0.1) on local[$BENCH_CPUS].
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aspectra.plans.queries import QUERIES  # noqa: E402
from aspectra.session import build_session  # noqa: E402

HEADLINE = ["clean_corpus", "token_table", "annotate_tokens", "extract_aspects", "nb_train",
            "polarity_score", "predict_flat", "polarity_training_set", "bio_tags",
            "classification_report"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # stage/task timings without the UI
    if log_dir:
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app_name="aspectra-bench", extra=extra)
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
