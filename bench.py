"""Time the headline queries: `BENCH_SF_DIR` (data), `BENCH_CPUS` (cores), `BENCH_RUNS` (timed runs after one warm-up).

Prints one JSON line. A run writes the whole result to a sink that discards it, so nothing is pruned or collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ramure.plans.catalog import QUERIES
from ramure.session import build_session

HEADLINE = (
    "code_levels", "preprocess_documents", "char_ngrams", "map_codes", "build_training_data", "cap_by_stratum", "stratified_split",
    "accuracy_by_level", "topk_overall", "metrics_by_confidence", "metrics_all_sources", "evaluation_report", "coverage_curve",
    "heatmap_by_shop", "confidence_by_budget", "prediction_summary", "cascade_decode", "beam_decode", "mask_children", "nb_counts",
    "nb_score", "flat_predictions", "page_sections", "assemble_batches",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"), spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - started)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline query seconds, warm", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
