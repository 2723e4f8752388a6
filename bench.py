"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``.  Each query runs once to warm up the engine and is then timed;
results go to a sink that reads every row and column and keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factgrade.catalogue.queries import QUERIES  # noqa: E402
from factgrade.session import local_session  # noqa: E402

HEADLINE = [
    "sentences",
    "parse_facts",
    "stitch_facts",
    "bm25_top3",
    "atomise_prompt",
    "answer_prompt",
    "decisions",
    "prompt_dedupe",
    "pending",
    "verify_exact",
    "verify_tokens",
    "score_f1",
    "summary_by_lang",
    "domain_model_matrix",
    "boxplot",
    "regression",
    "first_n_per_source",
    "evaluate_offline",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
