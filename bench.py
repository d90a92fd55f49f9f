"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected); one warm-up pass of the flagship runs first.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revdrift.plans.queries import queries  # noqa: E402
from revdrift.session import local_session  # noqa: E402

HEADLINE = (
    "shingles_sorted",          # shingle the whole corpus, w in {25, 50}
    "sketch_sizes",             # lambda derivation by truncation over the revision chain
    "jaccard_to_baseline",      # Jaccard(C-0, C-v) for every (w, lambda)
    "lambda_mae",               # MAE of each lambda vs inf
    "best_lambda",
    "similarity_curves_wide",   # similarity curves
    "page_version_jaccard_w2",
    "revision_sampling",
    "concat_versions",
    "runtime_summary",
    "api_json_ingest",          # landed revision JSON -> offsets
    "html_to_text",             # rendered HTML -> article text
    "sketch_top_lambda",        # long form by chunks
    "corpus_catalog",           # ranks over whole histories
    "skipped_pages",
    "missing_sketches",         # a stored sketch table against what it should hold
    "similarity_table",         # read-through similarity table
    "revision_corpus",          # revisions + HTML -> texts
    "timing_csv",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    # 4x cores: document sizes are heavy-tailed, finer hash partitions balance the hashing
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 4 if cpus.isdigit() else 32)
    qs = queries()
    qs["jaccard_to_baseline"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
