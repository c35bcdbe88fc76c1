"""Time the headline queries once each and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose the data and the task slots.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textmill import build_session  # noqa: E402
from textmill.registered import QUERIES, load_all  # noqa: E402

HEADLINE = [
    "clean_text", "to_text_lines", "extract_blocks", "ngrams", "tag_counts", "yearly_answer_rate", "label_cooccurrence",
    "column_stats", "tfidf", "tfidf_vectorise", "doc_freq_idf", "stratified_split", "train_and_evaluate",
    "naive_bayes_predict", "one_vs_rest", "classification_report", "roc_per_class", "metric_panel", "vote_weights", "ml_knn",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    load_all()
    spark = build_session("bench", f"local[{cpus}]", int(cpus), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    # one small query so that the first timing does not include the start of the engine
    QUERIES["tag_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
