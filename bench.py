"""Benchmark: run the headline queries on one scale factor and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced to completion with the ``noop`` sink (every row is
computed, nothing is collected). Fitted state is dropped between queries, so
a query's time includes its own fit.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_text",
    "text_features",
    "term_counts",
    "tfidf_l2",
    "stratified_split",
    "upsample",
    "mnb_score",
    "bnb_score",
    "gnb_score",
    "confusion_matrix",
    "roc_points",
    "average_precision",
    "cv_scores_mnb",
    "grid_mnb",
    "top_coefficients",
    "top_terms_by_class",
    "bigram_collocations",
    "predict_batch",
    "preprocess_text",
    "logistic_regression",
    "model_results",
    "kernel_features",
    "knn_score",
    "decision_tree",
    "random_forest",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    from textsieve.plans import catalog
    from textsieve.session import get_spark

    spark = get_spark(f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))),
        "spark.driver.memory": "16g",
        # the tables are one row group each; on one machine they are spread by a setting, never by their size
        "spark.textsieve.inputPartitions": str(2 * int(cpus)),
    })
    times, errors = {}, {}
    for name in (only or HEADLINE):
        fn = catalog.QUERIES.get(name)
        if fn is None:
            continue
        catalog.reset_state(spark)
        t0 = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 -- one failing query must not lose the others' timings
            errors[name] = f"{type(e).__name__}: {e}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
