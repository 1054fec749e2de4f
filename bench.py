"""Time the headline queries and print one JSON line.

The first entries build the stage tables (index, candidates, judgments, PMI) that the later ones read, so the total
covers the whole way from raw text to evaluated runs. Every result is computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankweave import catalog  # noqa: E402
from rankweave.plans.workbench import Workbench  # noqa: E402
from rankweave.session import build_session, clear_stages  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SHARED = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="rankweave-bench-")
STAGES = ("index", "candidates", "other_run", "qrels", "pmi", "features")
HEADLINE = (
    "bm25_top10", "bm25_or_top10", "bm25_lib_top10", "search_run", "scorer_compare", "term_freq", "bigram_counts",
    "pmi", "features_all", "ev_all", "ev_ndcg", "win_count", "err_too_low", "triples", "train_pairs",
    "linear_rank", "adarank_weak", "query_to_query", "passage_to_doc", "term_pairs", "query_features",
    "regression_report", "group_summary", "index_upsert", "davies_bouldin",
)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", int(CPUS),
        **{"spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": SHARED},
    )
    spark.sparkContext.setLogLevel("ERROR")
    bench = Workbench.of(spark, FOLDER)
    times: dict[str, float] = {}
    for stage in STAGES:
        start = time.perf_counter()
        getattr(bench, stage)
        times[f"stage_{stage}"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }))
    clear_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
