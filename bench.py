"""Headline queries at one scale: one JSON line with wall seconds per query.

Every query runs once at the smallest scale first, so that the numbers hold no start-up cost, and is
then timed writing all of its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from basketlens.plans.registry import QUERIES
from basketlens.session import local_session

HEADLINES = [
    "clean_retail",
    "best_sellers_top10",
    "dedupe_lines",
    "basket_recommend_unseen",
    "item_cosine",
    "ibcf_predict",
    "ubcf_predict",
    "popular_topn",
    "item_based_topn",
    "user_based_topn",
    "rules_recommend",
    "rating_cv_rmse",
]


def run(spark, name: str, folder: str) -> float:
    start = time.time()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("basketlens-bench", cores, int(cores) if cores.isdigit() else 8)
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    seconds = {}
    for name in names:
        run(spark, name, warm)
        seconds[name] = round(run(spark, name, folder), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_wall_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINES)
