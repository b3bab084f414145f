"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully materialised through the ``noop`` sink; a fresh plan is
built per repetition (so checkpointed scoring is re-run), the session stays
warm. Reported: median of ``BENCH_REPS`` (default 3) after one warm-up pass.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from shelfwise.plans.recplan import RecPlan  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HEADLINE = {
    "item_features": lambda p: [p.item_features],
    "split_assignment": lambda p: [p.split_assignment],
    # train, dev and test come out of one plan (a ``split`` column), as a
    # pipeline writes them (``partitionBy("split")``).
    "examples_all_splits": lambda p: [p.examples],
    "text_examples": lambda p: [p.text_examples],
    "prompts_text_multi": lambda p: [p.prompts_text_multi],
    "scored_ranking": lambda p: [p.scored_ranking],
}


def _sf(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="shelfwise-bench",
        shuffle_partitions=max(8, cpus * 2),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )

    def run_once(name: str) -> float:
        t = time.perf_counter()
        plan = RecPlan(spark, sf_dir)
        for df in HEADLINE[name](plan):
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for name in HEADLINE:  # warm-up: JIT, file listing, Python workers
        run_once(name)
    results = {name: statistics.median(run_once(name) for _ in range(reps)) for name in HEADLINE}
    total = sum(results.values())
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "reps": reps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
