"""Benchmark the headline exhibits.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_REPS``
(default 3) timed runs. Each run executes the full plan into Spark's ``noop``
sink, so nothing is collected to the driver. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ratecell.registry import QUERIES  # noqa: E402
from ratecell.session import local_session  # noqa: E402

HEADLINE = [
    "dislocation_trx_vehicle",
    "dislocation_trx_driver",
    "dislocation_inf_vehicle",
    "trx_classification",
    "inforce_classification",
    "elr",
    "elr_long",
    "earned_premium",
    "score_inforce",
    "reconcile",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="ratecell-bench")
    times = {}
    for name in names:
        q = QUERIES[name]
        run(q(spark, sf_dir))                       # warm-up (JIT, file listing)
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_exhibits_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
