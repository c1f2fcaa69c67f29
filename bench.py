"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with the no-op sink (all rows computed, nothing collected).
The staged files that the file-based queries read are written first and timed apart.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkdesk.plans import registry, staging  # noqa: E402
from sparkdesk.session import local_session, ship_package, table  # noqa: E402

SLOW = ("simsearch_benchmark_docs_both",)  # run last


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = local_session(cpus, app="sparkdesk-bench")
    registry.load_all()
    ship_package(spark)  # the staging below already runs Python in the workers

    # warm-up (JVM, Python workers), not timed
    table(spark, sf_dir, "nation").write.format("noop").mode("overwrite").save()

    t0 = time.time()
    staging.customer_csv(spark, sf_dir)
    staging.customer_workbooks(spark, sf_dir)
    staging.document_files(spark, sf_dir)
    staging_sec = round(time.time() - t0, 3)

    times: dict = {}
    errors: dict = {}

    def report() -> None:
        sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
        out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
               "queries": times, "sf": sf, "cpus": cpus, "staging_sec": staging_sec}
        if errors:
            out["errors"] = errors
        print(json.dumps(out), flush=True)

    def ended(*_) -> None:  # what was measured is not lost
        errors["bench"] = "ended by a signal"
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    for key, fn in sorted(registry.QUERIES.items(), key=lambda q: q[0] in SLOW):
        if only and key not in only:
            continue
        t = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.time() - t, 3)
            print(f"{key}: {times[key]}s", file=sys.stderr, flush=True)
        except Exception as e:  # reported, not hidden
            errors[key] = f"{type(e).__name__}: {str(e)[:200]}"
    report()
    spark.stop()


if __name__ == "__main__":
    main()
