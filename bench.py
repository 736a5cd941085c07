"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs its whole plan once with the ``noop`` sink (no collect to the driver) and
is timed wall clock. Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from alnframe.plans import catalog  # noqa: E402
from alnframe.session import local_session  # noqa: E402

HEADLINE = [
    "merge_read_intervals",     # W1 two-level interval merge
    "balance_regions",          # AG1 + AG2
    "sort_coordinate",          # S2 global sort
    "mark_duplicates",          # W3
    "intersect_targets",        # JN4 range join
    "reads_in_targets",         # JN6 range semi join
    "validate_reads",           # V1-V21
    "mismatch_stats",           # JN8-JN10 reference join
    "pileup",                   # AG12
    "call_snvs",                # AG13
    "recal_table",              # AG10
    "apply_recalibration",      # PL3
    "sam_roundtrip",            # IO4 + IO1
    "call_variants",            # PL4 end to end
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16), app="alnframe-bench")
    spark.sparkContext.setLogLevel("OFF")
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    only = os.environ.get("BENCH_QUERIES")
    if only:
        names = [n for n in names if n in only.split(",")]
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
