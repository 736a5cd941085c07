"""Write the formatted physical plans of the headline queries to docs/plans.txt.

usage: python tools/explain_plans.py [sf_dir]
Plans are built, not executed (round-trip queries write their input files first)."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from alnframe.plans import catalog  # noqa: E402
from alnframe.session import local_session  # noqa: E402

NAMES = ["merge_read_intervals", "reads_in_targets", "intersect_targets", "mark_duplicates", "mismatch_stats",
         "pileup", "recal_table", "stored_region_query", "check_sorted"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    qs = catalog.queries()
    out = io.StringIO()
    for name in NAMES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            qs[name](spark, sf).explain("formatted")
        text = buf.getvalue()
        # Keep the operator tree and the scan details; drop per-node attribute lists.
        keep = []
        for line in text.splitlines():
            if line.startswith(("Output", "Arguments", "Input")):
                continue
            keep.append(line)
        out.write(f"==== {name} ====\n" + "\n".join(keep) + "\n\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans.txt")
    with open(path, "w") as f:
        f.write(out.getvalue())
    print(path)


if __name__ == "__main__":
    main()
