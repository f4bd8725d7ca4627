"""Write the physical plan of every registered query to PLANS.md.

    python tools/explain_all.py [sf_dir]

Plans are the initial adaptive plans (AQE may still coalesce partitions,
switch joins to broadcast or split skewed partitions at run time). Long
expression lines are cut; the operator structure, pushed filters, exchanges
and broadcasts are what this file is for.
"""

from __future__ import annotations

import io
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stratum.plans import catalog  # noqa: E402
from stratum.session import local_session  # noqa: E402

KEEP = ("Exchange", "Broadcast", "Scan", "Join", "Aggregate", "Window", "Sort", "TakeOrdered",
        "CollectMetrics", "Generate", "Union", "Filter", "Expand", "Limit", "Coalesce")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans of the registered queries", "",
           f"Initial adaptive plans at `{sf_dir}`, operators only (expressions cut at 150 chars).", ""]
    for name, q in sorted(catalog.QUERIES.items()):
        buf = io.StringIO()
        with redirect_stdout(buf):
            q(spark, sf_dir).explain()
        lines = [ln for ln in buf.getvalue().splitlines()
                 if any(k in ln for k in KEEP) or ln.startswith("AdaptiveSparkPlan")]
        out += [f"## {name}", "", "```"] + [ln[:150] for ln in lines] + ["```", ""]
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
