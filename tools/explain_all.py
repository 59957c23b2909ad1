"""Write the formatted physical plan of every query of the survey to docs/plans/.

    python tools/explain_all.py [sf_dir]

Plans are taken before execution (AQE's initial plan), so they show the
exchanges, aggregates and joins the code asks for; AQE may still coalesce
partitions or split skewed ones at run time. Queries that write tables while
being built show the read of what they wrote.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from qtrbars.plans.queries import QUERIES
    from qtrbars.session import build_session

    spark = build_session()
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        # drop run-specific ids and local paths so snapshots diff cleanly
        text = re.sub(r"#\d+L?", "", text)
        text = re.sub(r"plan_id=\d+", "plan_id=_", text)
        text = re.sub(r"file:[^\],]*", "file:<path>", text)
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(text)
        print(name, text.count("Exchange"), "exchange mentions")
    spark.stop()


if __name__ == "__main__":
    main()
