"""Write PLANS.md: per registered query, the executed plan's shuffles, broadcasts,
join strategies and scans (after running it at the given scale)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.plans.catalog import load_all  # noqa: E402
from cadenza.plans.inspect import plan_summary  # noqa: E402
from cadenza.session import local_session  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SKIP = {"forest_cv_metrics", "forest_importances", "forest_predictions", "ablation"}


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    rows = []
    for name, q in load_all().items():
        if name in SKIP:
            continue
        df = q.build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = plan_summary(df)
        joins = ", ".join(f"{k} x{v}" for k, v in sorted(s.joins.items())) or "—"
        scans = "; ".join(f"{t}: {schema.count(':')} cols" for t, schema, _ in s.scans if t.endswith(".parquet")) or "—"
        rows.append(f"| `{name}` | {s.exchanges} | {s.broadcasts} | {joins} | {s.python_nodes} | {scans} |")
    head = open(os.path.join(ROOT, "PLANS.head.md")).read()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write(head + "\n| query | shuffles | broadcasts | joins | Python nodes | scans (columns read) |\n"
                "| --- | --- | --- | --- | --- | --- |\n" + "\n".join(rows) + "\n")
    print(len(rows), "queries")


if __name__ == "__main__":
    main(sys.argv)
