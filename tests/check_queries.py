"""Run registered queries against their oracle: python tests/check_queries.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.plans.catalog import load_all  # noqa: E402
from cadenza.session import local_session  # noqa: E402
from tests.oracle_harness import compare, duck  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    reg = load_all()
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = q.build(spark, sf_dir)
            if q.sql is None:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows"
            else:
                ok, msg = compare(df, con, q.sql)
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:800]}"
            traceback.print_exc(limit=2)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:40s} {time.time() - t:6.1f}s  {msg}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
