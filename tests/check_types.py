"""List queries whose Spark output types differ from the DuckDB oracle's types."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.plans.catalog import load_all  # noqa: E402
from cadenza.session import local_session  # noqa: E402
from tests.oracle_harness import duck  # noqa: E402

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    names = argv[2:]
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name, q in load_all().items():
        if q.sql is None or (names and name not in names):
            continue
        df = q.build(spark, sf_dir)
        st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
        dt = {row[0]: row[1] for row in con.execute(f"DESCRIBE ({q.sql})").fetchall()}
        diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
        if diff:
            bad += 1
            print(f"{name}: {diff}", flush=True)
    print(f"{bad} with type differences")


if __name__ == "__main__":
    main(sys.argv)
