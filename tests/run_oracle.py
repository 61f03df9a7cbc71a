"""Compare every registered query with its DuckDB oracle.

usage: python tests/run_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import __spark_entry__ as E  # noqa: E402
from kinloom.session import local_session  # noqa: E402
from oracle_compare import compare, duck_connect  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session()
    con = duck_connect(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        t = time.time()
        if k not in sqls:
            n = qs[k](spark, sf).count()
            print(f"[rows-only] {k}: {n} rows ({time.time() - t:.1f}s)", flush=True)
            continue
        try:
            ok, msg = compare(qs[k](spark, sf), sqls[k], con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"[{'ok' if ok else 'FAIL'}] {k}: {msg} ({time.time() - t:.1f}s)", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
