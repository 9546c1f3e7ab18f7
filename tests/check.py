"""``python tests/check.py [sf] [name part ...]``: every query against its SQL, with times."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from skyops.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    parts = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = oracle.connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        begin = time.time()
        try:
            problem = oracle.difference(spark, con, query, sql[name], sf_dir) if name in sql else "no SQL"
        except Exception as error:  # report and go on to the next query
            problem = "".join(traceback.format_exception_only(error))[:1500]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:55s} {time.time() - begin:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
