"""Check every query against its SQL at one scale: ``python -m tests.check_all [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

from __spark_entry__ import oracle_sql, queries
from stratalake.session import local_session

from .oracle import connect, differences


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    con = connect(sf_dir)
    failed = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = oracle_sql().get(name)
            problem = differences(df, con, sql) if sql else f"(no SQL) {df.count()} rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:24s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
