"""Command line: python tests/run_oracle.py [folder] [name-prefix ...] compares and times queries."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemason import plans  # noqa: E402
from lakemason.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(folder: str, prefixes: list[str]) -> None:
    spark = local_session("oracle", cores=8, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
    con, sqls, bad = connect(folder), plans.oracle_sql(), 0
    for name, run in plans.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        begin = time.time()
        try:
            if name in sqls:
                verdict = compare(run(spark, folder), con, sqls[name])
            else:
                verdict = f"rows only: {run(spark, folder).count()}"
        except Exception as error:  # report and go on
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = verdict is None or verdict.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - begin:.1f}s {verdict or ''}", flush=True)
    print(f"{bad} bad", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
