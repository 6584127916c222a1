"""Check queries against DuckDB from the command line: run_oracle.py [folder] [name ...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from comparing import connect, differences  # noqa: E402

import __spark_entry__  # noqa: E402
from sitelens.session import local_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    wanted = [
        name
        for name in queries
        if len(sys.argv) < 3 or any(name.startswith(prefix) for prefix in sys.argv[2:])
    ]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                problems = differences(df, connection, sql[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - start:.2f}s", flush=True)
        for problem in problems:
            print("   ", problem[:1500], flush=True)
        bad += bool(problems)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    spark.stop()
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
