"""python -m seatflow list | show NAME SF_DIR | write NAME SF_DIR FOLDER: the registered queries from a shell."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession


def main(args: list[str]) -> int:
    from seatflow.plans.catalog import ORACLE_SQL, QUERIES

    if args[:1] == ["list"]:
        for name in QUERIES:
            print(name, "(with SQL)" if name in ORACLE_SQL else "")
        return 0
    if len(args) < 3 or args[0] not in ("show", "write") or args[1] not in QUERIES or len(args) != (3 if args[0] == "show" else 4):
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName(f"seatflow {args[1]}").getOrCreate()
    out = QUERIES[args[1]](spark, args[2])
    if args[0] == "show":
        out.show(truncate=False)
    else:
        out.write.parquet(args[3])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
