"""python -m rasterloom: lists the queries, or runs some over a folder of tables and writes their results."""

from __future__ import annotations

import argparse

from rasterloom.plans.registry import QUERIES
from rasterloom.session import session


def main() -> None:
    parser = argparse.ArgumentParser(prog="rasterloom", description=__doc__)
    parser.add_argument("queries", nargs="*", help="names; none lists them")
    parser.add_argument("--tables", help="folder of the Parquet tables")
    parser.add_argument("--out", help="folder to write the results to; without it they are shown")
    parser.add_argument("--master", default="local[*]")
    args = parser.parse_args()
    if not args.queries:
        print("\n".join(sorted(QUERIES)))
        return
    if unknown := sorted(set(args.queries) - set(QUERIES)):
        parser.error(f"unknown queries: {', '.join(unknown)}")
    spark = session(args.master)
    for name in args.queries:
        df = QUERIES[name](spark, args.tables)
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        else:
            df.show(20, truncate=False)


if __name__ == "__main__":
    main()
