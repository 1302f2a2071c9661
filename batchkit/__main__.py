"""Run one named query as a batch job and write its result.

    spark-submit --py-files batchkit.zip batchkit/__main__.py <key> <tables_dir> <output_path> \
        [--format parquet|json|csv|noop] [--mode overwrite]
    python -m batchkit --list

The session comes from spark-submit (cluster settings win); only when run
locally without a session is one built with the package defaults.
"""

from __future__ import annotations

import argparse
import sys

from batchkit.plans.catalog import ORACLE, QUERIES
from batchkit.session import get_session


def run(spark, key: str, tables_dir: str, output: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Build query ``key`` over ``tables_dir`` and write it to ``output`` in ``fmt``."""
    if key not in QUERIES:
        raise KeyError(f"unknown query {key!r}; known: {', '.join(sorted(QUERIES))}")
    df = QUERIES[key](spark, tables_dir)
    writer = df.write.mode(mode)
    if fmt == "noop":
        writer.format("noop").save()
    else:
        writer.format(fmt).save(output)
    return output


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="batchkit")
    p.add_argument("key", nargs="?")
    p.add_argument("tables_dir", nargs="?")
    p.add_argument("output", nargs="?")
    p.add_argument("--format", default="parquet", choices=["parquet", "json", "csv", "noop"])
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "append", "ignore"])
    p.add_argument("--list", action="store_true", help="list query keys (* = has a SQL oracle)")
    args = p.parse_args(argv)
    if args.list:
        for k in sorted(QUERIES):
            print(f"{k}{' *' if k in ORACLE else ''}")
        return 0
    if not (args.key and args.tables_dir and (args.output or args.format == "noop")):
        p.error("key, tables_dir and output are required")
    run(get_session(), args.key, args.tables_dir, args.output or "", args.format, args.mode)
    return 0


if __name__ == "__main__":
    sys.exit(main())
