"""Command line: ``python -m fundscope list`` and ``python -m fundscope run QUERY --tables FOLDER [--out FOLDER]``."""

from __future__ import annotations

import argparse
import sys

from .catalog import ORACLES, QUERIES


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fundscope", description="Run registered queries and jobs.")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries; those with SQL of their own are marked")
    run = commands.add_parser("run", help="run one query")
    run.add_argument("query", choices=sorted(QUERIES), metavar="QUERY")
    run.add_argument("--tables", required=True, help="folder of the Parquet tables")
    run.add_argument("--out", help="folder for the result; without it the first rows are shown")
    run.add_argument("--format", choices=["parquet", "json", "csv"], default="parquet")
    run.add_argument("--rows", type=int, default=20, help="rows to show")
    asked = parser.parse_args(argv)
    if asked.command == "list":
        for name in sorted(QUERIES):
            print(name, "sql" if name in ORACLES else "-", sep="\t")
        return 0

    from pyspark.sql import SparkSession

    df = QUERIES[asked.query](SparkSession.builder.appName(f"fundscope {asked.query}").getOrCreate(), asked.tables)
    if asked.out:
        df.write.mode("overwrite").format(asked.format).save(asked.out)
    else:
        df.show(asked.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
