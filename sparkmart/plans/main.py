"""Command line of the full run.

    spark-submit load.py --root s3a://bucket/mart --file s3a://bucket/incoming/sales.csv \\
        --incremental-flag 1 --publish gold
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sparkmart.plans import load_job
from sparkmart.sources.files import read_table


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of all tables")
    parser.add_argument("--file", action="append", default=[], help="delimited file to land")
    parser.add_argument("--incremental-flag", choices=["0", "1"], default="0",
                        help="0 builds gold from empty tables, 1 adds the open window")
    parser.add_argument("--fact-mode", choices=["rows", "grain"], default="rows")
    parser.add_argument("--table", help="typed table or view of the catalog to extract from, instead of files")
    parser.add_argument("--extract", choices=["window", "files"], default="window",
                        help="files also takes landed rows below the bound that no load has")
    parser.add_argument("--strict", action="store_true", help="an error instead of rejects")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    parser.add_argument("--by-name", action="store_true", help="columns by the header's names, in any order")
    parser.add_argument("--publish", metavar="DATABASE", help="catalog database for gold")
    parser.add_argument("--validate", action="store_true", help="show the checks afterwards")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("sparkmart").getOrCreate()
    mode = "incremental" if args.incremental_flag == "1" else "initial"
    source = read_table(spark, args.table) if args.table else None
    store = load_job.run(
        spark, args.root, args.file, source, mode, args.fact_mode, args.extract, args.strict, args.multi_line, args.by_name
    )
    if args.publish:
        load_job.publish(store, args.publish)
    if args.validate:
        for name, table in load_job.validate(store).items():
            print(name)
            table.show(truncate=False)

