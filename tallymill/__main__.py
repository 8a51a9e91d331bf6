"""Daily run from the command line.

    spark-submit -m tallymill SNAPSHOT_FOLDER REPORT_TABLE ROOT [options]
"""

import argparse
import re

from pyspark.sql import SparkSession

from tallymill.functions.values import DATE_FORMATS
from tallymill.operators.formats import DETECT
from tallymill.plans.daily import run_daily
from tallymill.plans.serving import VIEW_SINCE, create_serving_view
from tallymill.schema import GROUP_TABLE
from tallymill.session import SETTINGS
from tallymill.sinks.layout import LAYOUTS
from tallymill.sinks.publish import STRATEGIES, drop_dead
from tallymill.sources.reports import read_reports
from tallymill.sources.snapshot import newest_snapshot


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallymill", description=__doc__)
    parser.add_argument("snapshot_folder")
    parser.add_argument("report_table")
    parser.add_argument("root", help="folder of published tables and pending rows")
    parser.add_argument("--strategy", choices=STRATEGIES, default="replace")
    parser.add_argument("--kept", help="name of a kept reduction that the reports are merged into")
    parser.add_argument("--load-id", help="appended once; the name of the snapshot if not given")
    parser.add_argument("--layout", choices=LAYOUTS, default="sorted")
    parser.add_argument("--on-fraction", choices=("fail", "null"), default="fail")
    parser.add_argument("--date-format", action="append", help="tried in order; 'iso', another known name or a pattern; 'detect' alone finds them")
    parser.add_argument("--tie-breaker", action="append", default=[], help="column of the reports")
    parser.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    parser.add_argument("--pending-format", default="parquet")
    parser.add_argument("--view", help="name of a serving view to make on the first table")
    parser.add_argument("--view-since", default=VIEW_SINCE)
    parser.add_argument("--drop-dead", action="store_true", help="remove snapshots no table uses")
    return parser.parse_args(given)


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("tallymill").config(map=SETTINGS).getOrCreate()
    name = newest_snapshot(spark, args.snapshot_folder).rsplit("/", 1)[-1]
    reports = read_reports(spark, table=args.report_table, keep=args.tie_breaker)
    counts = run_daily(
        spark,
        args.snapshot_folder,
        reports,
        args.root,
        tie_breakers=args.tie_breaker,
        on_fraction=args.on_fraction,
        date_formats=DETECT if args.date_format == [DETECT] else args.date_format or DATE_FORMATS,
        strategy=args.strategy,
        layout=args.layout,
        multi_line=args.multi_line,
        pending_source=args.pending_format,
        kept=args.kept,
        load_id=args.load_id or re.sub(r"[^\w.:-]", "_", name),
    )
    for name, count in counts.items():
        print(f"{name}: {count}")
    if args.view:
        first = next(iter(GROUP_TABLE.values()))
        create_serving_view(spark, args.report_table, first, args.view, args.view_since)
    if args.drop_dead:
        for path in drop_dead(spark, f"{args.root}/tables", GROUP_TABLE.values()):
            print(f"removed: {path}")


if __name__ == "__main__":
    main()
