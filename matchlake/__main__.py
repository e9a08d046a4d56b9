"""Command line: build the layers, run the data tests, print a KPI.

    python -m matchlake --root PATH build --matches PATH [--leagues PATH]
    python -m matchlake --root PATH test
    python -m matchlake --root PATH kpi kpi_avg_goals_by_year

``--root`` may be left out where a metastore keeps the tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from matchlake.operators.kpis import KPIS
from matchlake.operators.quality import gate
from matchlake.plans.build import (
    MART_TABLE,
    BuildConfig,
    open_layers,
    quality_report,
    run_build,
)
from matchlake.session import build_session
from matchlake.sources.tables import Namespaces, read_mart


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="matchlake")
    for layer in ("raw", "staging", "mart"):
        parser.add_argument(f"--{layer}-database", default=getattr(Namespaces, layer))
    parser.add_argument("--root", help="folder of the databases; else the catalog decides")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="rebuild every layer, then run the data tests")
    build.add_argument("--matches", required=True, nargs="+", help="match CSV files or folders")
    build.add_argument("--leagues", help="league CSV; the built-in dimension when left out")
    build.add_argument("--no-quoted-newlines", action="store_true")
    commands.add_parser("test", help="run the data tests on the published layers")
    kpi = commands.add_parser("kpi", help="print one dashboard aggregation")
    kpi.add_argument("name", choices=list(KPIS))
    return parser.parse_args(argv)


def show(rows: DataFrame) -> None:
    """All rows, tab-separated, fetched one partition at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("matchlake")
    names = Namespaces(
        raw=args.raw_database,
        staging=args.staging_database,
        mart=args.mart_database,
        root=args.root,
    )
    cfg = BuildConfig(
        matches_csv=getattr(args, "matches", []),
        leagues_csv=getattr(args, "leagues", None),
        namespaces=names,
        allow_quoted_newlines=not getattr(args, "no_quoted_newlines", False),
    )
    if args.command == "build":
        run_build(spark, cfg)
        return
    if args.root:
        open_layers(spark, cfg)
    if args.command == "test":
        report = quality_report(spark, cfg)
        show(report.orderBy("model", "column_name", "test"))
        gate(report)
    else:
        show(KPIS[args.name](read_mart(spark, names.table("mart", MART_TABLE))))


if __name__ == "__main__":
    main()
