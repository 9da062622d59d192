"""Command line entry point, for ``spark-submit`` or ``python -m sparkmarts``.

    sparkmarts build RAW OUT [--now ISO] [--full-refresh] [--fill-missing]
    sparkmarts freshness RAW [--now ISO] [--loaded-at TABLE=COLUMN[:FILTER] ...]

``build`` runs :func:`sparkmarts.plans.build.build_all` and prints the check
report; ``freshness`` prints one status row per source table. The session
comes from the cluster's configuration (``SparkSession.builder.getOrCreate``);
only the options the plans rely on are added when they are not set."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from sparkmarts.session import clear_scratch, recommended_conf


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("sparkmarts").getOrCreate()
    for k, v in recommended_conf().items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def _now(value: str | None) -> dt.datetime:
    if value:
        return dt.datetime.fromisoformat(value)
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="sparkmarts")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build or update every mart")
    b.add_argument("raw")
    b.add_argument("out")
    b.add_argument("--now")
    b.add_argument("--full-refresh", action="store_true")
    b.add_argument("--fill-missing", action="store_true", help="absent raw columns become typed NULLs")
    f = sub.add_parser("freshness", help="source freshness report")
    f.add_argument("raw")
    f.add_argument("--now")
    f.add_argument("--loaded-at", action="append", default=[], metavar="TABLE=COLUMN[:FILTER]")
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "build":
        from sparkmarts.plans.build import build_all
        from sparkmarts.plans.warehouse import Warehouse

        wh = Warehouse(spark, args.raw, fill_missing=args.fill_missing)
        report = build_all(spark, wh, args.out, _now(args.now), full_refresh=args.full_refresh)
        report.orderBy("relation", "check_name").show(200, truncate=False)
        failed = report.where("status = 'error'").count()
        clear_scratch(spark)
        return 1 if failed else 0
    from sparkmarts.operators.freshness import freshness_report
    from sparkmarts.sources.readers import SOURCE_TABLES, source_path, table_exists

    loaded_at = {}
    for spec in args.loaded_at:
        table, rest = spec.split("=", 1)
        column, _, flt = rest.partition(":")
        loaded_at[table] = (column, flt or None)
    tables = [t for t in SOURCE_TABLES if table_exists(spark, source_path(args.raw, t))]
    freshness_report(spark, args.raw, tables, _now(args.now), loaded_at).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
