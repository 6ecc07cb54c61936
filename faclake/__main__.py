"""Command line for spark-submit / python -m faclake.

    python -m faclake ingest   --lake L --landing DIR --schemas 'DIR/*.json' --mapping map.json
    python -m faclake refresh  --lake L [--views-json views.json] [--no-crosswalk] [--only-changed]
    python -m faclake query    --lake L --table T --sql "SELECT ..." [--limit N] --out DIR
    python -m faclake describe --schemas 'DIR/*.json' --table T
    python -m faclake run      --lake L --landing DIR --schemas 'DIR/*.json' --mapping map.json
                               [--views-json views.json] [--only-changed]   (ingest, then refresh)
    python -m faclake vacuum   --lake L --table T [--hours H]
    python -m faclake compact-log --log DIR

Every command prints its report as JSON lines on stdout (reports are small:
one row per file, view or document).  The session is the one spark-submit
provides, with its master and memory.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The session of spark-submit.  Master, memory and shuffle partitions are the
    submit arguments' affair; of our SQL settings only those are set that can be
    set at run time and that nobody has set."""
    from .session import SCALE_CONF, ship_package
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("faclake").config("spark.ui.enabled", "false").getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for key, value in SCALE_CONF.items():
        if key not in given and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def _print(df) -> None:
    for line in df.toJSON().collect():
        print(line)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="faclake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest", help="load landing CSV files into the lake")
    a.add_argument("--lake", required=True)
    a.add_argument("--landing", required=True)
    a.add_argument("--schemas", required=True, help="glob of schema documents")
    a.add_argument("--mapping", required=True, help="JSON file: csv name -> schema document")
    a.add_argument("--parallel", type=int, default=4)
    a.add_argument("--rfc-quotes", action="store_true")
    r = sub.add_parser("refresh", help="rebuild the crosswalk and materialise the views")
    r.add_argument("--lake", required=True)
    r.add_argument("--views-json", help="view definitions as SQL text {name: {statements, tables}}")
    r.add_argument("--no-crosswalk", action="store_true")
    r.add_argument("--parallel", type=int, default=4)
    r.add_argument("--broadcast-max-bytes", type=int)
    r.add_argument("--dimension-buckets", type=int,
                   help="bucket the shared dimension by join key (co-located joins)")
    r.add_argument("--only-changed", action="store_true",
                   help="rebuild only what reads a table that changed since the last refresh")
    r.add_argument("--skip-empty-ids", action="store_true",
                   help="leave the crosswalk's empty ids out of the shared dimension")
    v = sub.add_parser("vacuum", help="remove versions of a table that dead writers left")
    v.add_argument("--lake", required=True)
    v.add_argument("--table", required=True)
    v.add_argument("--hours", type=float, default=24.0, help="older than any write takes")
    c = sub.add_parser("compact-log", help="move the query log's requests into a file a day")
    c.add_argument("--log", required=True)
    q = sub.add_parser("query", help="guarded SQL over one table, exported as JSON lines")
    q.add_argument("--lake", required=True)
    q.add_argument("--table", required=True)
    q.add_argument("--sql", required=True)
    q.add_argument("--limit", type=int)
    q.add_argument("--out", required=True)
    u = sub.add_parser("run", help="ingest the landing folder, then rebuild crosswalk and views")
    for arg in ("--lake", "--landing", "--schemas", "--mapping"):
        u.add_argument(arg, required=True)
    u.add_argument("--views-json")
    u.add_argument("--parallel", type=int, default=4)
    u.add_argument("--only-changed", action="store_true")
    u.add_argument("--rfc-quotes", action="store_true")
    d = sub.add_parser("describe", help="schema document of one table")
    d.add_argument("--schemas", required=True)
    d.add_argument("--table", required=True)
    args = p.parse_args(argv)

    spark = _session()
    from .sources.tables import Lake
    if args.cmd == "ingest":
        from .operators import schema as S
        from .plans.ingest import ingest_landing
        with open(args.mapping) as f:
            mapping = json.load(f)
        registry = S.scan_schema_docs(spark, args.schemas)
        _print(ingest_landing(spark, Lake(spark, args.lake), args.landing, mapping, registry,
                              parallel=args.parallel, rfc_quotes=args.rfc_quotes))
    elif args.cmd == "refresh":
        from .plans import refresh as R
        lake = Lake(spark, args.lake)
        if args.views_json:
            if not args.no_crosswalk:
                n = R.rebuild_crosswalk(lake)
                print(json.dumps({"name": R.CROSSWALK, "status": "ok" if n else "empty", "source_rows": n}))
            _print(R.refresh_sql_views(spark, lake, R.load_view_definitions(args.views_json), args.parallel))
        else:
            _print(R.refresh_views(spark, lake, parallel=args.parallel, rebuild=not args.no_crosswalk,
                                   broadcast_max_bytes=args.broadcast_max_bytes,
                                   only_changed=args.only_changed,
                                   dimension_buckets=args.dimension_buckets,
                                   skip_empty_ids=args.skip_empty_ids))
    elif args.cmd == "vacuum":
        print(json.dumps({"table": args.table, "removed": Lake(spark, args.lake).vacuum(args.table, args.hours)}))
    elif args.cmd == "compact-log":
        from .operators.query import QueryLog
        print(json.dumps({"log": args.log, "requests": QueryLog(spark, args.log).compact()}))
    elif args.cmd == "query":
        from .operators import query as Qy
        df = Qy.run_query(spark, Lake(spark, args.lake), args.table, args.sql, args.limit)
        Qy.export_json(df, args.out)
        print(json.dumps({"table": args.table, "out": args.out}))
    elif args.cmd == "run":
        from .operators import schema as S
        from .plans import refresh as R
        from .plans.ingest import ingest_landing
        lake = Lake(spark, args.lake)
        with open(args.mapping) as f:
            mapping = json.load(f)
        registry = S.scan_schema_docs(spark, args.schemas)
        _print(ingest_landing(spark, lake, args.landing, mapping, registry,
                              parallel=args.parallel, rfc_quotes=args.rfc_quotes))
        if args.views_json:
            n = R.rebuild_crosswalk(lake)
            print(json.dumps({"name": R.CROSSWALK, "status": "ok" if n else "empty", "source_rows": n}))
            _print(R.refresh_sql_views(spark, lake, R.load_view_definitions(args.views_json), args.parallel))
        else:
            _print(R.refresh_views(spark, lake, parallel=args.parallel, only_changed=args.only_changed))
    elif args.cmd == "describe":
        from pyspark.sql import functions as F
        from .operators import schema as S
        reg = S.scan_schema_docs(spark, args.schemas).where(F.col("table_name") == args.table)
        found = S.describe_schema(reg)
        if not found.limit(1).count():
            print(json.dumps({"table": args.table, "status": "not found"}))
            return 1
        _print(found)
    return 0


if __name__ == "__main__":
    sys.exit(main())
