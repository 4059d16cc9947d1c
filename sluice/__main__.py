"""Command line: ``python -m sluice sync ...`` and ``python -m sluice ingest ...``.

Runs the lead-table batches (or a subset) and prints one JSON run record per
table. Connection secrets are not handled here: pass JDBC properties with
``--jdbc-property`` from a secret store, or configure them in Spark.
"""

from __future__ import annotations

import argparse
import json
import sys

from sluice.functions.keys import HASH_ALGOS, KEY_MODES
from sluice.operators.load import Target
from sluice.plans.ingest import IngestOptions, ingest_tables, sync_tables
from sluice.plans.lead import lead_ingest_jobs, lead_sync_jobs, warehouse_table
from sluice.session import build_session
from sluice.spec import AuditSpec
from sluice.specs.lead import WAREHOUSE_PREFIX


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m sluice", description="Sync and ingest the lead tables")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    p.add_argument("--time-zone", default=None, help="session time zone for parsing naive times")
    p.add_argument("--as-of", default=None, help="run clock, e.g. '2024-06-01 12:00:00' (default: now)")
    p.add_argument("--source-system", default="SOURCE_SYSTEM", help="value of the source-system audit column")
    p.add_argument("--run-log", default=None, help="path of the run-log table")
    p.add_argument("--parallel", type=int, default=1, help="tables submitted at once")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("sync", help="copy the source tables over JDBC into the raw zone")
    s.add_argument("--jdbc-url", required=True)
    s.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    s.add_argument("--raw-base", required=True)
    s.add_argument("--stage", default="RAW")
    s.add_argument("--db", required=True)
    s.add_argument("--partition-column", default=None, help="numeric/date column for parallel reads")
    s.add_argument("--num-partitions", type=int, default=None)
    s.add_argument("--raw-partition-by", nargs="*", default=[], help="partition the raw tables by these columns")
    s.add_argument("--dynamic-partitions", action="store_true", help="replace only the partitions extracted")

    i = sub.add_parser("ingest", help="conform raw tables and load the warehouse tables")
    i.add_argument("--raw-base", required=True, help="folder holding leadassignment/, leadxref/, lead/")
    i.add_argument("--raw-format", default="parquet")
    where = i.add_mutually_exclusive_group(required=True)
    where.add_argument("--target-base", help="folder for path targets <prefix><TABLE>")
    where.add_argument("--target-database", help="catalog database for table targets")
    i.add_argument("--buckets", type=int, default=None, help="bucket catalog targets on the key")
    i.add_argument("--key-sketches", action="store_true", help="path targets: read only files that may hold a batch's keys")
    i.add_argument("--partition-by", nargs="*", default=[], help="partition new path targets by these columns")
    i.add_argument("--partition-col", default=None, help="a partition column that follows from the key: others are not read")
    i.add_argument("--write-mode", choices=["append", "incremental_insert"], default="append")
    i.add_argument("--historical-load", action="store_true")
    i.add_argument("--on-error", choices=["stop", "continue"], default="continue")
    i.add_argument("--tables", nargs="*", default=None, help="only these tables (default: all three)")
    i.add_argument("--create-if-missing", action="store_true")
    i.add_argument("--prefix", default=WAREHOUSE_PREFIX, help="prefix of the target tables' names")
    i.add_argument("--hash-algo", choices=HASH_ALGOS, default=None, help="default: the key mode's own")
    i.add_argument("--key-mode", choices=KEY_MODES, default="exact", help="compat: keys as targets loaded elsewhere hold them")
    i.add_argument("--null-token", default=None, help="text for NULL in compat keys")
    i.add_argument("--hash-after-clamp", action="store_true")
    i.add_argument("--dedupe", action="store_true")
    i.add_argument("--lenient", action="store_true", help="free-form parser for time text of no known shape")
    i.add_argument("--reject-unparseable", action="store_true")
    i.add_argument("--drop-rejects", action="store_true", help="count rejected rows without keeping them")
    i.add_argument("--corrupt-col", default=None, help="csv/json: set records aside that do not fit the format")
    i.add_argument("--rebalance", action="store_true", help="shuffle raw rows into even partitions first")
    i.add_argument("--reject-base", default=None, help="folder for rows set aside, one per table")

    r = sub.add_parser("report", help="per-column contract report of raw tables (one pass each)")
    r.add_argument("--raw-base", required=True, help="folder holding leadassignment/, leadxref/, lead/")
    r.add_argument("--raw-format", default="parquet")
    r.add_argument("--tables", nargs="*", default=None, help="only these tables (default: all three)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"sluice-{args.cmd}", time_zone=args.time_zone)
    if args.cmd == "report":
        from sluice.operators.conform import schema_report
        from sluice.specs import lead_specs
        from sluice.sources.raw import read_raw

        for name, spec in lead_specs(source_system=args.source_system, time_zone=args.time_zone).items():
            if args.tables is not None and name not in args.tables:
                continue
            raw = read_raw(spark, f"{args.raw_base.rstrip('/')}/{name.replace('_', '')}", args.raw_format)
            for row in schema_report(raw, spec, args.as_of).orderBy("ordinal").collect():
                print(json.dumps({"table": name, **row.asDict()}))
        return 0
    if args.cmd == "sync":
        props = dict(kv.split("=", 1) for kv in args.jdbc_property)
        jobs = lead_sync_jobs(spark, args.jdbc_url, args.raw_base, args.stage, args.db, properties=props,
                              partition_column=args.partition_column, num_partitions=args.num_partitions,
                              raw_partition_by=tuple(args.raw_partition_by),
                              dynamic_partitions=args.dynamic_partitions)
        records = sync_tables(spark, jobs, audit=AuditSpec(source_system=args.source_system),
                              as_of=args.as_of, run_log=args.run_log, max_parallel=args.parallel)
    else:
        if args.target_base:
            def target_for(name: str) -> Target:
                return Target(path=f"{args.target_base.rstrip('/')}/{warehouse_table(name, prefix=args.prefix)}",
                              partition_by=tuple(args.partition_by), sketch=args.key_sketches)
        else:
            def target_for(name: str) -> Target:
                return Target(table=warehouse_table(name, args.target_database, args.prefix), buckets=args.buckets)

        reject_for = None
        if args.reject_base:
            def reject_for(name: str) -> Target:
                return Target(path=f"{args.reject_base.rstrip('/')}/{warehouse_table(name, prefix=args.prefix)}")

        jobs = lead_ingest_jobs(spark, args.raw_base, target_for, raw_format=args.raw_format,
                                time_zone=args.time_zone, source_system=args.source_system,
                                corrupt_col=args.corrupt_col, reject_target_for=reject_for)
        enabled = None if args.tables is None else {t: t in args.tables for t in ("lead", "lead_xref",
                                                                                    "lead_assignment")}
        opts = IngestOptions(mode=args.write_mode, historical=args.historical_load, as_of=args.as_of,
                             create_if_missing=args.create_if_missing, hash_algo=args.hash_algo,
                             key_mode=args.key_mode, null_token=args.null_token,
                             hash_after_clamp=args.hash_after_clamp, dedupe=args.dedupe, lenient=args.lenient,
                             reject_unparseable=args.reject_unparseable, drop_rejects=args.drop_rejects,
                             rebalance=args.rebalance, partition_col=args.partition_col)
        records = ingest_tables(spark, jobs, opts, on_error=args.on_error, enabled=enabled,
                                run_log=args.run_log, max_parallel=args.parallel)
    for r in records:
        print(json.dumps({k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in vars(r).items()}))
    return 0 if all(r.status != "failed" for r in records) else 1


if __name__ == "__main__":
    sys.exit(main())
