"""Ready-made jobs for the three lead tables (sync and ingest)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import SparkSession

from sluice.operators.load import Target
from sluice.plans.ingest import IngestJob, SyncJob
from sluice.sources.jdbc import bare_name, parse_table_name, read_jdbc
from sluice.sources.raw import raw_path, read_raw
from sluice.specs.lead import SOURCE_TABLES, WAREHOUSE_PREFIX, lead_specs


def warehouse_table(name: str, schema: str | None = None, prefix: str = WAREHOUSE_PREFIX) -> str:
    """``<prefix><TABLE>``, optionally qualified by a database/schema."""
    table = f"{prefix}{name.upper()}"
    return f"{schema}.{table}" if schema else table


def lead_ingest_jobs(spark: SparkSession, raw_base: str, target_for: Callable[[str], Target], *,
                     raw_format: str = "parquet", time_zone: str | None = None,
                     source_system: str = "SOURCE_SYSTEM", corrupt_col: str | None = None,
                     reject_target_for: Callable[[str], Target] | None = None) -> list[IngestJob]:
    """One job per lead table, in processing order.

    Raw tables live at ``<raw_base>/<table name without underscores>``; the
    assignment extract may hold multi-line text records.
    """
    specs = lead_specs(source_system=source_system, time_zone=time_zone)
    jobs = []
    for name, spec in specs.items():
        path = f"{raw_base.rstrip('/')}/{name.replace('_', '')}"
        multi = name == "lead_assignment"
        jobs.append(IngestJob(
            spec,
            lambda p=path, m=multi: read_raw(spark, p, raw_format, multi_line=m, corrupt_col=corrupt_col),
            target_for(name),
            reject_target_for(name) if reject_target_for else None,
            corrupt_col,
        ))
    return jobs


def lead_sync_jobs(spark: SparkSession, url: str, raw_base: str, stage: str, db: str, *,
                   properties: dict | None = None, partition_column: str | None = None,
                   num_partitions: int | None = None, raw_partition_by: tuple[str, ...] = (),
                   dynamic_partitions: bool = False,
                   tables: tuple[str, ...] = SOURCE_TABLES) -> list[SyncJob]:
    """One JDBC-to-raw job per source table (parallel read when a column is given).

    ``raw_partition_by`` with ``dynamic_partitions`` lands each extract in its
    own partitions (for example an extract-day column) and replaces only those.
    """
    jobs = []
    for table in tables:
        name = bare_name(parse_table_name(table)[1])
        jobs.append(SyncJob(
            name,
            lambda t=table: read_jdbc(spark, url, t, properties=properties,
                                      partition_column=partition_column, num_partitions=num_partitions),
            raw_path(raw_base, stage, db, table),
            partition_by=raw_partition_by,
            dynamic_partitions=dynamic_partitions,
        ))
    return jobs
