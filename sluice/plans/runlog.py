"""Run log: one row per table per run, appended to a small table."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = (
    "run_id string, table string, action string, mode string, rows_in long, rows_written long, "
    "rows_rejected long, started_at timestamp, ended_at timestamp, status string, error string, "
    "residue string"
)


@dataclass
class RunRecord:
    run_id: str
    table: str
    action: str  # "sync" or "ingest"
    mode: str | None
    rows_in: int | None
    rows_written: int | None
    rows_rejected: int | None
    started_at: datetime
    ended_at: datetime
    status: str  # "ok", "failed", "skipped"
    error: str | None = None
    residue: str | None = None  # JSON: column -> non-blank raw cells that did not parse


def records_frame(spark: SparkSession, records: list[RunRecord]) -> DataFrame:
    """The records as a frame (one row per table run: a handful of rows)."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in records], RUN_LOG_SCHEMA)


def append_run_log(spark: SparkSession, path: str, records: list[RunRecord]) -> None:
    if records:
        records_frame(spark, records).coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def latest_runs(log: DataFrame, status: str | None = "ok") -> DataFrame:
    """Last run per (table, action), optionally only among runs with ``status``."""
    if status is not None:
        log = log.filter(F.col("status") == status)
    w = Window.partitionBy("table", "action").orderBy(F.col("ended_at").desc(), F.col("run_id").desc())
    return log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
