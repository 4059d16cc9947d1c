"""Table pipelines: sync (source -> raw) and ingest (raw -> target).

One table's ingest is: conform (one collapsed projection) -> set rows that
break the contract aside -> load by mode -> log. Per table there is one
write job for the loaded rows, plus one for rejects when a reject target is
given. Staging (the default when there are two outputs, else ``stage=True``)
first writes the conformed frame once to the shared checkpoint folder: the
source is read and cleaned once, the lineage is cut (a lost executor
re-reads staged files instead of re-running the source read), and both
writes read the staged files.
"""

from __future__ import annotations

import json
import traceback
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators import conform as C
from sluice.operators import load as L
from sluice.plans.runlog import RunRecord, append_run_log
from sluice.session import work_path
from sluice.sources.raw import remove_folder, spread, write_raw
from sluice.spec import AuditSpec, TableSpec

Source = Callable[[], DataFrame]
REJECT_KEY = "_reject_key"


@dataclass
class IngestJob:
    spec: TableSpec
    source: Source
    target: L.Target
    reject_target: L.Target | None = None
    corrupt_col: str | None = None  # column of raw records that did not fit their text format


@dataclass
class SyncJob:
    name: str
    source: Source
    raw_path: str
    raw_format: str = "parquet"
    partition_by: tuple[str, ...] = ()
    dynamic_partitions: bool = False  # replace only the partitions present in this extract
    options: dict = field(default_factory=dict)  # writer options (e.g. a table format's schema replacement)


@dataclass
class IngestOptions:
    mode: str = "incremental_insert"
    historical: bool = False
    as_of: str | datetime | Column | None = None
    hash_algo: str | None = None  # None: the key mode's own
    key_mode: str = "exact"
    null_token: str | None = None
    hash_after_clamp: bool = False
    dedupe: bool = False
    order_cols: tuple[str, ...] = ()  # which row of a key dedupe keeps, where the key does not cover the row
    reject_unparseable: bool = False
    drop_rejects: bool = False  # allow rejected rows to be counted only
    lenient: bool = False
    report_residue: bool = True
    create_if_missing: bool = False
    stage: bool | None = None  # None: stage when rows go to two outputs (loaded + rejects) or are read more than once
    rebalance: bool = False  # shuffle the raw rows into even partitions first
    epoch: str | None = None  # names the batch: a versioned target that has committed it is left alone
    vote_dates: bool = False  # read numeric dates day first in columns whose cells say so (one more pass over them)
    partition_col: str | None = None  # target partition that is a function of the key's inputs: others are not read

    def check(self) -> None:
        if self.mode not in L.WRITE_MODES:
            raise ValueError(f"unknown write mode {self.mode!r}; use one of {L.WRITE_MODES}")
        if self.historical and self.mode != "append":
            raise ValueError("a historical load replaces the target; it cannot be incremental")


def ingest_table(spark: SparkSession, job: IngestJob, opts: IngestOptions, run_id: str | None = None) -> RunRecord:
    """Conform one raw table and load it into its target."""
    opts.check()
    run_id = run_id or uuid.uuid4().hex
    started = datetime.now()
    spec = job.spec
    can_reject = opts.reject_unparseable or any(not f.nullable for f in spec.data_fields) or job.corrupt_col is not None
    if can_reject and job.reject_target is None and not opts.drop_rejects:
        raise ValueError(
            f"{spec.name} can reject rows: give a reject target, or drop_rejects=True to count them only"
        )
    if opts.dedupe and not opts.order_cols and spec.hash_cols is not None:
        raise ValueError(f"{spec.name}: rows of one key may differ; order_cols says which one dedupe keeps")
    if opts.epoch is not None and L.already_loaded(spark, job.target, opts.epoch):
        # committed before a crash could log it: known from the version list, the source is not read
        return RunRecord(run_id, spec.name, "ingest", opts.mode, 0, 0, 0, started, datetime.now(), "replayed")
    raw = job.source()
    if opts.rebalance:
        raw = spread(raw)
    conformed = C.conform(
        raw, spec, opts.as_of, hash_algo=opts.hash_algo, key_mode=opts.key_mode, null_token=opts.null_token,
        hash_after_clamp=opts.hash_after_clamp, with_reason=True, keep_raw=job.reject_target is not None,
        corrupt_col=job.corrupt_col,
        reject_unparseable=opts.reject_unparseable, lenient=opts.lenient,
        report_unparseable=opts.report_residue,
        day_first=C.day_first_columns(raw, spec) if opts.vote_dates else (),
    )
    C.assert_schema(conformed, spec.schema)
    read_again = opts.mode == "incremental_insert" and (job.target.buckets or job.target.sketch or opts.partition_col)
    stage = opts.stage if opts.stage is not None else bool(job.reject_target is not None or read_again)
    staged, keyless = None, False
    if stage:
        staged = work_path(spark, "stage", spec.name)
        # half of a staged row would be its digest: written without it where it can be had from the values
        keyless = C.key_follows_values(spec, opts.hash_algo, opts.key_mode, opts.hash_after_clamp)
        with L.load_rules(spark):
            (conformed.drop(spec.key_col) if keyless else conformed).write.mode("overwrite").parquet(staged)
        conformed = spark.read.parquet(staged)
    # counts for the run log ride on the load's own job (no extra pass)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(C.REASON_COL).isNotNull()).alias("r")]
    reported = C.UNPARSEABLE_COL in conformed.columns
    typed = [f.name for f in spec.data_fields if reported and C.typed_target(f, spec)]
    if typed:
        lost = F.split(F.col(C.UNPARSEABLE_COL), ",")
        metrics += [F.count_if(F.array_contains(lost, name)).alias(f"u{i}") for i, name in enumerate(typed)]
    observed = conformed.observe(seen, *metrics)
    good, _ = C.split_rejects(observed)
    _, rejects = C.split_rejects(conformed)
    if keyless:
        good, rejects = (C.with_key(x, spec, opts.hash_algo, opts.key_mode, opts.null_token) for x in (good, rejects))

    # rejects go first: once the batch's epoch is committed, a replay does not come back for them
    if job.reject_target is not None:
        # keyed by the raw row and its reasons, so a re-run sets nothing aside twice
        rejects = rejects.withColumn(
            REJECT_KEY, F.sha2(F.concat_ws("\n", F.col(C.RAW_ROW_COL), F.col(C.REASON_COL)), 256)
        )
        L.incremental_insert(rejects, job.reject_target, REJECT_KEY, create_if_missing=True, schema=rejects.schema, staged=stage)
    target = L.resolve_target(job.target, spec.schema)
    if not L.target_exists(spark, target):
        if not opts.create_if_missing:
            raise L.TargetMissingError(f"target {target.label} for {spec.name} does not exist")
        L.create_target(spark, target, spec.schema, spec.key_col)
    if opts.mode == "append":
        write = L.reload_table if opts.historical else L.append_table
        res = write(good, target, epoch=opts.epoch)
    else:
        res = L.incremental_insert(good, target, spec.key_col, dedupe=opts.dedupe, order_cols=opts.order_cols,
                                   partition_col=opts.partition_col, staged=stage, epoch=opts.epoch)

    counts = seen.get
    if staged is not None:
        remove_folder(spark, staged)
    residue = {name: int(counts.get(f"u{i}", 0)) for i, name in enumerate(typed)}
    residue = {k: v for k, v in residue.items() if v}
    return RunRecord(run_id, spec.name, "ingest", opts.mode, int(counts.get("n", 0)),
                     res.rows_written, int(counts.get("r", 0)), started, datetime.now(), "ok",
                     residue=json.dumps(residue, sort_keys=True) if reported else None)


def ingest_tables(spark: SparkSession, jobs: list[IngestJob], opts: IngestOptions, *,
                  on_error: str = "stop", enabled: dict[str, bool] | None = None,
                  run_log: str | None = None, max_parallel: int = 1) -> list[RunRecord]:
    """Ingest several tables; ``on_error`` is ``stop`` (raise) or ``continue``.

    With ``max_parallel > 1`` tables are submitted from several driver
    threads so small tables share the cluster instead of queueing.
    """
    if on_error not in ("stop", "continue"):
        raise ValueError("on_error must be 'stop' or 'continue'")
    opts.check()
    run_id = uuid.uuid4().hex

    def one(job: IngestJob) -> RunRecord:
        if enabled is not None and not enabled.get(job.spec.name, False):
            now = datetime.now()
            return RunRecord(run_id, job.spec.name, "ingest", opts.mode, None, None, None, now, now, "skipped")
        started = datetime.now()
        try:
            return ingest_table(spark, job, opts, run_id)
        except Exception as exc:
            record = RunRecord(run_id, job.spec.name, "ingest", opts.mode, None, None, None, started,
                               datetime.now(), "failed", f"{exc}\n{traceback.format_exc()}")
            if on_error == "stop":
                raise TableFailed(record) from exc
            return record

    records = _run_all(one, jobs, max_parallel, run_log, spark)
    return records


def sync_tables(spark: SparkSession, jobs: list[SyncJob], *, audit: AuditSpec,
                as_of: str | datetime | Column | None = None, run_log: str | None = None,
                max_parallel: int = 1) -> list[RunRecord]:
    """Copy each source to its raw path with audit columns (overwrite).

    A failing table is logged as failed and the others continue.
    """
    run_id = uuid.uuid4().hex

    def one(job: SyncJob) -> RunRecord:
        started = datetime.now()
        try:
            obs = Observation()
            stamped = C.with_audit(job.source(), audit, as_of).observe(obs, F.count(F.lit(1)).alias("n"))
            write_raw(stamped, job.raw_path, job.raw_format, partition_by=job.partition_by,
                      dynamic_partitions=job.dynamic_partitions, options=job.options)
            n = int(obs.get.get("n", 0))
            return RunRecord(run_id, job.name, "sync", "overwrite", n, n, None, started, datetime.now(), "ok")
        except Exception as exc:
            return RunRecord(run_id, job.name, "sync", "overwrite", None, None, None, started,
                             datetime.now(), "failed", f"{exc}\n{traceback.format_exc()}")

    return _run_all(one, jobs, max_parallel, run_log, spark)


class TableFailed(Exception):
    """Carries the run record of a table that stops the batch."""

    def __init__(self, record: RunRecord):
        super().__init__(record.table)
        self.record = record


def _run_all(fn, jobs, max_parallel, run_log, spark) -> list[RunRecord]:
    """Run the jobs and log every record, the one of a table that stops the batch included."""
    records: list[RunRecord] = []
    failed: TableFailed | None = None
    try:
        if max_parallel > 1:
            with ThreadPoolExecutor(max_workers=max_parallel) as pool:
                for future in [pool.submit(fn, job) for job in jobs]:
                    try:
                        records.append(future.result())
                    except TableFailed as stop:
                        records.append(stop.record)
                        failed = failed or stop
        else:
            for job in jobs:
                records.append(fn(job))
    except TableFailed as stop:
        records.append(stop.record)
        failed = stop
    finally:
        if run_log is not None:
            append_run_log(spark, run_log, records)
    if failed is not None:
        raise failed.__cause__
    return records
