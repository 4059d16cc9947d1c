"""Incremental loads driven by Structured Streaming.

A file stream over the raw zone feeds each micro-batch through the batch
path (conform, rejects, incremental insert, run log). The stream's checkpoint
records which raw files were consumed, and the insert itself is idempotent
(left-anti join on the row key), so a batch replayed after a failure inserts
nothing twice: the effect is exactly-once without a sleep-and-retry loop.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sluice.operators.load import Target
from sluice.plans.ingest import IngestJob, IngestOptions, ingest_tables
from sluice.session import work_path
from sluice.spec import TableSpec


def batch_loader(spec: TableSpec, target: Target, *, options: IngestOptions | None = None,
                 reject_target: Target | None = None, run_log: str | None = None,
                 corrupt_col: str | None = None, stream_id: str | None = None):
    """The ``foreachBatch`` function: each micro-batch goes through the batch path.

    Rejects, residue counts and the run log are those of ``ingest_table``. A versioned
    target keeps the batches' numbers under ``stream_id`` (one id a checkpoint), so a
    batch replayed after a crash is skipped by its number, without a join.
    """
    opts = replace(options or IngestOptions(), mode="incremental_insert", create_if_missing=True)

    def load(batch: DataFrame, epoch_id: int) -> None:
        # one source per batch: staged once, so the rows and the rejects read the same files
        job = IngestJob(spec, lambda: batch, target, reject_target, corrupt_col=corrupt_col)
        own = replace(opts, epoch=f"{stream_id or spec.name}:{epoch_id}") if target.versioned else opts
        ingest_tables(batch.sparkSession, [job], own, run_log=run_log)

    return load


def start_incremental_stream(
    spark: SparkSession,
    source_path: str,
    source_schema: StructType | str,
    spec: TableSpec,
    target: Target,
    *,
    fmt: str = "parquet",
    checkpoint_location: str | None = None,
    options: IngestOptions | None = None,
    reject_target: Target | None = None,
    run_log: str | None = None,
    corrupt_col: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start streaming new raw files of ``source_path`` into ``target``.

    ``available_now`` processes what is there and stops (a scheduled batch
    job with streaming bookkeeping); otherwise ``processing_time`` sets the
    trigger interval. The checkpoint defaults to a folder per contract under
    the session's shared checkpoint folder.
    """
    reader = spark.readStream.format(fmt).schema(source_schema)
    if corrupt_col is not None:  # csv/json: a text column of the schema that keeps records of another shape
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_path)
    ckpt = checkpoint_location or work_path(spark, "streams", spec.name, unique=False)
    writer = stream.writeStream.foreachBatch(
        batch_loader(spec, target, options=options, reject_target=reject_target, run_log=run_log,
                     corrupt_col=corrupt_col, stream_id=ckpt)
    ).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
