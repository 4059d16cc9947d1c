"""Replay of rejected rows: what a contract set aside is loaded once the contract takes it.

A reject keeps its source row as JSON text. Replay parses that text back to the source's
schema, conforms it under the contract as it is now, loads what passes and marks the
rejects it came from as settled; the others stay open for the next replay. Rows are loaded
before they are marked, and loaded by key, so a replay that crashes in between is repeated
without loading a row twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.functions import cells
from sluice.operators import conform as C
from sluice.operators import load as L
from sluice.plans.ingest import REJECT_KEY, IngestJob, IngestOptions
from sluice.session import work_path
from sluice.sources.raw import remove_folder

SETTLED_AT = "settled_at"
_KEYS = "_reject_keys"


@dataclass
class ReplayResult:
    opened: int  # different raw rows that were open
    loaded: int  # rows written to the target
    settled: int  # raw rows now settled
    still_open: int


def open_rejects(spark: SparkSession, rejects: L.Target, settled: L.Target) -> DataFrame:
    """(raw row, copies, reject keys) of every different raw row with a reject not settled yet.

    One raw row set aside for different reasons, by different contracts, is one row here with
    all its reject keys; ``copies`` is how often one batch held it.
    """
    kept = L.read_target(spark, rejects).select(REJECT_KEY, C.RAW_ROW_COL)
    if L.target_exists(spark, settled):
        kept = L.fresh_rows(kept, L.read_target(spark, settled), REJECT_KEY)[0]
        if kept is None:
            kept = L.read_target(spark, rejects).select(REJECT_KEY, C.RAW_ROW_COL).where(F.lit(False))

    def together(rows: DataFrame) -> DataFrame:
        return (
            rows.groupBy(C.RAW_ROW_COL, REJECT_KEY).agg(F.count(F.lit(1)).alias("n"))
            .groupBy(C.RAW_ROW_COL).agg(F.max("n").cast("int").alias("copies"), F.collect_set(REJECT_KEY).alias(_KEYS))
        )

    # a raw row whose 64-bit hash no other has is alone: only the rest are brought together
    mark = F.xxhash64(C.RAW_ROW_COL)
    shared = kept.select(mark.alias("_mark")).groupBy("_mark").count().where("count > 1").select("_mark")
    n_shared = shared.count()
    if n_shared > L.LISTED_KEYS:
        return together(kept)
    alone = kept if n_shared == 0 else kept.join(F.broadcast(shared), mark == F.col("_mark"), "left_anti")
    alone = alone.select(C.RAW_ROW_COL, F.lit(1).alias("copies"), F.array(REJECT_KEY).alias(_KEYS))
    if n_shared == 0:
        return alone
    return alone.unionByName(together(kept.join(F.broadcast(shared), mark == F.col("_mark"), "left_semi")))


def parse_raw_rows(rows: DataFrame, source_schema: StructType) -> DataFrame:
    """The raw rows as source columns; rows that are no such JSON are left out.

    The first copy of a raw row carries its reject keys, the others NULL.
    Timestamps come back to the millisecond, as they were written.
    """
    broken = "_unread"
    while broken in source_schema.fieldNames():
        broken += "_"
    asked = StructType([*source_schema.fields, StructField(broken, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken, "maxStringLen": "2147483647", "maxNestingDepth": "2147483647"}
    parsed = rows.select(
        C.RAW_ROW_COL, _KEYS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    ).select(F.when(F.col("copy") == 1, F.col(_KEYS)).alias(_KEYS), F.from_json(C.RAW_ROW_COL, asked, options).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col("r")[broken].isNull()).select(
        *[F.col("r")[f.name].alias(f.name) for f in source_schema.fields], _KEYS
    )


def replay_rejects(spark: SparkSession, job: IngestJob, opts: IngestOptions, source_schema: StructType,
                   settled: L.Target) -> ReplayResult:
    """Load the open rejects of ``job`` that its contract now takes, and settle them.

    ``source_schema`` is the schema of the frame the rejects came from. ``settled`` is a
    table of reject keys with the time they were settled (created if missing). Rows whose
    key the target already holds are settled without being written.
    """
    opts.check()
    if job.reject_target is None:
        raise ValueError(f"{job.spec.name}: no reject target to replay")
    clock = cells.as_of_col(opts.as_of)
    folder = work_path(spark, "replay", job.spec.name)
    try:
        seen = Observation()
        found = open_rejects(spark, job.reject_target, settled).observe(seen, F.count(F.lit(1)).alias("n"))
        conformed = C.conform(
            parse_raw_rows(found, source_schema), job.spec, opts.as_of, hash_algo=opts.hash_algo, key_mode=opts.key_mode,
            null_token=opts.null_token, hash_after_clamp=opts.hash_after_clamp, with_reason=True,
            corrupt_col=job.corrupt_col, reject_unparseable=opts.reject_unparseable, lenient=opts.lenient, carry=(_KEYS,),
        )
        # rows that pass are written once: they are read for the load, for the marks and for the count.
        # Observed before the filter, which would else be pushed down and parse every cell a second time
        passing = conformed.observe(Observation(), F.count(F.lit(1)).alias("n")).where(F.col(C.REASON_COL).isNull())
        with L.load_rules(spark):
            passing.drop(C.REASON_COL).write.parquet(f"{folder}/rows")
        good = spark.read.parquet(f"{folder}/rows")
        res = L.incremental_insert(
            good.drop(_KEYS), job.target, job.spec.key_col, dedupe=opts.dedupe, order_cols=opts.order_cols,
            partition_col=opts.partition_col, staged=True, create_if_missing=opts.create_if_missing, schema=job.spec.schema,
        )
        marked = good.where(F.col(_KEYS).isNotNull())
        marks = marked.select(F.explode(_KEYS).alias(REJECT_KEY)).withColumn(SETTLED_AT, clock)
        L.incremental_insert(marks, settled, REJECT_KEY, create_if_missing=True, schema=marks.schema, staged=True)
        opened = int(seen.get.get("n", 0))
        done = marked.count()
    finally:
        remove_folder(spark, folder)
    return ReplayResult(opened, res.rows_written, done, opened - done)
