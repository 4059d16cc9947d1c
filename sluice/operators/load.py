"""Sinks and load modes: append, full reload, incremental insert.

Incremental insert is a left-anti join of the batch against the keys already
in the target, then an append. It reads the target's key column only (column
pruning reaches the scan). Re-running it after a failure inserts nothing
twice, which replaces a sleep-and-retry loop: task and stage retries are
Spark's, and a whole-job rerun is safe.

Join strategy is left to the planner: the target side grows with the
warehouse and is never force-broadcast. It is broadcast only when Spark's
size check passes (the static estimate of the pruned key column, then AQE's
measured size, against the broadcast threshold); otherwise it is a
sort-merge join, and AQE splits a batch partition made hot by many
identical rows (skew join). Bucketing the target on its key
(``Target.buckets``) removes the shuffle of the target side altogether; key
sketches beside its files (``Target.sketch``) leave out the files that hold none
of the batch's keys.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.errors import AnalysisException

from sluice.operators import keysketch, versions
from sluice.operators.keydiff import PREFIXES, hash_prefix, unequal_prefixes

WRITE_MODES = ("append", "incremental_insert")


class TargetMissingError(RuntimeError):
    """The target table or path does not exist."""


@dataclass(frozen=True)
class Target:
    """Where a table lives: a catalog table name, or a path plus a format."""

    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    buckets: int | None = None
    partition_by: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)
    schema: StructType | None = None  # for path targets: read with it (an empty partitioned folder has none)
    versioned: bool = False  # path targets: a folder a load and a version list (see ``versions``)
    version: int | None = None  # read this version of a versioned target, not the latest
    sketch: bool = False  # path targets: keep a key sketch per file, and read only files that may hold a batch's keys

    def __post_init__(self) -> None:
        if self.sketch and self.path is None:
            raise ValueError("key sketches are kept beside the files of a path target (path=)")
        if self.versioned and (self.path is None or self.sketch or self.partition_by):
            raise ValueError("a versioned target is a path without partitions or sketches")
        if (self.table is None) == (self.path is None):
            raise ValueError("Target needs exactly one of table= or path=")
        if self.buckets is not None and self.table is None:
            raise ValueError("bucketed targets must be catalog tables (table=)")

    @property
    def label(self) -> str:
        return self.table or self.path or "?"


@dataclass
class LoadResult:
    rows_in: int
    rows_written: int
    files_read: int | None = None  # of a sketched target: files whose keys the batch was compared with
    files_total: int | None = None
    replayed: bool = False  # the batch's epoch was committed before: nothing was read or written


def read_target(spark: SparkSession, target: Target) -> DataFrame:
    if target.table is not None:
        return spark.table(target.table)
    if target.versioned:
        return versions.read(spark, target.path, target.version, target.format)
    reader = spark.read.format(target.format).options(**target.options)
    if target.schema is not None:
        reader = reader.schema(target.schema)
    return reader.load(target.path)


def resolve_target(target: Target, schema: StructType) -> Target:
    """A partitioned path target reads with an explicit schema once it may be empty."""
    if target.path is not None and target.partition_by and target.schema is None:
        return replace(target, schema=schema)
    return target


def target_exists(spark: SparkSession, target: Target) -> bool:
    """Catalog lookup, or a schema read of the path.

    Only "not found" means False; any other failure is raised.
    """
    if target.table is not None:
        return spark.catalog.tableExists(target.table)
    if target.versioned:
        return versions.load_version(spark, target.path, target.version) is not None
    try:
        read_target(spark, target).schema
        return True
    except AnalysisException as exc:
        if _is_not_found(exc):
            return False
        raise


def _is_not_found(exc: AnalysisException) -> bool:
    cond = (exc.getCondition() if hasattr(exc, "getCondition") else exc.getErrorClass()) or ""
    return cond in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def create_target(spark: SparkSession, target: Target, schema: StructType, key_col: str | None = None) -> None:
    """Create an empty target with the contract's schema.

    Catalog targets may be bucketed (and sorted) by the key so later
    anti-joins on the key read the target without a shuffle.
    """
    if target.versioned:
        versions.create(spark, target.path, schema)
        return
    empty = spark.createDataFrame([], schema)
    writer = empty.write.format(target.format).options(**target.options)
    if target.partition_by:
        writer = writer.partitionBy(*target.partition_by)
    if target.table is not None:
        if target.buckets:
            if key_col is None:
                raise ValueError("a bucketed target needs key_col")
            writer = writer.bucketBy(target.buckets, key_col).sortBy(key_col)
        writer.mode("errorifexists").saveAsTable(target.table)
        return
    # a path may exist without a readable table in it (an empty folder):
    # create there, but never replace an existing table
    if target_exists(spark, resolve_target(target, schema)):
        raise ValueError(f"target {target.label} already exists")
    writer.mode("overwrite").save(target.path)


def _by_name(df: DataFrame, target_cols: list[str], drop_extra: bool = False) -> DataFrame:
    """Select the target's columns by name (any case).

    Columns the target lacks are an error (the contract grew but the target
    did not), unless ``drop_extra``; target columns the frame lacks are an
    error too.
    """
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in target_cols if c.lower() not in have]
    if missing:
        raise ValueError(f"frame lacks target columns: {missing}")
    wanted = {c.lower() for c in target_cols}
    extra = [c for c in df.columns if c.lower() not in wanted]
    if extra and not drop_extra:
        raise ValueError(f"target lacks columns {extra}: add them to the target or drop them first")
    return df.select(*[F.col("`" + have[c.lower()] + "`").alias(c) for c in target_cols])


_EMPTY_RULE = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
_rules_lock = threading.Lock()
_rules_held: dict[str, tuple[int, dict[str, str | None]]] = {}  # application -> users, settings found


@contextmanager
def load_rules(spark: SparkSession):
    """Settings that a load needs, held while any load of the session runs.

    AQE must not replace a plan whose shuffle came out empty (its observed counts
    would be lost), and filters are not inferred from constraints: for the hundred
    computed columns of a wide contract that search does not end. Parquet files are
    written with zstd unless the session names a codec: half of a conformed row is hex
    digests, which snappy leaves as long as they are. Loads of several
    threads share one setting; the last to end restores what the first found.
    """
    rules, infer = "spark.sql.adaptive.optimizer.excludedRules", "spark.sql.constraintPropagation.enabled"
    codec = "spark.sql.parquet.compression.codec"
    app = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"
    with _rules_lock:
        users, found = _rules_held.get(app, (0, {}))
        if not users:
            found = {name: spark.conf.get(name, None) for name in (rules, infer, codec)}
            spark.conf.set(rules, f"{found[rules]},{_EMPTY_RULE}" if found[rules] else _EMPTY_RULE)
            spark.conf.set(infer, "false")
            spark.conf.set(codec, found[codec] or "zstd")
        _rules_held[app] = (users + 1, found)
    try:
        yield
    finally:
        with _rules_lock:
            users, found = _rules_held[app]
            _rules_held[app] = (users - 1, found)
            if users == 1:
                del _rules_held[app]
                for name, value in found.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _write(df: DataFrame, target: Target, overwrite: bool, current: DataFrame | None = None,
           key_col: str | None = None, epoch: str | None = None) -> None:
    spark = df.sparkSession
    target_cols = (current if current is not None else read_target(spark, target)).columns
    aligned = _by_name(df, target_cols)
    if target.versioned:
        with load_rules(spark):
            versions.commit(aligned, target.path, overwrite=overwrite, epoch=epoch, fmt=target.format)
        return
    if target.table is not None:
        # positional insert into the table's own layout (buckets, partitions)
        if target.buckets and key_col is not None:
            # one writer a bucket: else every task writes a file to every bucket
            aligned = aligned.repartition(target.buckets, key_col)
        with load_rules(spark):
            aligned.write.insertInto(target.table, overwrite=overwrite)
        return
    writer = aligned.write.format(target.format).options(**target.options)
    if target.partition_by:
        writer = writer.partitionBy(*target.partition_by)
    with load_rules(spark):
        writer.mode("overwrite" if overwrite else "append").save(target.path)


def _replace(df: DataFrame, target: Target, epoch: str | None = None) -> None:
    """Overwrite the target's rows; plain files are written aside and swapped in."""
    from sluice.sources.raw import FILE_FORMATS, replace_folder

    if target.path is None or target.versioned or target.format not in FILE_FORMATS:
        _write(df, target, overwrite=True, epoch=epoch)
        return
    current = read_target(df.sparkSession, target)
    replace_folder(
        df.sparkSession, target.path,
        lambda to: _write(df, replace(target, path=to), overwrite=True, current=current),
    )


def already_loaded(spark: SparkSession, target: Target, epoch: str | None) -> bool:
    """Whether the batch of this epoch is in a versioned target, from its version list alone."""
    if epoch is None:
        return False
    if not target.versioned:
        raise ValueError(f"target {target.label} keeps no epochs: make it versioned")
    return versions.committed(spark, target.path, epoch)


def append_table(df: DataFrame, target: Target, *, require_exists: bool = True, epoch: str | None = None) -> LoadResult:
    """Append every row (columns matched by name); a batch whose ``epoch`` was committed is skipped."""
    spark = df.sparkSession
    if already_loaded(spark, target, epoch):
        return LoadResult(0, 0, replayed=True)
    target = resolve_target(target, df.schema)
    if require_exists and not target_exists(spark, target):
        raise TargetMissingError(f"target {target.label} does not exist")
    obs = Observation()
    _write(df.observe(obs, F.count(F.lit(1)).alias("n")), target, overwrite=False, epoch=epoch)
    n = int(obs.get.get("n", 0))
    return LoadResult(rows_in=n, rows_written=n)


def reload_table(df: DataFrame, target: Target, epoch: str | None = None) -> LoadResult:
    """Replace the target's rows with ``df`` in one overwrite (historical load).

    Catalog targets keep their definition (buckets, partitioning). The files of a
    path target are written aside and swapped in, so a failed load leaves the old
    rows. A path target must not be the source of ``df``: write elsewhere first. A
    versioned target gets a new version, may be its own source, and is never away.
    """
    spark = df.sparkSession
    if already_loaded(spark, target, epoch):
        return LoadResult(0, 0, replayed=True)
    target = resolve_target(target, df.schema)
    if not target_exists(spark, target):
        raise TargetMissingError(f"target {target.label} does not exist")
    if target.path is not None and not target.versioned:
        from sluice.sources.raw import reads_path

        if reads_path(df, target.path):
            raise ValueError(f"refusing to overwrite {target.label}: the frame reads from it")
    obs = Observation()
    _replace(df.observe(obs, F.count(F.lit(1)).alias("n")), target, epoch)
    n = int(obs.get.get("n", 0))
    return LoadResult(rows_in=n, rows_written=n)


def _one_per_key(batch: DataFrame, key_col: str, order_cols: tuple[str, ...]) -> DataFrame:
    if not order_cols:
        return batch.dropDuplicates([key_col])
    at = Window.partitionBy(key_col).orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return batch.withColumn("_nth", F.row_number().over(at)).where("_nth = 1").drop("_nth")


def new_rows(batch: DataFrame, existing_keys: DataFrame, key_col: str, *, dedupe: bool = False,
             order_cols: tuple[str, ...] = (), split_keys_of: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not among ``existing_keys``.

    In-batch duplicates all pass unless ``dedupe``; NULL keys always pass.
    ``order_cols`` says which of several rows of one key ``dedupe`` keeps: the
    first in that order. With ``split_keys_of`` (the batch itself, unobserved) its
    distinct keys are tested against the existing ones and the new keys joined back:
    for a target bucketed on the key, whose side of an anti-join is not shuffled,
    so that Spark could not split a hot key's partition. The distinct keys are
    combined map-side, and both sides of the join back are shuffled.
    """
    if dedupe:
        batch = _one_per_key(batch, key_col, order_cols)
    existing = existing_keys.select(F.col(key_col).alias("_key"))
    if split_keys_of is None:
        return batch.join(existing, F.col(key_col) == F.col("_key"), "left_anti")
    known = (
        split_keys_of.select(F.col(key_col).alias("_key")).where("_key is not null").distinct()
        .join(existing, "_key", "left_semi")
        .hint("rebalance")  # leave the bucket layout, so that both sides of the join back are shuffled
    )
    return batch.join(known, F.col(key_col) == F.col("_key"), "left_anti")


#: A set of at most this many keys is sent to every task; a larger one is shuffled.
LISTED_KEYS = 100_000


def packed_key(key: Column) -> Column:
    """A text key as bytes: lower-case hex (a digest) in half its length. Different keys stay different."""
    is_hex = key.rlike(r"^[0-9a-f]+\z") & (F.length(key) % 2 == 0)
    return F.when(is_hex, F.concat(F.lit(b"h"), F.unhex(key))).otherwise(F.concat(F.lit(b"t"), key.cast("binary")))


def fresh_rows(batch: DataFrame, existing: DataFrame, key_col: str) -> tuple[DataFrame | None, int]:
    """``new_rows`` of a batch that is read from files, and the batch's rows; None when no row is new.

    Keys are compared first, without their rows. Most batches are then new or known as
    a whole, or nearly so: their rows are written, or not, where they were read. Only a
    batch with more than ``LISTED_KEYS`` keys of both kinds is shuffled. Three steps,
    each for what the one before left open: checksums per prefix of the key's hash
    (a re-run moves no key), 64-bit hashes (equal keys have equal ones: no match means
    all new), packed keys. A batch of few keys is sent to the target's instead.
    """
    kinds = [df.schema[key_col].dataType for df in (batch, existing)]
    key = packed_key(F.col(key_col)) if kinds == [StringType()] * 2 else F.col(key_col)
    counted = batch.agg(F.count(F.lit(1)).alias("n"), F.count(key_col).alias("keyed")).first()
    rows, keyed = counted["n"], counted["keyed"]
    if keyed == 0:
        return (batch if rows else None), rows
    keys, held = (df.select(key.alias("_key")).where("_key is not null") for df in (batch, existing))
    if keyed <= LISTED_KEYS:
        known = held.join(F.broadcast(keys), "_key", "left_semi").distinct()
        return batch.join(F.broadcast(known), key == F.col("_key"), "left_anti"), rows
    with load_rules(batch.sparkSession):
        unequal = range(PREFIXES)
        if abs(existing.count() - keyed) <= 16 * PREFIXES:  # else hardly a prefix is equal
            unequal = [r[0] for r in unequal_prefixes(keys, held, "_key").collect()]  # PREFIXES numbers at most
        n_known = keyed
        if unequal:
            if 2 * len(unequal) < PREFIXES:
                keys, held = (df.where(hash_prefix("_key").isin(unequal)) for df in (keys, held))
            open_keys = keys.count() if 2 * len(unequal) < PREFIXES else keyed
            hashes = [df.select(F.xxhash64("_key").alias("_hash")) for df in (keys, held)]
            n_open = hashes[0].join(hashes[1], "_hash", "left_semi").count()
            if n_open:
                n_open = keys.join(held, "_key", "left_semi").count()
            n_known = keyed - open_keys + n_open
    if n_known == 0:
        return batch, rows
    if n_known == keyed:
        return (batch.where(F.col(key_col).isNull()) if rows > keyed else None), rows
    if keyed - n_known <= LISTED_KEYS:
        new = keys.join(held, "_key", "left_anti").distinct()
        found = batch.join(F.broadcast(new), key == F.col("_key"), "left")
        return found.where(F.col(key_col).isNull() | F.col("_key").isNotNull()).drop("_key"), rows
    if n_known <= LISTED_KEYS:
        known = batch.select(key.alias("_key")).join(existing.select(key.alias("_key")), "_key", "left_semi").distinct()
        return batch.join(F.broadcast(known), key == F.col("_key"), "left_anti"), rows
    return new_rows(batch, existing, key_col), rows


def incremental_insert(df: DataFrame, target: Target, key_col: str, *, dedupe: bool = False,
                       create_if_missing: bool = False, schema: StructType | None = None,
                       order_cols: tuple[str, ...] = (), partition_col: str | None = None,
                       staged: bool = False, epoch: str | None = None) -> LoadResult:
    """Append only the rows whose key the target does not hold yet.

    ``partition_col`` names a partition column of the target that is a function of
    the key's inputs, as hashed: equal keys then lie in equal partitions, and only
    the batch's partitions of the target are read. Of a sketched target only files
    that may hold one of the batch's keys are read. Where the batch is read more than
    once (sketched or bucketed targets, or one whose keys are not broadcast) it is written to the work folder first, unless
    ``staged`` says that it is read from files already; the keys of a batch in files are
    compared before its rows are moved (see ``fresh_rows``). A batch whose ``epoch`` a
    versioned target has committed is skipped without a join.
    """
    spark = df.sparkSession
    if already_loaded(spark, target, epoch):
        return LoadResult(0, 0, replayed=True)
    target = resolve_target(target, schema or df.schema)
    if not target_exists(spark, target):
        if not create_if_missing:
            raise TargetMissingError(f"target {target.label} does not exist")
        create_target(spark, target, schema or df.schema, key_col)
    stage = None
    moves = not (target.sketch or target.buckets or staged) and _keys_are_shuffled(spark, target, key_col)
    if (target.sketch or target.buckets or moves) and not staged:
        from sluice.session import work_path

        stage = work_path(spark, "stage", "batch")
        with load_rules(spark):
            df.write.parquet(stage)
        df = spark.read.schema(df.schema).parquet(stage)  # staged rows compress well: their shuffle would cost more
    try:
        return _insert_new(df, target, key_col, dedupe, order_cols, partition_col, epoch, staged or stage is not None)
    finally:
        if stage is not None:
            from sluice.sources.raw import remove_folder

            remove_folder(spark, stage)


def _keys_are_shuffled(spark: SparkSession, target: Target, key_col: str) -> bool:
    """Whether the target's keys are too many for the planner to send them to every task."""
    keys = read_target(spark, target).select(key_col)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(keys)) > limit


#: A bucketed batch key with more rows than this is split over tasks.
HOT_KEY_ROWS = 100_000
#: Batches of more partitions than this are matched to the target's by a join.
LISTED_PARTITIONS = 10_000


def _insert_new(df: DataFrame, target: Target, key_col: str, dedupe: bool, order_cols: tuple[str, ...],
                partition_col: str | None, epoch: str | None = None, staged: bool = False) -> LoadResult:
    spark = df.sparkSession
    current = read_target(spark, target)  # one listing of the target per load
    existing = current
    files = total = None
    if target.sketch:
        keysketch.update_sketches(current, target.path, key_col, target.format, target.options)
        with load_rules(spark):
            found = keysketch.candidate_files(df, key_col, current, target.path)
        files, total = len(found), len(current.inputFiles())
        existing = keysketch.read_files(current, target.path, found, target.format, target.options)
    if partition_col is not None:
        existing = _in_partitions(existing, df, partition_col)
    obs_in, obs_out = Observation(), Observation()
    rows = None
    if staged and not target.buckets and not existing.isEmpty():
        fresh, rows = fresh_rows(df, existing, key_col)
        if fresh is None and not target.versioned:
            return LoadResult(rows, 0, files, total)
        fresh = df.where(F.lit(False)) if fresh is None else _one_per_key(fresh, key_col, order_cols) if dedupe else fresh
    else:
        hot = target.buckets and not dedupe and _hottest(df, key_col) > HOT_KEY_ROWS
        batch = df.observe(obs_in, F.count(F.lit(1)).alias("n"))
        fresh = new_rows(batch, existing, key_col, dedupe=dedupe, order_cols=order_cols, split_keys_of=df if hot else None)
    _write(fresh.observe(obs_out, F.count(F.lit(1)).alias("n")), target, overwrite=False, current=current, key_col=key_col,
           epoch=epoch)
    if target.sketch:
        keysketch.update_sketches(read_target(spark, target), target.path, key_col, target.format, target.options)
    rows_in = int(obs_in.get.get("n", 0)) if rows is None else rows
    return LoadResult(rows_in, int(obs_out.get.get("n", 0)), files, total)


def _hottest(df: DataFrame, key_col: str) -> int:
    """Rows of the batch's most repeated key (counted per task first)."""
    with load_rules(df.sparkSession):
        return df.where(F.col(key_col).isNotNull()).groupBy(key_col).count().agg(F.max("count")).first()[0] or 0


def _in_partitions(existing: DataFrame, df: DataFrame, partition_col: str) -> DataFrame:
    """The target's rows in the batch's partitions: by listed values, so that other folders are not read."""
    values = df.select(F.col(partition_col).cast(existing.schema[partition_col].dataType).alias("_part")).distinct()
    with load_rules(df.sparkSession):
        listed = [r["_part"] for r in values.limit(LISTED_PARTITIONS + 1).collect()]  # one value a partition folder
    if len(listed) > LISTED_PARTITIONS:
        return existing.join(values, F.col(partition_col).eqNullSafe(F.col("_part")), "left_semi")
    match = F.col(partition_col).isin([v for v in listed if v is not None])
    return existing.where(match | F.col(partition_col).isNull() if None in listed else match)


def load(df: DataFrame, target: Target, key_col: str, mode: str, *, historical: bool = False,
         dedupe: bool = False, create_if_missing: bool = False, order_cols: tuple[str, ...] = (),
         partition_col: str | None = None, epoch: str | None = None) -> LoadResult:
    """Dispatch on the write mode."""
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}; use one of {WRITE_MODES}")
    if historical and mode != "append":
        raise ValueError("a historical load replaces the target; it cannot be incremental")
    target = resolve_target(target, df.schema)
    if create_if_missing and not target_exists(df.sparkSession, target):
        create_target(df.sparkSession, target, df.schema, key_col)
    if mode == "append":
        return reload_table(df, target, epoch) if historical else append_table(df, target, epoch=epoch)
    return incremental_insert(df, target, key_col, dedupe=dedupe, order_cols=order_cols, partition_col=partition_col,
                              epoch=epoch)
