"""Session helpers: a tuned local/cluster session and the shared work folder.

Nothing here changes a session the caller already configured, except where a
setting is unset (the checkpoint folder in tests, for instance).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from runtime sizes (so a
# small target side becomes a broadcast only after its size is measured) and
# splits skewed anti-join partitions.
# Generated methods above HotSpot's 8000-byte JIT limit are never compiled;
# capping codegen there makes Spark split wide cleaning projections into
# methods the JIT does compile (measured: 5.3 s -> 3.1 s on a 10-column clean).
# Batches to and from Python workers are bounded by bytes: rows of one table may be
# thousands of times longer than another's, and a task holds several batches at once.
ENGINE_CONF = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "sluice",
    time_zone: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    if time_zone:
        conf["spark.sql.session.timeZone"] = time_zone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the engine needs on an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def compact_files(spark: SparkSession) -> None:
    """Parquet files of this session are written with zstd from now on, unless it names a codec.

    For queries whose rows are far larger than what they read: the frame is written by the
    caller, later, and the hex digests of a conformed row stay as long as they are in snappy.
    """
    codec = "spark.sql.parquet.compression.codec"
    if spark.conf.get(codec, None) is None:
        spark.conf.set(codec, "zstd")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a distributed file system path every
    executor can reach); unset there is an error. Only in local mode (tests)
    an unset folder is made here and registered on the context.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder every executor can reach "
                "(staged tables, stream checkpoints and work tables are written there)"
            )
        local = tempfile.mkdtemp(prefix="sluice-ckpt-")
        sc.setCheckpointDir(local)
        current = sc.getCheckpointDir() or local
    return current


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder for staged or written tables."""
    root = checkpoint_root(spark).rstrip("/")
    segs = ["sluice-work", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join([root, *segs]) if "://" in root else os.path.join(root, *segs)
