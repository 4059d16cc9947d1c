"""Raw lake zone: read a landed table, overwrite it on each sync."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from sluice.sources.jdbc import bare_name, parse_table_name

TEXT_FORMATS = ("csv", "json", "text")
#: Formats whose table is nothing but the files in its folder.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")


def raw_path(base: str, stage: str, db: str, table: str) -> str:
    """``<base>/<stage>/<db>/<table>``; quotes and a schema prefix are dropped."""
    name = bare_name(parse_table_name(table)[1])
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate([base, stage, db, name]))


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", *, schema=None,
             multi_line: bool = False, corrupt_col: str | None = None,
             options: dict | None = None) -> DataFrame:
    """Read a raw table.

    Columnar formats carry their schema. For csv/json, ``multi_line`` and a
    PERMISSIVE parse keep records that span lines; ``corrupt_col`` keeps
    rows that do not parse instead of dropping them.
    """
    reader = spark.read.format(fmt)
    if fmt in TEXT_FORMATS:
        reader = reader.option("mode", "PERMISSIVE")
        if fmt == "csv":
            reader = reader.option("header", "true")
        if multi_line:
            reader = reader.option("multiLine", "true")
        if corrupt_col:
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
            # Spark fills the column only where the schema names it
            if schema is None:
                plain = reader.options(**options) if options else reader
                schema = plain.option("enforceSchema", "false").load(path).schema
            schema = with_corrupt_col(schema, corrupt_col)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path)


def with_corrupt_col(schema, corrupt_col: str) -> StructType:
    """The schema with a text column for records that do not fit it."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if corrupt_col in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(corrupt_col, StringType())])


def write_raw(df: DataFrame, path: str, fmt: str = "parquet", *, partition_by: tuple[str, ...] = (),
              dynamic_partitions: bool = False, options: dict | None = None) -> None:
    """Overwrite the raw table; the new schema replaces the old one.

    With ``partition_by`` and ``dynamic_partitions`` only the partitions
    present in ``df`` are replaced (a daily extract rewrites its own day).
    Overwriting a path that ``df`` itself reads is refused: write to another
    path first. Plain files are written aside and swapped in when complete, so a
    job that fails leaves the old table as it was.
    """
    if reads_path(df, path):
        raise ValueError(f"refusing to overwrite {path}: the frame reads from it")
    dynamic = bool(partition_by) and dynamic_partitions

    def write(to: str) -> None:
        writer = df.write.format(fmt).mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.options(**(options or {})).save(to)

    if dynamic or fmt not in FILE_FORMATS:
        write(path)
    else:
        replace_folder(df.sparkSession, path, write)


def reads_path(df: DataFrame, path: str) -> bool:
    """Whether the frame scans files under ``path``, or a folder that holds it.

    The root paths of the frame's file relations are compared, both sides
    qualified by their file system; no file is listed.
    """
    spark = df.sparkSession
    own = qualified(spark, path)
    return any(_within(own, root) or _within(root, own) for root in source_roots(df))


def _within(path: str, folder: str) -> bool:
    return path == folder or path.startswith(folder.rstrip("/") + "/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, as its file system writes it."""
    fs, p = _file_system(spark, path)
    return fs.makeQualified(p).toString()


def source_roots(df: DataFrame) -> set[str]:
    """Qualified root paths of the file relations that the frame reads."""
    roots = set()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            continue
        paths = relation.location().rootPaths()
        roots |= {qualified(df.sparkSession, paths.apply(k).toString()) for k in range(paths.size())}
    return roots


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours through its file system; a missing one is fine."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def replace_folder(spark: SparkSession, path: str, write) -> None:
    """``write`` a folder beside ``path``, then put it in its place.

    Readers see the old folder until two renames swap it for the new one. When
    the write or the swap fails, the old folder stays or is put back.
    """
    mark = uuid.uuid4().hex[:12]
    new, old = (f"{path.rstrip('/')}.{kind}-{mark}" for kind in ("new", "old"))
    try:
        write(new)
    except BaseException:
        remove_folder(spark, new)
        raise
    fs, target = _file_system(spark, path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    had_old = fs.exists(target)
    if not had_old:
        parent = target.getParent()
        if parent is not None:
            fs.mkdirs(parent)
    if had_old and not fs.rename(target, hadoop_path(old)):
        remove_folder(spark, new)
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(hadoop_path(new), target):
        if had_old:
            fs.rename(hadoop_path(old), target)
        remove_folder(spark, new)
        raise OSError(f"cannot put the new folder at {path}")
    if had_old:
        remove_folder(spark, old)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a frame that arrives in few partitions (one JDBC task, a few big files).

    A ``rebalance`` hint: AQE sizes the partitions by bytes, coalescing a small
    source and splitting a large one. It shuffles the frame, so it is asked for,
    never chosen from a partition count.
    """
    return df.hint("rebalance")


def spread_by(df: DataFrame, *key_cols: str) -> DataFrame:
    """Rows dealt by hash over ``spark.sql.shuffle.partitions`` tasks, whatever their bytes.

    For work whose cost is per row: a few megabytes of one row group are one task, and
    partitions sized by bytes (``spread``) stay one. The columns used after it are
    shuffled, no others. ``key_cols`` should tell rows apart: equal ones share a task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key_cols)


def spread_in_order(df: DataFrame, *key_cols: str) -> DataFrame:
    """Like ``spread_by``, but by ranges of the keys, and in their order within a task.

    Neighbours stay together, so what is written of them compresses better than dealt by
    hash. Costs a second read of the keys, for a sample that the ranges are taken from.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *key_cols).sortWithinPartitions(*key_cols)
