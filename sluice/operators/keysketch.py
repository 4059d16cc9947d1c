"""A Bloom sketch of the keys of every target file, read before the anti-join.

A load asks which files may hold one of the batch's keys and reads only those: the
answer "no" is certain, so the anti-join on the files left is exact. Sketches lie in
``_key_sketch`` inside the target folder (hidden from readers of the table), one row per
file and key segment, appended after each load. Files without a sketch, as a load that
died before writing it leaves them, get theirs first; files no longer listed are ignored.

Segments deal a file's keys over tasks: a task compares one segment's batch keys with the
same segment of the files, and both sides are cut further where they are large, so no
task holds more than about ``CELL_BYTES`` of sketches or ``CELL_KEYS`` keys.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SKETCH_FOLDER = "_key_sketch"
SKETCH_SCHEMA = "file string, segment int, n long, bits binary"
SEGMENTS = 64
#: Bits a key: a file is read for nothing by about one new key in five million.
BITS_PER_KEY = 32
PROBES = 22
CELL_BYTES = 64 << 20
CELL_KEYS = 4_000_000


def sketch_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{SKETCH_FOLDER}"


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/+"


def _plain(uri: str) -> str:
    return re.sub(_SCHEME, "/", unquote(uri))


def table_files(table: DataFrame, path: str) -> dict[str, str]:
    """Relative name -> address of the table's data files, as Spark lists them."""
    from sluice.sources.raw import qualified

    root = _plain(qualified(table.sparkSession, path)).rstrip("/") + "/"
    return {_plain(uri).removeprefix(root): uri for uri in table.inputFiles()}


def _places(hashes: np.ndarray, bits: int, probe: int) -> np.ndarray:
    """The bit that probe number ``probe`` looks at, for every key hash."""
    with np.errstate(over="ignore"):  # every probe mixes anew: steps of one hash repeat in short sketches
        mixed = hashes + np.uint64((probe + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


def sketch_bits(hashes: np.ndarray) -> bytes:
    """The sketch of a set of 64-bit key hashes."""
    marks = np.zeros(max(64, -(-len(hashes) * BITS_PER_KEY // 64) * 64), np.uint8)
    hashes = hashes.astype(np.int64).view(np.uint64)
    for probe in range(PROBES):
        marks[_places(hashes, len(marks), probe)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    """Whether any of the keys may be in the sketch; False is certain."""
    data = np.frombuffer(bits, np.uint8)
    left = hashes.astype(np.int64).view(np.uint64)
    for probe in range(PROBES):
        at = _places(left, len(data) * 8, probe)
        left = left[(data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        if not len(left):
            return False
    return True


def _pack(batches):
    for batch in batches:
        sizes, bits = [], []
        for hashes in batch.column("hashes"):
            values = hashes.values.to_numpy()
            sizes.append(len(values))
            bits.append(sketch_bits(values))
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("segment"), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())],
            names=["file", "segment", "n", "bits"],
        )


def _read_sketches(spark: SparkSession, path: str) -> DataFrame | None:
    from sluice.sources.raw import _file_system

    fs, p = _file_system(spark, sketch_folder(path))
    return spark.read.schema(SKETCH_SCHEMA).parquet(sketch_folder(path)) if fs.exists(p) else None


def read_files(table: DataFrame, path: str, addresses: list[str], fmt: str, options: dict) -> DataFrame:
    """Only these files (addresses as listed) of the table, with its schema."""
    spark = table.sparkSession
    if not addresses:
        return spark.createDataFrame([], table.schema)
    return spark.read.format(fmt).options(**options).option("basePath", path).schema(table.schema).load([unquote(a) for a in addresses])


def update_sketches(table: DataFrame, path: str, key_col: str, fmt: str = "parquet", options: dict | None = None,
                    segments: int = SEGMENTS) -> int:
    """Sketch the keys of the files that have none yet; returns how many files that were."""
    spark = table.sparkSession
    files = table_files(table, path)
    known = _read_sketches(spark, path)
    done = set() if known is None else {r["file"] for r in known.where("segment < 0").select("file").collect()}
    new = {name: uri for name, uri in files.items() if name not in done}
    if not new:
        return 0
    names = spark.createDataFrame([(re.sub(_SCHEME, "/", uri), name) for name, uri in new.items()], "address string, file string")
    keys = read_files(table, path, list(new.values()), fmt, options or {}).where(F.col(key_col).isNotNull()).select(
        F.regexp_replace("_metadata.file_path", _SCHEME, "/").alias("address"),
        F.xxhash64(key_col).alias("h"),
    )
    sketches = (
        keys.groupBy("address", F.pmod("h", F.lit(segments)).cast("int").alias("segment")).agg(F.collect_list("h").alias("hashes"))
        .join(names, "address", "left")
        .select(F.coalesce("file", F.raise_error(F.concat(F.lit("file not in the listing: "), "address"))).alias("file"), "segment", "hashes")
        .mapInArrow(_pack, SKETCH_SCHEMA)
    )
    listed = names.select("file", F.lit(-1).alias("segment"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("bits"))
    sketches.unionByName(listed).write.mode("append").parquet(sketch_folder(path))
    return len(new)


def candidate_files(batch: DataFrame, key_col: str, table: DataFrame, path: str, segments: int = SEGMENTS) -> list[str]:
    """Addresses of the table's files that may hold a key of the batch (files without a sketch may)."""
    spark = table.sparkSession
    files = table_files(table, path)
    known = _read_sketches(spark, path)
    if known is None or not files:
        return sorted(files.values())
    sketched = {r["file"] for r in known.where("segment < 0").select("file").collect()}
    keys = batch.where(F.col(key_col).isNotNull()).select(F.xxhash64(key_col).alias("h")).distinct().withColumn(
        "segment", F.pmod("h", F.lit(segments)).cast("int")
    )
    sketches = known.where("segment >= 0")
    largest = sketches.groupBy("segment").agg(F.sum(F.length("bits")).alias("size")).agg(F.max("size").alias("size")).first()["size"]
    most = keys.groupBy("segment").count().agg(F.max("count").alias("n")).first()["n"]
    if not largest or not most:
        hit = set()
    else:
        file_parts, key_parts = -(-largest // CELL_BYTES), -(-most // CELL_KEYS)

        def every(n: int):
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        left = keys.withColumn("kp", F.pmod(F.shiftright("h", 20), F.lit(key_parts)).cast("int")).withColumn("fp", every(file_parts))
        right = sketches.withColumn("fp", F.pmod(F.xxhash64("file"), F.lit(file_parts)).cast("int")).withColumn("kp", every(key_parts))

        def probe(mine: pa.Table, theirs: pa.Table) -> pa.Table:
            hashes = mine.column("h").to_numpy()
            found = [f for f, bits in zip(theirs.column("file").to_pylist(), theirs.column("bits"), strict=True)
                     if len(hashes) and may_hold(bits.as_py(), hashes)]
            return pa.table({"file": pa.array(found, pa.string())})

        hits = (
            left.groupBy("segment", "kp", "fp").cogroup(right.groupBy("segment", "kp", "fp")).applyInArrow(probe, "file string")
            .distinct().collect()  # names of files, as many as a listing has at most
        )
        hit = {r["file"] for r in hits}
    return sorted(uri for name, uri in files.items() if name in hit or name not in sketched)
