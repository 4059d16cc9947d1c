"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import work_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Links that a task joins at once.
HELD_LINKS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage at a file every executor can reach, so a lost executor
    costs one stage and values such as generated ids never change.
    """
    path = work_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(work):
    """``work`` for ``mapInArrow`` and its like; at the end of a task, freed memory goes back to the system.

    Spark keeps Python workers for later stages, and allocators keep what a task has freed.
    """

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(col):
    """Lower-case A-Z only; null is the empty text."""
    return F.translate(F.coalesce(col.cast("string"), F.lit("")), UPPER, LOWER)


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup a partition sorted by ``keys`` into tables of whole key runs.

    Each table holds one or more complete runs; a run longer than a batch is
    gathered, so callers bound run lengths by the way they build their keys.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = _last_run(batch, keys)
        if held and _same_key(held[-1], batch, keys) and cut == 0:
            held.append(batch)
            continue
        if cut or held:
            if cut == 0:  # the batch is one run of a new key
                yield pa.Table.from_batches(held)
                held = [batch]
                continue
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Start offsets of equal-key runs in sorted parallel arrays, plus the end."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def _last_run(batch: pa.RecordBatch, keys: list[str]) -> int:
    cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    return int(run_starts(cols)[-2])


def _same_key(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[a.num_rows - 1].equals(b.column(k)[0]) for k in keys)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task, two columns of numbers, as links of each node to the smallest one it reaches over them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= HELD_LINKS:
            yield _star(held)
            held = []
    if held:
        yield _star(held)


def _star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    u, v = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = local_roots(len(nodes), at[: len(u)], at[len(u) :])
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(nodes[root[hung]])], names=["u", "v"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node, a whole number, of ``edges``; component is the smallest node.

    Each task first joins its own links, a bounded number at once, which leaves fewer rounds.
    Then alternating large-star and small-star rounds: each round links the larger
    neighbours (then the smaller ones) of every node to its smallest neighbour,
    by a grouped minimum and a join on the node, so a hub is combined map-side
    and its join partition can be split. Rounds are written tables.
    """
    own = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").distinct()
    e = staged(own.mapInArrow(tidy(stars), "u long, v long"), "cc")
    while True:
        # done when every node hangs on one other, which hangs on none
        roles = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        if not roles.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").head(1):
            return (
                e.select(F.col("u").alias("node"), F.col("v").alias("component"))
                .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
            )
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        down = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
        )
        e = staged(small.where("u <> v").distinct(), "cc")
