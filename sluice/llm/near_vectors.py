"""Embedding near-dedup by randomised-rotation binary codes.

Each distinct vector is scaled to length 1, turned by a random rotation and
reduced to the signs of its coordinates: a binary code. Stored with it is its
correction factor f, the inner product of the vector and its code. For a code x
of vector o and any vector q, <x, q> / f is an unbiased estimate of <o, q>; if
<o, q> = c, the estimate is off by at most sqrt(1 - c^2) * sqrt(1 - f^2) / f. A
pair whose estimate is too low for c >= threshold even at that bound is settled
by the codes alone (the bound is certain, so nothing is lost); only the others
are recomputed exactly, in double precision.

Which pairs meet at all is decided by bands of code bits, taken from as many
rotations as needed: a band has log2(rows / bucket_rows) bits, and there are as
many bands as make a pair exactly at the threshold share one with probability
``recall`` (closer pairs nearly always do). A pair is counted in the first band it
shares. Buckets of more than ``block`` rows are dealt as pairs of blocks, so no
task holds more than two blocks; equal vectors are collapsed first and weighted.
Tasks emit a count and one link per row, never the pairs.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import connected_components, key_runs, local_roots, run_starts, staged, table

THRESHOLD = 0.95
RECALL = 0.999
BUCKET_ROWS = 32
BLOCK = 4096
TILE = 128


@lru_cache(maxsize=8)
def rotations(dim: int, n: int, seed: int) -> np.ndarray:
    """``n`` random rotations of ``dim`` dimensions stacked as rows."""
    rng = np.random.default_rng([seed, dim])
    return np.vstack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(n)])


def band_plan(rows: int, threshold: float, recall: float, bucket_rows: int) -> tuple[int, int]:
    """(bits a band, bands) for ``rows`` distinct vectors."""
    bits = max(1, math.ceil(math.log2(max(2, rows / bucket_rows))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, safe from overflow."""
    raw = raw.astype(np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def encode(unit: np.ndarray, bits: int, bands: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits over all rotations, and the correction factor of the first rotation's code."""
    dim = unit.shape[1]
    turn = rotations(dim, -(-bits * bands // dim), seed)
    turned = unit @ turn.T
    return turned > 0, np.abs(turned[:, :dim]).sum(axis=1) / math.sqrt(dim)


def band_keys(signs: np.ndarray, bits: int, bands: int) -> np.ndarray:
    weights = 1 << np.arange(bits, dtype=np.int64)
    return signs[:, : bits * bands].reshape(len(signs), bands, bits).astype(np.int64) @ weights


def links_in_bucket(unit, signs, factor, keys, band, block, pair_blocks, threshold, seed):
    """Index pairs (i, j) of one bucket that link and share no earlier band, by tiles."""
    n, dim = unit.shape
    turned = unit @ rotations(dim, -(-signs.shape[1] // dim), seed)[:dim].T
    code = np.where(signs[:, :dim], 1.0, -1.0) / math.sqrt(dim)
    slack = math.sqrt(1 - threshold**2) * np.sqrt(np.maximum(0, 1 - factor**2)) / factor
    floor = (threshold - slack - 1e-9) * factor
    for at in range(0, n, TILE):
        rows = slice(at, min(n, at + TILE))
        estimate = code[rows] @ turned.T
        open_ = estimate >= floor[rows, None]
        open_ &= np.arange(n) > np.arange(n)[rows, None]
        if pair_blocks:
            open_ &= block[None, :] != block[rows, None]
        i, j = np.nonzero(open_)
        if not len(i):
            continue
        if len(i) > 8 * n:
            exact = (unit[rows] @ unit.T)[i, j]
        else:
            exact = np.einsum("ij,ij->i", unit[i + at], unit[j])
        near = exact >= threshold
        i, j = i[near] + at, j[near]
        first = (keys[i] == keys[j]).argmax(axis=1) == band
        if first.any():
            yield i[first], j[first]


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    bucket_rows: int = BUCKET_ROWS,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing. Vectors of different lengths never link. Equal vectors
    link with each other; repeated rows count as vectors of their own. Null ids
    link like others but never name a component unless all its ids are null. An
    empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    groups = staged(
        rows.where(usable).groupBy("vec").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("g", F.monotonically_increasing_id()),
        "vector-groups",
    )
    bits, bands = band_plan(groups.count(), threshold, recall, bucket_rows)
    narrow = rows.schema["vec"].dataType.elementType == T.FloatType()
    kind = np.float32 if narrow else np.float64

    def code(batches):
        for batch in batches:
            sizes = np.array(batch.column("vec").value_lengths())
            flat = np.asarray(batch.column("vec").flatten().cast(pa.float32() if narrow else pa.float64()), dtype=kind)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                raw = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                signs, factor = encode(unit_rows(raw), bits, bands, seed)
                keys = band_keys(signs, bits, bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("g").take(pa.array(at)), batch.column("copies").take(pa.array(at)),
                        pa.array([int(dim)] * len(at), pa.int32()), pa.array(factor),
                        pa.array([r.tobytes() for r in raw], pa.binary()),
                        pa.array([r.tobytes() for r in np.packbits(signs, axis=1)], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    names=["g", "copies", "dim", "factor", "raw", "code", "keys"],
                )

    coded = staged(
        groups.select("g", "copies", "vec").mapInArrow(
            code, "g long, copies long, dim int, factor double, raw binary, code binary, keys array<long>"
        ),
        "vector-codes",
    )
    hot = (
        coded.select("dim", F.posexplode("keys").alias("band", "key"))
        .groupBy("dim", "band", "key").count().where(F.col("count") > block)
        .select("dim", "band", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    dealt = (
        coded.select("g", "copies", "dim", "factor", "raw", "code", F.posexplode("keys").alias("band", "key"))
        .join(hot, ["dim", "band", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "dim", "band", "key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
            "block", "g", "copies", "factor", "raw", "code",
        )
    )
    run_key = ["dim", "band", "key", "a", "b"]

    def compare(batches):
        for part in key_runs(batches, run_key):
            part = part.combine_chunks()
            cols = {c: part.column(c).to_numpy() for c in (*run_key, "block", "g", "copies", "factor")}
            raws, codes = part.column("raw"), part.column("code")
            starts = run_starts([cols[c] for c in run_key])
            out = []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2:
                    continue
                dim, n = int(cols["dim"][s]), int(e - s)
                unit = unit_rows(np.frombuffer(b"".join(raws[s:e].to_pylist()), kind).reshape(n, dim))
                packed = np.frombuffer(b"".join(codes[s:e].to_pylist()), np.uint8).reshape(n, -1)
                signs = np.unpackbits(packed, axis=1).astype(bool)
                signs = signs[:, : signs.shape[1] // dim * dim]
                keys = band_keys(signs, bits, bands)
                weight, linked, roots = cols["copies"][s:e], np.zeros(n, np.int64), np.arange(n)
                for i, j in links_in_bucket(
                    unit, signs, cols["factor"][s:e], keys, int(cols["band"][s]), cols["block"][s:e],
                    cols["a"][s] != cols["b"][s], threshold, seed,
                ):
                    np.add.at(linked, i, weight[j])
                    np.add.at(linked, j, weight[i])
                    roots = local_roots(n, np.append(i, np.arange(n)), np.append(j, roots))
                near = np.flatnonzero(linked)
                if len(near):
                    g = cols["g"][s:e]
                    out.append((g[near], linked[near], g[roots[near]]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["g", "links", "root"]
                )

    found = staged(
        dealt.repartition(*run_key).sortWithinPartitions(*run_key)
        .mapInArrow(compare, "g long, links long, root long"),
        "vector-links",
    )
    counts = found.groupBy("g").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("g").alias("a"), F.col("root").alias("b")))
    named = groups.join(parts, groups["g"] == parts["node"], "left").select(
        "g", "vec", "first_id", "copies", F.coalesce("component", "g").alias("component")
    )
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_group = named.join(names, "component").join(counts, "g", "left").select(
        "vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    linked = rows.where(usable).join(per_group, "vec").select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
