"""N-gram Jaccard join by grouped prefixes.

Every document's shingles are put in one global order, rarest first: by the
document frequency that a fixed-size count sketch over all documents estimates,
ties by hash. (Any order common to all documents finds every pair; a good one
keeps frequent shingles out of prefixes.) Two sets of sizes x and y with
Jaccard similarity t share at least a = ceil(t (x + y) / (1 + t)) shingles, and the
first one in the order is among the first x - a + 1 of the one and y - a + 1 of
the other, so a shingle counts only where some pair has it that low.

Documents with the same prefix and size are one group, and only groups post
their prefix shingles. Under one shingle, pairs of groups are filtered by size and by
the shingle's places in both prefixes; what the pairs left hold together is a run, and
equal runs are kept once. Runs are expanded to members (in blocks, where there are many)
with signatures: counts of shingles by bins of their hash. The sum of the smaller counts is
no less than the intersection, so it rules pairs out for certain.

Members are verified on the exact sets in rounds, one pair a member: the one whose
signature comes nearest, in another component. Rounds go on until one links less than a
tenth of what the best one did.
What a signature still leaves open between components is then compared inside the
tasks on exact sets, and only links that join components leave a task, never pairs. So
every pair is verified, ruled out by a certain bound, or already joined by links, and a
large group of near copies costs a number of rows in proportion to its size.

A shingle that the sketch finds far more frequent than others is posted under
pairs of blocks of groups, so a run holds a bounded number of them.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import connected_components, free_name, key_runs, local_roots, run_starts, staged, table, tidy
from sluice.llm.shingles import mix, shingle_sets

SHINGLE = 5
PERCENT = 75
SKETCH_BITS = 21
SKETCH_PART = 1 << 14
SKETCH_LANES = 1024
RUN_BLOCK = 4096
#: Bins of a signature: a power of two, at least one for every two shingles, within these bounds.
LEAST_BINS, MOST_BINS = 16, 1 << 14
#: Bytes of texts whose sets a task makes at once.
TEXT_BYTES = 4 << 20
#: Bytes of exact sets that a task compares at once.
COMPARED = 32 << 20


def _sketch_sums(docs: DataFrame, text_col: str, size: int, bits: int) -> DataFrame:
    """(part, cells): per sketch cell, how many documents have a shingle there.

    Each task counts its documents into cells; cells are summed part by part, in
    two steps, so neither the parts nor the sum depends on the corpus size.
    """

    def count(batches):
        cells = np.zeros(1 << bits, np.int64)
        lane = TaskContext.get().partitionId() % SKETCH_LANES
        for batch in batches:
            for tokens in shingle_sets(batch.column(0), size):
                np.add.at(cells, tokens >> np.uint64(64 - bits), 1)
        parts = cells.reshape(-1, min(SKETCH_PART, 1 << bits))
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)), pa.array([lane] * len(used), pa.int32()),
                pa.array([parts[u].tobytes() for u in used], pa.binary()),
            ],
            names=["part", "lane", "cells"],
        )

    def add(key, rows):
        total = np.zeros(min(SKETCH_PART, 1 << bits), np.int64)
        for cells in rows.column("cells"):
            total += np.frombuffer(cells.as_buffer(), np.int64)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([total.tobytes()], pa.binary())})

    return (
        docs.select(F.col(text_col).cast("string")).mapInArrow(tidy(count), "part int, lane int, cells binary")
        .groupBy("part", "lane").applyInArrow(add, "part int, cells binary")
        .groupBy("part").applyInArrow(add, "part int, cells binary")
    )


def sketch_counts(docs: DataFrame, text_col: str, size: int, bits: int) -> np.ndarray:
    """Per sketch cell, how many documents have a shingle there: 2**bits numbers."""
    cells = np.zeros(1 << bits, np.int64).reshape(-1, min(SKETCH_PART, 1 << bits))
    summed = _sketch_sums(docs, text_col, size, bits).toArrow()  # in one job: a local iterator runs one for every partition
    for part, counts in zip(summed.column("part").to_pylist(), summed.column("cells"), strict=True):
        cells[part] = np.frombuffer(counts.as_buffer(), np.int64)
    return cells.ravel()


def sketch_order(docs: DataFrame, text_col: str, size: int, bits: int, run_block: int) -> tuple[np.ndarray, dict[int, int]]:
    """Per sketch cell its place in the order, a byte; and by cell the blocks of those far more frequent than others.

    The byte is the count's logarithm, in eighths of a doubling. Only it leaves the tasks, with the
    blocks of cells more than ``run_block`` over the median of their part: the driver holds no counts.
    """

    def rank(batches):
        for batch in batches:
            orders, often, blocks = [], [], []
            for part, held in zip(batch.column("part").to_pylist(), batch.column("cells"), strict=True):
                cells = np.frombuffer(held.as_buffer(), np.int64)
                orders.append(np.minimum(255, 8 * np.log2(cells + 1)).astype(np.uint8).tobytes())
                over = cells - (np.median(cells[cells > 0]) if cells.any() else 0)
                far = np.flatnonzero(over > run_block)
                often.append(far + part * len(cells))
                blocks.append(np.ceil(over[far] / run_block).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part"), pa.array(orders, pa.binary()), pa.array(often, pa.list_(pa.int64())),
                    pa.array(blocks, pa.list_(pa.int64())),
                ],
                names=["part", "order", "often", "blocks"],
            )

    order = np.zeros(1 << bits, np.uint8).reshape(-1, min(SKETCH_PART, 1 << bits))
    ranked = (
        _sketch_sums(docs, text_col, size, bits)
        .mapInArrow(tidy(rank), "part int, order binary, often array<long>, blocks array<long>").toArrow()
    )
    for part, places in zip(ranked.column("part").to_pylist(), ranked.column("order"), strict=True):
        order[part] = np.frombuffer(places.as_buffer(), np.uint8)
    often, blocks = (pc.list_flatten(ranked.column(x)).to_pylist() for x in ("often", "blocks"))
    return order.ravel(), dict(zip(often, blocks, strict=True))


def prefix_size(n: int, percent: int) -> int:
    """Prefix length of a set of n against sets of any size."""
    return n + 1 - -(-percent * n // 100)


def least_common(x, y, percent: int):
    """Fewest common shingles of two similar sets of sizes x and y."""
    return -(-percent * (x + y) // (100 + percent))


def similar_sizes(sizes: np.ndarray, percent: int, i: int) -> np.ndarray:
    """Later members of a run sorted by size that member i may be similar to."""
    return np.arange(i + 1, np.searchsorted(sizes, 100 * int(sizes[i]) // percent, side="right"))


def allowed_clusters(sizes: np.ndarray, places: np.ndarray, percent: int) -> np.ndarray:
    """A number for each group of a run: equal for groups that allowed pairs hold together.

    A pair is allowed if its sizes are similar and this can be the first shingle they
    share, given its places in both prefixes. ``sizes`` are sorted.
    """
    sizes = sizes.astype(np.int64)
    m = len(sizes)
    need = least_common(sizes[:-1], sizes[1:], percent)
    chain = (percent * sizes[1:] <= 100 * sizes[:-1]) & (places[:-1] <= sizes[:-1] - need) & (places[1:] <= sizes[1:] - need)
    if chain.all():
        return np.zeros(m, np.int64)
    a, b = [np.flatnonzero(chain)], [np.flatnonzero(chain) + 1]
    held = 0
    for i in range(m - 1):
        to = similar_sizes(sizes, percent, i)
        need = least_common(sizes[i], sizes[to], percent)
        to = to[(places[i] <= sizes[i] - need) & (places[to] <= sizes[to] - need)]
        a.append(np.full(len(to), i))
        b.append(to)
        held += len(to)
        if held > 1 << 20:  # keep one link a group
            roots = local_roots(m, np.concatenate(a), np.concatenate(b))
            a, b, held = [np.arange(m)], [roots], 0
    return local_roots(m, np.concatenate(a), np.concatenate(b))


def signature(tokens: np.ndarray) -> bytes:
    """Counts of shingles by bins of their hash; empty where a count passes a byte."""
    bins = LEAST_BINS
    while bins < len(tokens) / 2 and bins < MOST_BINS:
        bins *= 2
    counts = np.bincount((tokens >> np.uint64(8)).astype(np.int64) & (bins - 1), minlength=bins)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 1 << 8 else b""


class Signatures:
    """The signatures of one run's members, for bounds on what a member shares with others."""

    def __init__(self, sigs: list[bytes]):
        self.bins = np.array([len(x) for x in sigs])
        self.row = np.zeros(len(sigs), int)
        self.counts = {}
        for size in np.unique(self.bins):
            mine = np.flatnonzero(self.bins == size)
            self.row[mine] = np.arange(len(mine))
            self.counts[size] = np.frombuffer(b"".join(sigs[k] for k in mine), np.uint8).reshape(len(mine), size)

    def most_common(self, i: int, to: np.ndarray) -> np.ndarray:
        """No member of ``to`` shares more shingles than this with member ``i``."""
        out = np.full(len(to), np.iinfo(np.int64).max)
        own = int(self.bins[i])
        for size in np.unique(self.bins[to]) if own else ():
            if not size:
                continue
            at = np.flatnonzero(self.bins[to] == size)
            mine, theirs = self.counts[own][self.row[i]], self.counts[size][self.row[to[at]]]
            if size > own:
                theirs = theirs.reshape(len(at), size // own, own).sum(axis=1, dtype=np.uint16)
            elif own > size:
                mine = mine.reshape(own // size, size).sum(axis=0, dtype=np.uint16)
            out[at] = np.minimum(mine, theirs).sum(axis=1, dtype=np.int64)
        return out


def open_pairs(n: np.ndarray, part: np.ndarray, sigs: Signatures, percent: int):
    """(i, others, closeness) for the members of a run, sorted by size: pairs of different parts not ruled out."""
    n = n.astype(np.int64)
    for i in range(len(n) - 1):
        to = similar_sizes(n, percent, i)
        to = to[part[to] != part[i]]
        if len(to):
            need = least_common(n[i], n[to], percent)
            most = sigs.most_common(i, to)
            left = most >= need
            if left.any():
                yield i, to[left], most[left] / need[left]


def sets_linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    return len(np.intersect1d(x, y, assume_unique=True)) >= least_common(len(x), len(y), percent)


def _small(batches):
    """The batches in slices of about TEXT_BYTES of the column ``t``: sets take several times the text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at = to


def ngram_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    sketch_bits: int = SKETCH_BITS,
    run_block: int = RUN_BLOCK,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Documents link when 100 * intersection >= percent * union of their sets of
    ``size``-word shingles (a shorter text is one shingle). component_id is the
    smallest id reachable by links. Texts without words, and null texts, have
    no shingles and link with nothing. Repeated rows count as documents of equal
    sets. Null ids link like others but never name a component unless all its
    ids are null. An empty table gives no rows; other columns are ignored. Texts of any
    length are taken whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    order, blocks_of = sketch_order(rows, "t", size, sketch_bits, run_block)
    shift = np.uint64(64 - sketch_bits)
    id_type = rows.schema["id"].dataType.simpleString()

    def post(tokens: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray]:
        """What a group is posted under, with places in its prefix: its tokens, very
        frequent ones as pairs of blocks."""
        places = np.arange(len(tokens), dtype=np.int32)
        if not blocks_of:
            return tokens, places
        out, repeats = [], []
        for token, cell in zip(tokens, (tokens >> shift).tolist(), strict=True):
            n = blocks_of.get(cell, 1)
            repeats.append(n)
            if n == 1:
                out.append(np.array([token]))
                continue
            mine, other = group % n, np.arange(n, dtype=np.uint64)
            a, b = np.minimum(other, np.uint64(mine)), np.maximum(other, np.uint64(mine))
            with np.errstate(over="ignore"):
                out.append(mix(mix(token + a * np.uint64(0xD1342543DE82EF95)) + b * np.uint64(0xAF251AF3B0F025B5)))
        return np.concatenate(out), np.repeat(places, repeats)

    def prefixes(batches):
        posted: set[int] = set()  # groups this task has posted: copies are not posted again
        for batch in _small(batches):
            n_list, digests, groups, posts, places = [], [], [], [], []
            for tokens in shingle_sets(batch.column("t"), size):
                n = len(tokens)
                n_list.append(n)
                posts.append(None)
                places.append(None)
                if not n:
                    digests.append(b"")
                    groups.append(None)
                    continue
                prefix = tokens[np.argsort(order[tokens >> shift], kind="stable")][: prefix_size(n, percent)]
                digests.append(blake2b(tokens.tobytes(), digest_size=16).digest())
                group = blake2b(prefix.tobytes(), digest_size=8, salt=n.to_bytes(8, "little")).digest()
                groups.append(int.from_bytes(group, "little", signed=True))
                if groups[-1] not in posted:
                    posted.add(groups[-1])
                    under, at = post(prefix, int.from_bytes(group, "little"))
                    posts[-1], places[-1] = under.view(np.int64), at
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(n_list, pa.int32()), pa.array(digests, pa.binary()),
                    pa.array(groups, pa.int64()), pa.array(posts, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["id", "n", "digest", "grp", "post", "place"],
            )

    sets = staged(
        rows.mapInArrow(tidy(prefixes), f"id {id_type}, n int, digest binary, grp long, post array<long>, place array<int>"),
        "ngram-sets",
    )
    classes = staged(
        sets.where("n > 0").groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("grp").alias("grp"))
        .withColumn("c", F.monotonically_increasing_id()),
        "ngram-classes",
    )

    # Runs: the groups posted under one token.
    postings = sets.select("grp", "n", F.explode(F.arrays_zip("post", "place")).alias("p")).select(
        F.col("p.post").alias("token"), "grp", "n", "p.place"
    )

    def find_runs(batches):
        seen: set[bytes] = set()
        for part in key_runs(batches, ["token"]):
            token, grp, n, place = (part.column(c).to_numpy() for c in ("token", "grp", "n", "place"))
            same = np.zeros(len(token), bool)
            same[1:] = (token[1:] == token[:-1]) & (grp[1:] == grp[:-1])  # posted by several tasks
            token, grp, n, place = token[~same], grp[~same], n[~same], place[~same]
            starts = run_starts([token])
            out = []
            for k in np.flatnonzero(np.diff(starts) > 1):
                s, e = starts[k], starts[k + 1]
                if blake2b(grp[s:e].tobytes(), digest_size=16).digest() in seen:
                    continue  # all of these groups are held together already
                cluster = allowed_clusters(n[s:e], place[s:e], percent)
                for root in np.flatnonzero(np.bincount(cluster) > 1):
                    mine = s + np.flatnonzero(cluster == root)
                    key = blake2b(grp[mine].tobytes(), digest_size=16).digest()
                    if key not in seen:
                        seen.add(key)
                        out.append((key, grp[mine], n[mine]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.list_(pa.int64())),
                        pa.array([o[2] for o in out], pa.list_(pa.int32())),
                    ],
                    names=["run", "grp", "n"],
                )

    runs = staged(
        postings.repartition("token").sortWithinPartitions("token", "n", "grp")
        .mapInArrow(tidy(find_runs), "run binary, grp array<long>, n array<int>")
        .dropDuplicates(["run"]),
        "ngram-runs",
    )

    # The sets of all classes that lie in a run or share a group with another class.
    crowded = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    wanted = runs.select(F.explode("grp").alias("grp")).unionByName(crowded.select("grp")).distinct()
    needed = classes.join(wanted, "grp", "left_semi").select("c", "n", "grp", "digest", F.col("id").alias("i"))

    def exact_sets(batches):
        done: set[int] = set()  # an id may have several rows
        for batch in _small(batches):
            got = list(shingle_sets(batch.column("t"), size))
            same = []
            for k, (s, d, c) in enumerate(zip(got, *(batch.column(x).to_pylist() for x in ("digest", "c")), strict=True)):
                if c not in done and blake2b(s.tobytes(), digest_size=16).digest() == d:
                    done.add(c)
                    same.append(k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("c").take(pa.array(same, pa.int64())),
                    pa.array([signature(got[k]) for k in same], pa.binary()),
                    pa.array([got[k].tobytes() for k in same], pa.binary()),
                ],
                names=["c", "sig", "tokens"],
            )

    exact = staged(
        rows.join(needed, F.col("id").eqNullSafe(F.col("i"))).select("c", "digest", "t")
        .mapInArrow(tidy(exact_sets), "c long, sig binary, tokens binary"),
        "ngram-exact",
    )

    # The members of runs, in blocks by size; classes of one group are a run of their own.
    by_size = Window.partitionBy("run").orderBy("n", "c")
    members = staged(
        runs.select("run", F.explode("grp").alias("grp"))
        .unionByName(crowded.select(F.col("grp").cast("string").cast("binary").alias("run"), "grp"))
        .join(classes.select("grp", "n", "c"), "grp").select("run", "n", "c")
        .withColumn("block", F.floor((F.row_number().over(by_size) - 1) / run_block).cast("int"))
        .withColumn("blocks", F.max("block").over(Window.partitionBy("run"))),
        "ngram-members",
    )
    sigs = exact.select("c", "sig")

    def nearest_pairs(batches):
        """Each member with the one of another part whose signature comes nearest, if not ruled out."""
        for part in key_runs(batches, ["run", "block"]):
            cols = {x: part.column(x).to_numpy() for x in ("n", "c", "part", "block")}
            run = part.column("run").combine_chunks().dictionary_encode().indices.to_numpy()
            near, other = np.zeros(len(run)), np.full(len(run), -1, np.int64)
            starts = run_starts([run, cols["block"]])
            sig = part.column("sig").to_pylist()
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                own = Signatures(sig[s:e])
                for i, to, close in open_pairs(cols["n"][s:e], cols["part"][s:e], own, percent):
                    best = close.argmax()
                    if close[best] > near[s + i]:
                        near[s + i], other[s + i] = close[best], cols["c"][s + to[best]]
                    up = close > near[s + to]
                    near[s + to[up]], other[s + to[up]] = close[up], cols["c"][s + i]
            found = np.flatnonzero(other >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["c"][found]), pa.array(near[found]), pa.array(other[found])], names=["c", "close", "other"]
            )

    parts, tried, first = None, None, 0
    while True:
        near = (
            _unjoined(members.drop("blocks"), parts, ["run", "block"]).join(sigs, "c")
            .repartition("run", "block").sortWithinPartitions("run", "block", "n", "c")
            .mapInArrow(tidy(nearest_pairs), "c long, close double, other long")
            .groupBy("c").agg(F.max(F.struct("close", "other")).alias("m"))
            .select(F.least("c", "m.other").alias("c1"), F.greatest("c", "m.other").alias("c2")).distinct()
        )
        if tried is not None:
            near = near.join(tried, ["c1", "c2"], "left_anti")
        judged = staged(_verify(staged(near, "ngram-near"), exact, percent), "ngram-judged")
        pairs = judged.select("c1", "c2")  # by their folder: a path a file is listed by jobs of its own
        tried = pairs if tried is None else tried.unionByName(pairs)
        linked = judged.where("linked").count()
        if linked:
            parts = staged(_joined(parts, judged.where("linked")), "ngram-parts")
        first = max(first, linked)
        if linked * 10 <= first:  # a round costs more than it joins: the comparison below does the rest
            break

    # What signatures leave open between components: compared on the exact sets, whole clusters in a task.
    pairs_of = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks")), lambda x: F.struct(F.least(x, "block").alias("low"), F.greatest(x, "block").alias("high"))
    ))
    dealt = members.select("run", "n", "c", pairs_of.alias("b")).select("run", "n", "c", "b.low", "b.high")

    def open_clusters(batches):
        """Members that open pairs hold together, as many as may be compared at once."""
        seen: set[bytes] = set()
        for part in key_runs(batches, ["run", "low", "high"]):
            n, c, p, low, high = (part.column(x).to_numpy() for x in ("n", "c", "part", "low", "high"))
            run = part.column("run").combine_chunks().dictionary_encode().indices.to_numpy()
            starts = run_starts([run, low, high])
            sig, out = part.column("sig").to_pylist(), []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                a, b = [np.zeros(0, int)], [np.zeros(0, int)]
                for i, to, _ in open_pairs(n[s:e], p[s:e], Signatures(sig[s:e]), percent):
                    a.append(np.full(len(to), i))
                    b.append(to)
                    if sum(map(len, a)) > 1 << 20:
                        a, b = [np.arange(e - s)], [local_roots(e - s, np.concatenate(a), np.concatenate(b))]
                cluster = local_roots(e - s, np.concatenate(a), np.concatenate(b))
                for root in np.flatnonzero(np.bincount(cluster, minlength=1) > 1):
                    mine = s + np.flatnonzero(cluster == root)
                    piece = np.cumsum(8 * n[mine].astype(np.int64)) // COMPARED
                    for x in np.unique(piece):
                        for y in np.unique(piece[piece >= x]):
                            chosen = np.sort(c[mine[(piece == x) | (piece == y)]])
                            key = blake2b(chosen.tobytes(), digest_size=16).digest()
                            if key not in seen:
                                seen.add(key)
                                out.append((key, chosen))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.list_(pa.int64()))],
                    names=["cluster", "c"],
                )

    clusters = staged(
        _unjoined(dealt, parts, ["run", "low", "high"]).join(sigs, "c")
        .repartition("run", "low", "high").sortWithinPartitions("run", "low", "high", "n", "c")
        .mapInArrow(tidy(open_clusters), "cluster binary, c array<long>").dropDuplicates(["cluster"]),
        "ngram-clusters",
    )

    def links_inside(batches):
        """Links that join parts of a cluster."""
        for part in key_runs(batches, ["cluster"]):
            cluster = part.column("cluster").combine_chunks().dictionary_encode().indices.to_numpy()
            starts = run_starts([cluster])
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                held = part.slice(s, e - s)
                n, c, p = (held.column(x).to_numpy() for x in ("n", "c", "part"))
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in held.column("tokens")]
                own, p = Signatures(held.column("sig").to_pylist()), p.copy()
                a, b = [], []
                for i, to, close in open_pairs(n, p, own, percent):
                    for j in to[np.argsort(-close, kind="stable")].tolist():
                        if p[i] != p[j] and sets_linked(sets[i], sets[j], percent):
                            a.append(min(c[i], c[j]))
                            b.append(max(c[i], c[j]))
                            p[p == max(p[i], p[j])] = min(p[i], p[j])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["c1", "c2"])

    left = clusters.select("cluster", F.explode("c").alias("c"))
    links = staged(
        _placed(left.join(classes.select("c", "n"), "c"), parts).join(exact, "c")
        .repartition("cluster").sortWithinPartitions("cluster", "n", "c")
        .mapInArrow(tidy(links_inside), "c1 long, c2 long").distinct(),
        "ngram-links",
    )
    if links.head(1):
        parts = staged(_joined(parts, links), "ngram-parts")
    if parts is None:
        parts = spark.createDataFrame([], "node long, component long")
    named = classes.join(parts, classes["c"] == parts["node"], "left").select(
        "digest", "id", F.coalesce("component", "c").alias("component")
    )
    names = named.groupBy("component").agg(F.min("id").alias("component_id"))
    per_class = named.join(names, "component").select("digest", "component_id")
    return (
        sets.select("id", "n", "digest").join(per_class, "digest", "left")
        .select(
            F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def _joined(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after ``links`` (c1, c2) are added: only components and new nodes are linked anew."""
    if parts is None:
        return connected_components(links.select(F.col("c1").alias("a"), F.col("c2").alias("b")))
    x, y = (parts.select(F.col("node").alias(c), F.col("component").alias(p)) for c, p in (("c1", "p1"), ("c2", "p2")))
    ends = links.join(x, "c1", "left").join(y, "c2", "left").select(
        F.coalesce("p1", "c1").alias("a"), F.coalesce("p2", "c2").alias("b")
    )
    above = staged(connected_components(ends), "ngram-above").select(F.col("node").alias("component"), F.col("component").alias("top"))
    known = parts.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    new = above.join(parts.select(F.col("node").alias("component")), "component", "left_anti").select(
        F.col("component").alias("node"), F.col("top").alias("component")
    )
    return known.unionByName(new)


def _placed(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """The members with their components as ``part``; a class without links is one of its own."""
    if parts is None:
        return members.withColumn("part", F.col("c"))
    return members.join(parts.select(F.col("node").alias("c"), F.col("component").alias("part")), "c", "left").withColumn(
        "part", F.coalesce("part", "c")
    )


def _unjoined(members: DataFrame, parts: DataFrame | None, run: list[str]) -> DataFrame:
    """The members of the runs that hold more than one component; while each class is one of its own, of all.

    Runs are blocks, or pairs of them, so a window holds a bounded number of rows.
    """
    placed = _placed(members, parts)
    if parts is None:
        return placed
    whole = Window.partitionBy(*run)
    return (
        placed.withColumn("p", F.min("part").over(whole)).withColumn("q", F.max("part").over(whole))
        .where("p <> q").drop("p", "q")
    )


_JUDGED = "c1 long, c2 long, linked boolean"


def _verify(pairs: DataFrame, exact: DataFrame, percent: int) -> DataFrame:
    """(c1, c2, linked) from the exact sets."""

    def compare(batches):
        for batch in batches:
            linked = [
                sets_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("c1"), batch.column("c2"), pa.array(linked, pa.bool_())], names=["c1", "c2", "linked"]
            )

    def side(number: str, name: str) -> DataFrame:
        """The sets that this side of the pairs needs, each once."""
        return exact.join(pairs.select(F.col(number).alias("c")).distinct(), "c", "left_semi").select(
            F.col("c").alias(number), F.col("tokens").alias(name)
        )

    return pairs.join(side("c1", "x"), "c1").join(side("c2", "y"), "c2").select("c1", "c2", "x", "y").mapInArrow(tidy(compare), _JUDGED)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document left of each component, all columns kept.

    The document whose id names the component stays; rows without an id all stay, and
    so do rows repeated under an id that stays. Null and empty texts are no copies of
    each other. An empty table stays empty.
    """
    name = free_name(docs, "gone")
    gone = (
        ngram_components(docs, id_col, text_col, **how)
        .where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(name))
    )
    return docs.join(gone, docs[id_col].eqNullSafe(F.col(name)), "left_anti")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
