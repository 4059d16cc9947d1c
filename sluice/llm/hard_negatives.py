"""Hard-negative mining over a GNAT-style multiway hyperplane tree.

Vectors are whole numbers, floor(256 x) a component, and scores their inner products.
The tree is chosen on a bounded sample: a node takes a few split points far from each
other, and a row belongs to the subtree of the nearest one (so hyperplanes halfway
between split points part the subtrees). Every row is then indexed: it goes down to its
leaf, and each split point keeps the range of its distances to the rows of every sibling
subtree, its own too, with the range of the rows' lengths. Both are grouped minima
and maxima over all rows, as many as the tree has nodes.

A search looks for rows whose score with an anchor lies in a window. With the anchor's
length and a subtree's range of lengths, a window of scores is an annulus of distances
around the anchor; a subtree is left out when, for some split point, the annulus moved by
the anchor's distance to that point does not meet the range that the point has stored.
Leaves that remain are compared exactly, all rows of a leaf with all anchors that reach
it, in bounded blocks: leaves with many rows or many anchors are dealt over several tasks.

Positives first: the anchor's own leaf gives a first bound for its last positive, then
all leaves that may hold a better one. Then the negatives: all leaves that meet the
union of the anchor's windows. Nothing is approximated: the ranges only leave out
leaves that cannot hold a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import run_starts, staged, table

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH, WHOLE = 80, 100, 100
ANCHORS = 100
SCALE = 256
SAMPLE = 4096  # rows that the split points are chosen from
FANOUT = 8
LEAF_SAMPLE = 48
LEAF_ROWS = 8192  # rows of a leaf in one task
LEAF_ANCHORS = 4096  # anchors at a leaf in one task
TILE = 512


# ---------------------------------------------------------------------------
# The tree: nodes in order, children always after their parent
# ---------------------------------------------------------------------------


def far_points(rows: np.ndarray, k: int) -> np.ndarray:
    """Indices of up to ``k`` different rows, each farthest from those before it."""
    chosen = [0]
    gap = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < k and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


class Tree:
    """``points[node]``: split points as rows (none: a leaf); ``children[node]``: a node for each."""

    def __init__(self, sample: np.ndarray, fanout: int, leaf_sample: int):
        self.points: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        todo = [sample.astype(np.float64)]
        while len(self.points) < len(todo):
            rows = todo[len(self.points)]
            picked = far_points(rows, fanout) if len(rows) > leaf_sample else np.zeros(1, int)
            if len(picked) < 2:
                self.points.append(None)
                self.children.append([])
                continue
            points = rows[picked]
            side = nearest(rows, points)
            self.children.append(list(range(len(todo), len(todo) + len(points))))
            self.points.append(points)
            todo += [rows[side == j] for j in range(len(points))]

    def leaves(self) -> list[int]:
        return [n for n, p in enumerate(self.points) if p is None]


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows (n) to points (k), as (n, k)."""
    squares = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0))


def nearest(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return distances(rows, points).argmin(axis=1)


def descend(tree: Tree, rows: np.ndarray):
    """The leaf of every row, and (node, split, child, low, high) of the distances seen on the way."""
    at = np.zeros(len(rows), int)
    ranges = []
    for node, points in enumerate(tree.points):
        if points is None:
            continue
        here = np.flatnonzero(at == node)
        if not len(here):
            continue
        d = distances(rows[here], points)
        side = d.argmin(axis=1)
        at[here] = np.array(tree.children[node])[side]
        for j in np.unique(side):
            mine = d[side == j]
            ranges += [(node, i, int(j), lo, hi) for i, (lo, hi) in enumerate(zip(mine.min(axis=0), mine.max(axis=0), strict=True))]
    return at, ranges


class Ranges:
    """What the split points have stored of all rows: per node arrays of split by child; per child its rows' lengths."""

    def __init__(self, tree: Tree, distance_rows, length_rows):
        self.low, self.high = {}, {}
        for node, points in enumerate(tree.points):
            if points is not None:
                self.low[node] = np.full((len(points), len(points)), np.inf)
                self.high[node] = np.full((len(points), len(points)), -np.inf)
        for node, i, j, lo, hi in distance_rows:
            self.low[node][i, j], self.high[node][i, j] = lo, hi
        self.lengths = np.array([[np.inf, -np.inf]] * len(tree.points))
        for leaf, lo, hi in length_rows:
            self.lengths[leaf] = lo, hi
        for node in range(len(tree.points) - 1, -1, -1):
            if tree.children[node]:
                below = self.lengths[tree.children[node]]
                self.lengths[node] = below[:, 0].min(), below[:, 1].max()


def reachable(tree: Tree, ranges: Ranges, rows: np.ndarray, least: np.ndarray, most: np.ndarray):
    """(leaf, indices of rows): leaves that may hold a row whose score lies in [least, most]."""
    size = np.sqrt((rows**2).sum(axis=1))
    todo = [(0, np.arange(len(rows)))]
    for node, here in todo:
        if not len(here):
            continue
        if tree.points[node] is None:
            yield node, here
            continue
        away = distances(rows[here], tree.points[node])
        for j, child in enumerate(tree.children[node]):
            lo, hi = ranges.lengths[child]
            if lo > hi:
                continue  # no row there
            slack = 1e-6 * (1 + size[here] + hi)
            near = np.sqrt(np.maximum(size[here] ** 2 + lo**2 - 2 * most[here], 0)) - slack
            with np.errstate(invalid="ignore"):
                far = np.sqrt(np.maximum(size[here] ** 2 + hi**2 - 2 * least[here], 0)) + slack
            stored_low, stored_high = ranges.low[node][:, j], ranges.high[node][:, j]
            meets = ((away + far[:, None] >= stored_low) & (away - far[:, None] <= stored_high)).all(axis=1)
            meets &= (near[:, None] <= away + stored_high).all(axis=1)
            meets &= size[here] + hi >= near
            todo.append((child, here[meets]))


# ---------------------------------------------------------------------------
# Vectors on the way through Spark: whole numbers as packed bytes
# ---------------------------------------------------------------------------


def packed(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as double."""
    return F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of packed doubles; vectors shorter than ``dim`` end in zeros."""
    values = [np.frombuffer(v.as_buffer(), np.float64) for v in column]
    out = np.zeros((len(values), dim))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in double precision while they stay whole, else in 64-bit integers."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _pack(batches):
    for batch in batches:
        vecs = [np.asarray(v, np.float64).tobytes() for v in batch.column("vec").to_pylist()]
        i = batch.schema.get_field_index("vec")
        yield pa.RecordBatch.from_arrays(
            [pa.array(vecs, pa.binary()) if k == i else c for k, c in enumerate(batch.columns)], names=batch.schema.names
        )


def _best(scores: np.ndarray, allowed: np.ndarray, order: np.ndarray, k: int):
    """Up to ``k`` allowed columns of each row, highest score first, then as ``order`` ranks them: (row, column)."""
    masked = np.where(allowed, scores, np.iinfo(np.int64).min)
    if masked.shape[1] > k:
        last = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        allowed = allowed & (masked >= last[:, None])  # with all ties of the last
    r, c = np.nonzero(allowed)
    by = np.lexsort((order[c], -scores[r, c], r))
    r, c = r[by], c[by]
    starts = run_starts([r])
    nth = np.arange(len(r)) - np.repeat(starts[:-1], np.diff(starts)) if len(r) else np.zeros(0, int)
    return r[nth < k], c[nth < k]


_ANCHOR = "aid long, vec_id long, label long, vec binary, least long, most long"


def _dealt(visits: DataFrame, members: DataFrame, leaf_sizes: dict[int, int], leaf_rows: int, leaf_anchors: int):
    """Both sides with the block (leaf, rows part, anchors part) that compares them."""
    reached = {r["leaf"]: r["count"] for r in visits.groupBy("leaf").count().collect()}  # a number a leaf
    rows_of = {leaf: -(-n // leaf_rows) for leaf, n in leaf_sizes.items()}
    anchors_of = {leaf: -(-n // leaf_anchors) for leaf, n in reached.items()}

    def parts(of: dict[int, int]) -> Column:
        """How many parts the row's leaf has, from one number a node."""
        numbers = " ".join(str(of.get(node, 1)) for node in range(max([*rows_of, *anchors_of, 0]) + 1))
        return F.get(F.split(F.lit(numbers), " ").cast("array<int>"), F.col("leaf"))

    mine = lambda df, key, of: F.pmod(F.xxhash64(key), parts(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), parts(of) - 1))
    a = visits.withColumn("ap", mine(visits, "aid", anchors_of)).withColumn("rp", every(rows_of))
    m = (
        members.where(F.col("leaf").isin(list(reached))).withColumn("rp", mine(members, "uid", rows_of))
        .withColumn("ap", every(anchors_of))
    )
    # anchors are rows of the same table: columns of their own keep the two sides apart
    return a, m.select(*[F.col(c).alias(c) for c in ("vec_id", "label", "vec", "leaf", "rp", "ap")])


def _compare(visits, members, leaf_sizes, dim, leaf_rows, leaf_anchors, judge, schema) -> DataFrame:
    a, m = _dealt(visits, members, leaf_sizes, leaf_rows, leaf_anchors)

    def block(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            right = matrix(rows.column("vec"), dim)
            ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
            order = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
            for at in range(0, anchors.num_rows, TILE):
                tile = anchors.slice(at, TILE)
                scores = products(matrix(tile.column("vec"), dim), right)
                out.append(judge(tile, scores, ids, labels, order))
        names = [f.strip().split()[0] for f in schema.split(",")]
        columns = zip(*out, strict=True) if out else [[np.zeros(0, np.int64)]] * len(names)
        return pa.table({n: pa.array(np.concatenate(c).astype(np.int64)) for n, c in zip(names, columns, strict=True)})

    return (
        a.groupBy("leaf", "rp", "ap").cogroup(m.groupBy("leaf", "rp", "ap"))
        .applyInArrow(block, schema)
    )


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    anchors_every: int = ANCHORS,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    sample: int = SAMPLE,
    fanout: int = FANOUT,
    leaf_sample: int = LEAF_SAMPLE,
    leaf_rows: int = LEAF_ROWS,
    leaf_anchors: int = LEAF_ANCHORS,
    work: dict | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchors_every``; positives the first
    ``positives`` other rows of the anchor's label; for each, the first ``negatives`` rows
    of other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score. Higher scores come first, ties by smaller id. Rows without id, label
    or vector, or with a null or non-finite component, take no part; a shorter vector
    counts as ending in zeros, an empty one scores 0 with all. Rows of one id are rows of
    their own but not positives of each other; an anchor with no positives, or a positive with no
    negatives, gives no rows; an empty table gives none; other columns are ignored.
    Scores are exact within 64 bits. ``work``, if given, is told the visits and leaves.
    """
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(finite, F.lit(False))
    rows = vectors.where(known).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), packed(vec).alias("vec")
    )
    spark = vectors.sparkSession
    out_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    picked = rows.select("vec").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not picked:
        return spark.createDataFrame([], out_schema)
    dim = max(1, rows.agg(F.max(F.size("vec"))).first()[0])
    chosen = np.zeros((len(picked), dim))
    for i, r in enumerate(picked):
        chosen[i, : len(r["vec"])] = r["vec"]
    tree = Tree(chosen, fanout, leaf_sample)

    # Every row to its leaf.
    def place(batches):
        for batch in batches:
            leaf, _ = descend(tree, matrix(batch.column("vec"), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    flat = rows.mapInArrow(_pack, "vec_id long, label long, vec binary")
    members = staged(
        flat.mapInArrow(place, "vec_id long, label long, vec binary, leaf int").withColumn("uid", F.monotonically_increasing_id()),
        "negatives-members",
    )

    def seen(batches):
        found: dict[tuple, list[float]] = {}
        for batch in batches:
            at = matrix(batch.column("vec"), dim)
            leaf, ranges = descend(tree, at)
            size = np.sqrt((at**2).sum(axis=1))
            keyed = [((n, i, j), lo, hi, 0) for n, i, j, lo, hi in ranges]
            keyed += [((int(x), -1, -1), size[leaf == x].min(), size[leaf == x].max(), int((leaf == x).sum())) for x in np.unique(leaf)]
            for key, lo, hi, n in keyed:
                held = found.setdefault(key, [lo, hi, 0])
                held[:] = min(held[0], lo), max(held[1], hi), held[2] + n
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[c] for k in keys], pa.int32()) for c in range(3)]
            + [pa.array([float(found[k][c]) for k in keys], pa.float64()) for c in range(2)]
            + [pa.array([found[k][2] for k in keys], pa.int64())],
            names=["node", "split", "child", "lo", "hi", "n"],
        )

    stored = (  # as many rows as the tree has split points and leaves
        members.select("vec").mapInArrow(seen, "node int, split int, child int, lo double, hi double, n long")
        .groupBy("node", "split", "child").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).collect()
    )
    ranges = Ranges(
        tree, [tuple(r)[:5] for r in stored if r["split"] >= 0], [(r["node"], r["lo"], r["hi"]) for r in stored if r["split"] < 0]
    )
    leaf_sizes = {r["node"]: r["n"] for r in stored if r["split"] < 0}
    limit = np.iinfo(np.int64).max

    def visits(anchors: DataFrame, name: str) -> DataFrame:
        """Each anchor once for every leaf that may hold a score from ``least`` to ``most``."""

        def reach(batches):
            for batch in batches:
                at = matrix(batch.column("vec"), dim)
                least, most = (batch.column(c).to_numpy().astype(np.float64) for c in ("least", "most"))
                least = np.where(least <= -(2.0**62), -np.inf, least)
                for leaf, here in reachable(tree, ranges, at, least, most):
                    part = batch.take(pa.array(here))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(np.full(len(here), leaf), pa.int32())], names=[*batch.schema.names, "leaf"]
                    )

        out = staged(anchors.mapInArrow(reach, _schema(anchors) + ", leaf int"), f"negatives-{name}")
        if work is not None:
            work[name] = (out.count(), anchors.count() * len(leaf_sizes))
        return out

    def compare(at, judge, schema):
        return _compare(at, members, leaf_sizes, dim, leaf_rows, leaf_anchors, judge, schema)

    # Positives: a bound from the anchor's own leaf, then every leaf that may hold a better one.
    def same_label(tile, scores, ids, labels, order):
        aid, me, label = (tile.column(c).to_numpy() for c in ("aid", "vec_id", "label"))
        allowed = (labels == label[:, None]) & (ids != me[:, None]) & (scores >= tile.column("least").to_numpy()[:, None])
        r, c = _best(scores, allowed, order, positives)
        return aid[r], ids[c], scores[r, c]

    start = members.where(F.col("vec_id") % anchors_every == 0).select(
        F.col("uid").alias("aid"), "vec_id", "label", "vec",
        F.lit(-limit).cast("long").alias("least"), F.lit(limit).cast("long").alias("most"), "leaf",
    )
    own = compare(start, same_label, "aid long, id long, score long")
    bound = own.groupBy("aid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    bounded = start.drop("leaf", "least").join(bound, "aid", "left").select(
        "aid", "vec_id", "label", "vec", F.when(F.col("n") >= positives, F.col("last")).otherwise(F.lit(-limit)).alias("least"), "most"
    )
    all_positives = compare(visits(bounded, "positives"), same_label, "aid long, id long, score long")
    first = Window.partitionBy("aid").orderBy(F.desc("score"), "id")
    pos = staged(
        all_positives.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives), "negatives-chosen"
    )

    # Negatives: the union of an anchor's windows, each judged for itself.
    def window(score: Column, percent: int, wider: int) -> Column:
        """A bound of the window, a little wider than it: the leaves judge it exactly."""
        bound = score.cast("double") * percent / WHOLE
        return F.floor(bound + wider * (2 + F.abs(bound) * 1e-12)).cast("double").try_cast("long")

    wide = pos.where("score >= 0").groupBy("aid").agg(
        F.min("score").alias("lowest"), F.max("score").alias("highest"), F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("p")
    )
    seekers = start.drop("leaf", "least", "most").join(wide, "aid").select(
        "aid", "vec_id", "label", "vec", window(F.col("lowest"), low, -1).alias("least"),
        F.coalesce(window(F.col("highest"), high, 1), F.lit(limit)).alias("most"), F.col("p.nth").alias("nth"), F.col("p.score").alias("at"),
    )

    def in_windows(tile, scores, ids, labels, order):
        aid, label = tile.column("aid").to_numpy(), tile.column("label").to_numpy()
        nths, ats = tile.column("nth").to_pylist(), tile.column("at").to_pylist()
        other = labels != label[:, None]
        found = []
        for k in range(max(map(len, nths))):
            has = np.array([len(x) > k for x in nths])
            at = [x[k] if len(x) > k else 0 for x in ats]
            least = np.array([-(-low * x // WHOLE) for x in at], np.int64)[:, None]
            most = np.array([high * x // WHOLE for x in at], np.int64)[:, None]
            nth = np.array([x[k] if len(x) > k else 0 for x in nths], np.int64)
            allowed = other & has[:, None] & (least <= scores) & (scores <= most)
            r, c = _best(scores, allowed, order, negatives)
            found.append((aid[r], nth[r], ids[c], scores[r, c]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    mined = compare(visits(seekers, "negatives"), in_windows, "aid long, nth long, neg long, negative_score long")
    best = Window.partitionBy("aid", "nth").orderBy(F.desc("negative_score"), "neg")
    names = start.select("aid", F.col("vec_id").alias("anchor_id"))
    return (
        mined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
        .join(pos, ["aid", "nth"]).join(names, "aid")
        .select(
            "anchor_id", F.col("id").alias("positive_id"), "rank", F.col("neg").alias("negative_id"),
            F.col("score").alias("positive_score"), "negative_score",
        )
    )


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def moved_labels(vectors: DataFrame) -> DataFrame:
    """The benchmark's labels: where the id is divisible by 7, the next of ten."""
    return vectors.withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(moved_labels(table(spark, sf_dir, "embeddings")))


OP13_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
