"""Hard negatives against brute force in whole numbers, with odd rows, copies and small blocks."""

import math

import duckdb
import numpy as np
import pytest

from sluice.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, aid int, leaf string"


def plain(rows, every=100, low=80, high=100):
    known = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows
             if i is not None and lab is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, va in known:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in known]
        pos = sorted((s, i) for s, i, lab in scored if lab == label and i != a)[:5]
        for ps, p in pos:
            near = sorted((s, i) for s, i, lab in scored if lab != label and low * -ps <= 100 * -s <= high * -ps)[:5]
            out += [(a, p, k + 1, n, -ps, -s) for k, (s, n) in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 3, "x") for i, v, lab in rows], SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()))


def cloud(n, dim, seed, labels=4, spread=0.35, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    at = rng.integers(0, centres, n)
    vecs = middle[at] + spread * rng.normal(size=(n, dim))
    vecs /= np.linalg.norm(vecs, axis=1, keepdims=True)
    return [(i, [float(np.float32(x)) for x in v], int(rng.integers(0, labels))) for i, v in enumerate(vecs)]


@pytest.mark.parametrize("how", [
    {}, {"fanout": 3, "leaf_sample": 4, "sample": 60, "leaf_rows": 16, "leaf_anchors": 2}, {"fanout": 2, "leaf_sample": 100000},
])
def test_equals_brute_force(spark, how):
    rows = cloud(600, 8, 1)
    assert got(H.hard_negatives(frame(spark, rows), anchors_every=20, **how)) == plain(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(150, 4, 2, labels=2)
    rows += [(1000, None, 1), (1001, [1.0, None, 0.0, 0.0], 1), (1002, [nan, 0.0, 0.0, 0.0], 1), (1003, [inf, 0.0, 0.0, 0.0], 0),
             (1100, [0.5, 0.5, 0.5, 0.5], None), (None, [0.5, 0.5, 0.5, 0.5], 1), (1200, [], 1), (1201, [0.5, 0.5], 0),
             (1300, [0.0] * 4, 1), (1400, [-1.0] * 4, 9), (1500, [0.3] * 4, 1), (1500, [0.3] * 4, 1), (1500, [0.3] * 4, 0)]
    rows += [(2000 + i, [0.4, 0.4, 0.1, 0.0], i % 2) for i in range(300)]  # one large group of copies
    for how in ({}, {"fanout": 3, "leaf_sample": 8, "sample": 100, "leaf_rows": 32, "leaf_anchors": 2}):
        assert got(H.hard_negatives(frame(spark, rows), anchors_every=50, **how)) == plain(rows, 50)


def test_wide_components_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.float32(rng.integers(-2**22, 2**22, 4))], i % 2) for i in range(60)]
    assert got(H.hard_negatives(frame(spark, rows), anchors_every=10, low=1)) == plain(rows, 10, low=1)


def test_nothing_to_mine(spark):
    assert got(H.hard_negatives(frame(spark, []))) == []
    assert got(H.hard_negatives(frame(spark, [(0, None, 1)]))) == []
    assert got(H.hard_negatives(frame(spark, [(0, [1.0], 1), (1, [1.0], 2)]))) == []


def test_ranges_leave_leaves_out(spark):
    rows = cloud(3000, 6, 4, spread=0.05, centres=30)
    work = {}
    found = got(H.hard_negatives(frame(spark, rows), anchors_every=50, fanout=4, leaf_sample=20, sample=1000, work=work))
    assert found == plain(rows, 50)
    assert all(0 < reached < 0.5 * whole for reached, whole in work.values()), work


def test_moved_labels_and_sql_agree(spark, tmp_path):
    rows = cloud(1500, 16, 6, labels=10, spread=0.2)
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame([r for r in rows], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    cur = con.execute(H.OP13_SQL)
    df = H.op13_hard_negatives(spark, str(tmp_path))
    assert [c[0] for c in cur.description] == df.columns
    assert got(df) == sorted(cur.fetchall())
