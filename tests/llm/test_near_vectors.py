"""Embedding near-dedup against brute force."""

import numpy as np
import pytest

from sluice.llm.near_vectors import band_plan, encode, near_vectors, op1_near_vectors, rotations

SCHEMA = "vec_id long, embedding array<float>, label int, g long, key long"


def brute(rows, threshold=0.95):
    ids, usable, mats = [], [], []
    for i, v in rows:
        a = None if v is None else np.array([np.nan if x is None else x for x in v], np.float64)
        ok = a is not None and len(a) and np.isfinite(a).all() and (a != 0).any()
        ids.append(i)
        usable.append(bool(ok))
        mats.append(a / np.linalg.norm(a) if ok else None)
    n = len(rows)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and len(mats[i]) == len(mats[j]):
                near[i, j] = mats[i] @ mats[j] >= threshold
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(near)):
            low = min(root[i], root[j])
            if root[i] != low or root[j] != low:
                root[i] = root[j] = low
                changed = True
    out = []
    for i in range(n):
        members = [ids[j] for j in range(n) if root[j] == root[i] and ids[j] is not None]
        comp = ids[i] if not usable[i] else (min(members) if members else None)
        out.append((ids[i], int(near[i].sum()), comp, ids[i] == comp))
    return sorted(map(repr, out))


def clusters(n=300, dim=24, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    base[: n // 3] = base[0] + 0.05 * rng.standard_normal((n // 3, dim))  # a third are near copies
    base[n // 3 : n // 2] = base[n // 3 : n // 2] + 0
    base[n // 2 : n // 2 + 20] = base[n // 2 - 20 : n // 2] * 3  # scaled copies
    base[n // 2 + 20 : n // 2 + 30] = base[n // 2 + 20]  # equal
    return base.astype(np.float32)


ODD = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] + [1.0] * 23),
       (905, [float("inf")] * 24), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, [1.0, 2.0]), (None, None), (3, None)]


@pytest.mark.parametrize("block", [4096, 16])
def test_equals_brute_force(spark, block):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(clusters())]
    rows += [rows[7], rows[250], (250, rows[10][1])] + ODD  # repeated rows, one id on two vectors
    df = spark.createDataFrame([(i, v, 1, 5, 6) for i, v in rows], SCHEMA)
    got = near_vectors(df, recall=1 - 1e-9, block=block).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == brute(rows)


def test_no_rows(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op1_near_vectors(spark, "/root/testdata/sf0.001").select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == brute(rows)


def test_estimate_is_unbiased_and_bound_is_certain():
    rng = np.random.default_rng(1)
    o = rng.standard_normal(32)
    o /= np.linalg.norm(o)
    q = o + 0.25 * rng.standard_normal(32) / np.sqrt(32)
    q /= np.linalg.norm(q)
    c, estimates = o @ q, []
    for seed in range(400):
        signs, factor = encode(o[None], 32, 1, seed)
        code = np.where(signs[0, :32], 1, -1) / np.sqrt(32)
        estimates.append(code @ (rotations(32, 1, seed) @ q) / factor[0])
        assert abs(estimates[-1] - c) <= np.sqrt(1 - c * c) * np.sqrt(1 - factor[0] ** 2) / factor[0] + 1e-9
    assert abs(np.mean(estimates) - c) < 0.01


def test_plan_grows_slowly():
    assert band_plan(100, 0.95, 0.999, 32)[0] < band_plan(10**9, 0.95, 0.999, 32)[0] <= 25
