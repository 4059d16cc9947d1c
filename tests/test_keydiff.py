"""Key differences by checksum tree against counted keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.operators import keydiff as D


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def plain(a, b):
    s, t = Counter(a), Counter(b)
    kind = lambda k: "missing" if not t[k] else "extra" if not s[k] else "repeated"
    return sorted(((k, s[k], t[k], kind(k)) for k in {*s, *t} if s[k] != t[k]), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("leaf_rows", [0, 50, 10**6])
def test_equals_counting(spark, leaf_rows):
    rnd = random.Random(2)
    a = [f"k{rnd.randrange(4000)}" for _ in range(3000)] + [None, None, "", "é"]
    b = [k for k in a if rnd.random() > 0.01] + [f"new{i}" for i in range(9)] + ["k1"] * 5 + [None]
    assert got(D.key_diff(frame(spark, a), frame(spark, b), "k", leaf_rows=leaf_rows)) == plain(a, b)


def test_equal_sides_stop_at_the_first_level(spark):
    keys = [f"k{i}" for i in range(5000)] + ["k1"] * 40
    work = []
    assert got(D.key_diff(frame(spark, keys), frame(spark, keys[::-1]), "k", work=work)) == []
    assert work == [(8, 0, 0)]


def test_one_missing_key_leaves_few_rows(spark):
    keys = [f"k{i}" for i in range(20000)]
    work = []
    diff = D.key_diff(frame(spark, keys), frame(spark, keys[:-1]), "k", leaf_rows=10, work=work)
    assert got(diff) == [(keys[-1], 1, 0, "missing")]
    assert [n for _, n, _ in work] == [1, 1] and work[-1][2] <= 10


def test_swapped_counts_and_empty_sides(spark):
    assert got(D.key_diff(frame(spark, ["a", "a", "b"]), frame(spark, ["a", "b", "b"]), "k")) == [
        ("a", 2, 1, "repeated"), ("b", 1, 2, "repeated")]
    assert got(D.key_diff(frame(spark, []), frame(spark, ["x", None]), "k")) == plain([], ["x", None])
    assert got(D.key_diff(frame(spark, []), frame(spark, []), "k")) == []


def test_sums_take_no_keys_along(spark):
    plan = D.differing_prefixes(D._keys(frame(spark, ["a"]), "k"), D._keys(frame(spark, ["b"]), "k"), 8)
    assert "key" not in plan._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [prefix", 1)[0]
    numbered = frame(spark, ["1", "2"]).select(F.col("k").cast("long").alias("n"))
    assert got(D.key_diff(numbered, frame(spark, ["1", "2"]), "n", "k")) == []
