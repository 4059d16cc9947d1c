"""Row keys against hashlib; NULL handling as documented."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.keys import hash_key, key_text


def _random_strings(n, seed=7):
    rnd = random.Random(seed)
    pool = "abcXYZ019 |-_éß漢字🙂\t"
    return ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 20))) for _ in range(n)]


def test_hashes_match_hashlib(spark):
    vals = _random_strings(300)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    rows = df.select(
        "i",
        hash_key([F.col("v")], "sha256", "compat").alias("a"),
        hash_key([F.col("v")], "sha512", "compat").alias("b"),
        hash_key([F.col("v")], mode="compat").alias("c"),
    ).orderBy("i").collect()
    for r in rows:
        raw = vals[r["i"]].encode("utf-8")
        assert r["a"] == hashlib.sha256(raw).hexdigest()
        assert r["b"] == hashlib.sha512(raw).hexdigest()
        assert r["c"] == hashlib.sha3_512(raw).hexdigest()


def test_exact_keys_tell_all_rows_apart(spark):
    rows = [("a", None, "b"), (None, "a", "b"), (None, None, None), ("", "", ""), ("a||b", "c", "d"), ("a", "b||c", "d"),
            ("-", None, "b"), ("1:a", None, "b"), ("a1:b", "", "d"), ("a", "1:b", "d"), ("\U0001f642", "\U0001f642", None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    cols = [F.col("x"), F.col("y"), F.col("z")]
    keys = [r["k"] for r in df.select(hash_key(cols).alias("k")).collect()]
    assert len(set(keys)) == len(rows)
    text = df.select(key_text(cols).alias("t")).first()["t"]
    assert text == "1:a-1:b" and keys[0] == hashlib.sha256(text.encode()).hexdigest()


def test_compat_keys_join_bare_text(spark):
    df = spark.createDataFrame([("a", None, "b"), (None, "a", "b"), (None, None, None)], "x string, y string, z string")
    cols = [F.col("x"), F.col("y"), F.col("z")]
    rows = df.select(key_text(cols, "compat").alias("t"), hash_key(cols, mode="compat").alias("k"),
                     hash_key(cols, "sha256", "compat", null_token="\\N").alias("k2")).collect()
    assert rows[0]["t"] == rows[1]["t"] == "a||b"
    assert rows[0]["k"] == rows[1]["k"] == hashlib.sha3_512(b"a||b").hexdigest()
    assert rows[0]["k2"] != rows[1]["k2"] and rows[2]["t"] == ""
    with pytest.raises(ValueError, match="compat"):
        key_text(cols, null_token="x")
    with pytest.raises(ValueError, match="unknown key mode"):
        key_text(cols, "other")
