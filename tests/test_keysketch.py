"""Key sketches: certain about absent keys, files left out, crashes mended; partitions; bucketed plans."""


import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import keysketch as K
from sluice.operators import load as L
from sluice.plans import ingest as P
from sluice.session import work_path
from sluice.spec import make_spec

SCHEMA = "KEY string, v long, day string"


def rows(spark, lo, hi, day="a"):
    return spark.range(lo, hi).select(
        F.sha2(F.col("id").cast("string"), 256).alias("KEY"), F.col("id").alias("v"), F.lit(day).alias("day"))


def target(spark, **how):
    t = L.Target(path=work_path(spark, "test", "sketch"), sketch=True, **how)
    L.create_target(spark, t, rows(spark, 0, 1).schema)
    return t


def all_keys(spark, t):
    return sorted(r["v"] for r in L.read_target(spark, t).select("v").collect())


@pytest.mark.parametrize("n", [1, 2, 50, 5000])
def test_bits_never_deny_a_key_and_seldom_claim_one(n):
    rng = np.random.default_rng(n)
    mine, other = rng.integers(-2**63, 2**63 - 1, n), rng.integers(-2**63, 2**63 - 1, 20000)
    bits = K.sketch_bits(mine)
    assert all(K.may_hold(bits, mine[i : i + 1]) for i in range(n))
    assert sum(K.may_hold(bits, other[i : i + 1]) for i in range(2000)) == 0


def test_only_files_with_old_keys_are_read(spark):
    t = target(spark)
    for k in range(6):
        L.append_table(rows(spark, 1000 * k, 1000 * (k + 1)).coalesce(1), t)
    batch = rows(spark, 3990, 4000).unionByName(rows(spark, 6000, 7000))
    res = L.incremental_insert(batch, t, "KEY")
    assert (res.rows_in, res.rows_written) == (1010, 1000) and res.files_read == 1 and res.files_total >= 6
    assert L.incremental_insert(batch, t, "KEY").rows_written == 0
    assert all_keys(spark, t) == list(range(7000))
    nothing = L.incremental_insert(rows(spark, 9000, 9100), t, "KEY")
    assert nothing.files_read == 0 and nothing.rows_written == 100


def test_file_without_a_sketch_is_sketched_first(spark):
    """A load that died before its sketch: the next one still sees its keys."""
    t = target(spark)
    assert L.incremental_insert(rows(spark, 0, 500), t, "KEY").rows_written == 500
    plain = L.Target(path=t.path)
    L.append_table(rows(spark, 500, 900).coalesce(1), plain)
    assert L.incremental_insert(rows(spark, 0, 1000), t, "KEY").rows_written == 100
    assert K.update_sketches(L.read_target(spark, t), t.path, "KEY") == 0


def test_null_keys_empty_batches_and_no_files(spark):
    t = target(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert L.incremental_insert(empty, t, "KEY").rows_written == 0
    odd = spark.createDataFrame([(None, 1, "a"), (None, 2, "a"), ("", 3, "a"), ("é x%20y", 4, "b c")], SCHEMA)
    assert L.incremental_insert(odd, t, "KEY").rows_written == 4
    assert L.incremental_insert(odd, t, "KEY").rows_written == 2  # null keys always pass
    assert L.incremental_insert(empty, t, "KEY").rows_written == 0


def test_small_cells_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(K, "CELL_BYTES", 200)
    monkeypatch.setattr(K, "CELL_KEYS", 10)
    t = target(spark, partition_by=("day",))
    L.append_table(rows(spark, 0, 2000, "a b").unionByName(rows(spark, 2000, 3000, "c%d+é/ü")).repartition(5), t)
    res = L.incremental_insert(rows(spark, 1500, 3500, "e"), t, "KEY")
    assert res.rows_written == 500 and all_keys(spark, t) == list(range(3500))


def test_sketches_need_a_path():
    with pytest.raises(ValueError, match="path"):
        L.Target(table="x", sketch=True)


def test_one_month_reads_one_partition(spark):
    """A re-run of one month through ingest_table compares with that month's folder only."""
    spec = make_spec("m", "M_KEY", [("month", "MONTH", "string"), ("id", "ID", "string")])
    raw = spark.createDataFrame([(f"2024-{m:02d}", f"r{m}-{i}") for m in range(1, 13) for i in range(20)], "month string, id string")
    t = L.Target(path=work_path(spark, "test", "months"), partition_by=("MONTH",))
    opts = P.IngestOptions(as_of="2024-06-01 00:00:00", create_if_missing=True, partition_col="MONTH")
    assert P.ingest_table(spark, P.IngestJob(spec, lambda: raw, t), opts).rows_written == 240
    one = raw.where("month = '2024-03'")
    assert P.ingest_table(spark, P.IngestJob(spec, lambda: one, t), opts).rows_written == 0
    existing = L._in_partitions(L.read_target(spark, L.resolve_target(t, spec.schema)), one.withColumnRenamed("month", "MONTH"), "MONTH")
    assert len({os.path.dirname(f) for f in [r[0] for r in existing.select("_metadata.file_path").distinct().collect()]}) == 1
    plan = existing._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-03" in plan


def test_null_partition_and_many_partitions(spark, monkeypatch):
    have = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "p string, v int")
    batch = spark.createDataFrame([(None,), ("b",)], "p string")
    for listed in (10, 1):
        monkeypatch.setattr(L, "LISTED_PARTITIONS", listed)
        assert sorted(r["v"] for r in L._in_partitions(have, batch, "p").collect()) == [2, 3]


def test_bucketed_load_cleans_its_batch_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sketch_db")
    t = L.Target(table="sketch_db.b_" + work_path(spark, "x").rsplit("/", 1)[-1][:8], buckets=4)
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    batch = rows(spark, 0, 300)
    watched = batch.mapInArrow(look, batch.schema)
    assert L.incremental_insert(watched, t, "KEY", create_if_missing=True, schema=batch.schema).rows_written == 300
    assert seen.value == 300
    assert L.incremental_insert(watched, t, "KEY").rows_written == 0 and seen.value == 600
