"""Load modes: the FIXTURES.md load-case table, idempotence, plan shape."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import load as L
from sluice.session import work_path
from sluice.spec import make_spec
from sluice.operators.conform import conform

from conftest import AS_OF

SPEC = make_spec("k", "KEY", [("v", "V", "string")], audit=None)


def batch(spark, *vals):
    return conform(spark.createDataFrame([(v,) for v in vals], "v string"), SPEC, AS_OF)


def fresh_target(spark, *vals):
    t = L.Target(path=work_path(spark, "test", "load"))
    L.create_target(spark, t, SPEC.schema, SPEC.key_col)
    if vals:
        L.append_table(batch(spark, *vals), t)
    return t


def contents(spark, t):
    return sorted(r["V"] for r in L.read_target(spark, t).collect())


def test_first_load_rerun_partial(spark):
    t = fresh_target(spark)
    assert L.incremental_insert(batch(spark, "k1", "k2"), t, "KEY").rows_written == 2
    assert L.incremental_insert(batch(spark, "k1", "k2"), t, "KEY").rows_written == 0
    assert contents(spark, t) == ["k1", "k2"]
    t2 = fresh_target(spark, "k1")
    r = L.incremental_insert(batch(spark, "k1", "k2"), t2, "KEY")
    assert (r.rows_in, r.rows_written) == (2, 1)
    assert contents(spark, t2) == ["k1", "k2"]


def test_duplicates_in_batch(spark):
    t = fresh_target(spark)
    L.incremental_insert(batch(spark, "k1", "k1"), t, "KEY")
    assert contents(spark, t) == ["k1", "k1"]
    t2 = fresh_target(spark)
    L.incremental_insert(batch(spark, "k1", "k1"), t2, "KEY", dedupe=True)
    assert contents(spark, t2) == ["k1"]


def test_append_and_historical(spark):
    t = fresh_target(spark, "k1")
    L.load(batch(spark, "k1"), t, "KEY", "append")
    assert contents(spark, t) == ["k1", "k1"]
    t2 = fresh_target(spark, "k1")
    L.load(batch(spark, "k2"), t2, "KEY", "append", historical=True)
    assert contents(spark, t2) == ["k2"]
    with pytest.raises(ValueError, match="historical"):
        L.load(batch(spark, "k2"), t2, "KEY", "incremental_insert", historical=True)
    with pytest.raises(ValueError, match="unknown write mode"):
        L.load(batch(spark, "k2"), t2, "KEY", "merge")


def test_missing_target(spark):
    t = L.Target(path=work_path(spark, "test", "absent"))
    assert not L.target_exists(spark, t)
    with pytest.raises(L.TargetMissingError):
        L.incremental_insert(batch(spark, "k1"), t, "KEY")
    r = L.incremental_insert(batch(spark, "k1"), t, "KEY", create_if_missing=True, schema=SPEC.schema)
    assert r.rows_written == 1 and L.target_exists(spark, t)


def test_inserted_plus_present_equals_input(spark):
    vals = [f"k{i}" for i in range(50)]
    t = fresh_target(spark, *vals[:20])
    r = L.incremental_insert(batch(spark, *vals), t, "KEY")
    assert r.rows_written + 20 == r.rows_in == 50


def test_by_name_column_matching(spark):
    t = fresh_target(spark)
    b = batch(spark, "k1")
    reordered = b.select(*reversed(b.columns))
    L.append_table(reordered, t)
    assert contents(spark, t) == ["k1"]


def test_target_side_reads_only_the_key(spark):
    t = fresh_target(spark, "k1")
    plan = L.new_rows(batch(spark, "k1", "k2"), L.read_target(spark, t), "KEY") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<KEY:string>" in plan


def test_hot_key_skew_is_loaded_whole(spark):
    # a third of the batch is one identical row: all copies load (no dedupe), none dropped
    vals = ["hot"] * 300 + [f"k{i}" for i in range(600)]
    t = fresh_target(spark, "k0")
    r = L.incremental_insert(batch(spark, *vals), t, "KEY")
    assert r.rows_written == 899
    assert L.read_target(spark, t).filter(F.col("V") == "hot").count() == 300


def test_bucketed_catalog_target(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sluice_test")
    name = "sluice_test.bucketed_" + work_path(spark, "x").rsplit("/", 1)[-1][:8]
    t = L.Target(table=name, buckets=4)
    L.create_target(spark, t, SPEC.schema, SPEC.key_col)
    assert L.target_exists(spark, t)
    L.incremental_insert(batch(spark, "k1", "k2"), t, "KEY")
    assert L.incremental_insert(batch(spark, "k1", "k2", "k3"), t, "KEY").rows_written == 1
    assert contents(spark, t) == ["k1", "k2", "k3"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = L.new_rows(batch(spark, "k9"), L.read_target(spark, t), "KEY") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the bucketed target side is read without its own shuffle: one exchange (the batch)
    assert plan.count("Exchange hashpartitioning") == 1


def test_create_target_in_empty_folder_but_never_over_a_table(spark):
    import os
    t = L.Target(path=work_path(spark, "test", "empty"))
    os.makedirs(t.path.split(":", 1)[-1] if t.path.startswith("file:") else t.path, exist_ok=True)
    assert not L.target_exists(spark, t)
    L.create_target(spark, t, SPEC.schema, SPEC.key_col)
    assert L.target_exists(spark, t)
    with pytest.raises(ValueError, match="already exists"):
        L.create_target(spark, t, SPEC.schema, SPEC.key_col)


def test_hot_key_partition_is_split_by_aqe(spark):
    # a third of the batch shares one key; AQE splits that shuffle partition
    # of the batch side (left-anti allows it) instead of one task taking it all
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.sha2(F.col("id").cast("string"), 256))
        batch = spark.range(30000).select(hot.alias("KEY"), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
        target = spark.range(1000).select(F.sha2((F.col("id") + 10 ** 6).cast("string"), 256).alias("KEY"))
        out = L.new_rows(batch, target, "KEY")
        assert len(out.collect()) == 30000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_reload_refuses_to_overwrite_its_own_input(spark):
    t = fresh_target(spark, "k1")
    with pytest.raises(ValueError, match="refusing"):
        L.reload_table(L.read_target(spark, t), t)
    assert contents(spark, t) == ["k1"]


def test_contract_drift_is_an_error(spark):
    t = fresh_target(spark)
    wider = batch(spark, "k1").withColumn("NEW_COL", F.lit(1))
    with pytest.raises(ValueError, match="target lacks columns"):
        L.append_table(wider, t)
    with pytest.raises(ValueError, match="frame lacks target columns"):
        L.append_table(batch(spark, "k1").drop("V"), t)


def test_partitioned_path_target_and_catalog_reload(spark):
    spec = make_spec("p", "KEY", [("v", "V", "string"), ("d", "DAY", "string")], audit=None)

    def rows(*pairs):
        return conform(spark.createDataFrame(list(pairs), "v string, d string"), spec, AS_OF)

    t = L.Target(path=work_path(spark, "test", "parts"), partition_by=("DAY",))
    L.create_target(spark, t, spec.schema, spec.key_col)
    L.incremental_insert(rows(("a", "d1"), ("b", "d2")), t, "KEY")
    assert L.incremental_insert(rows(("a", "d1"), ("c", "d2")), t, "KEY").rows_written == 1
    got = sorted((r["V"], r["DAY"]) for r in L.read_target(spark, t).collect())
    assert got == [("a", "d1"), ("b", "d2"), ("c", "d2")]

    spark.sql("CREATE DATABASE IF NOT EXISTS sluice_test")
    name = "sluice_test.reload_" + work_path(spark, "x").rsplit("/", 1)[-1][:8]
    ct = L.Target(table=name, buckets=4)
    L.create_target(spark, ct, spec.schema, spec.key_col)
    L.append_table(rows(("a", "d1")), ct)
    L.load(rows(("z", "d9")), ct, "KEY", "append", historical=True)
    assert [r["V"] for r in L.read_target(spark, ct).collect()] == ["z"]
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert detail.get("Num Buckets") == "4"


def test_partitioned_catalog_target(spark):
    spec = make_spec("p", "KEY", [("d", "DAY", "string"), ("v", "V", "string")], audit=None)

    def rows(*pairs):
        return conform(spark.createDataFrame(list(pairs), "d string, v string"), spec, AS_OF)

    spark.sql("CREATE DATABASE IF NOT EXISTS sluice_test")
    name = "sluice_test.parts_" + work_path(spark, "x").rsplit("/", 1)[-1][:8]
    t = L.Target(table=name, partition_by=("DAY",))
    L.create_target(spark, t, spec.schema, spec.key_col)
    L.incremental_insert(rows(("d1", "a"), ("d2", "b")), t, "KEY")
    assert L.incremental_insert(rows(("d1", "a"), ("d2", "c")), t, "KEY").rows_written == 1
    got = sorted((r["V"], r["DAY"]) for r in L.read_target(spark, t).collect())
    assert got == [("a", "d1"), ("b", "d2"), ("c", "d2")]
    L.load(rows(("d3", "z")), t, "KEY", "append", historical=True)
    assert [(r["V"], r["DAY"]) for r in L.read_target(spark, t).collect()] == [("z", "d3")]


def test_keys_of_a_staged_batch_are_compared_without_its_rows(spark, monkeypatch):
    root = work_path(spark, "test", "fresh")
    rows = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("KEY"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "KEY string, id long"))
    rows.write.parquet(f"{root}/batch")
    batch = spark.read.parquet(f"{root}/batch")
    shuffled = []
    monkeypatch.setattr(L, "LISTED_KEYS", 10)
    monkeypatch.setattr(L, "new_rows", lambda b, e, k, real=L.new_rows, **how: shuffled.append(k) or real(b, e, k, **how))

    def fresh(held):
        path = f"{root}/{held.replace(' ', '')}"
        rows.where(held).write.parquet(path)
        frame, n = L.fresh_rows(batch, spark.read.parquet(path), "KEY")
        assert n == 4001
        return sorted(r["id"] for r in frame.collect()) if frame is not None else []

    assert fresh("id >= 0") == [-1]  # a re-run: rows without a key always pass
    assert fresh("id > 3994") == [-1, *range(3995)]  # few known
    assert fresh("id > 4") == [-1, 0, 1, 2, 3, 4]  # few new
    assert fresh("id > 99999") == [-1, *range(4000)]
    assert shuffled == []
    assert fresh("id % 2 = 0") == [-1, *range(1, 4000, 2)] and shuffled == ["KEY"]


def test_packed_keys_differ_where_keys_do(spark):
    keys = ["ab", "AB", "0ab", "h\xab", "t", "", "abc", "6162", "a b", "ab\n", "abc\n"]
    packed = spark.createDataFrame([(k,) for k in keys], "k string").select(L.packed_key(F.col("k"))).collect()
    assert len({bytes(r[0]) for r in packed}) == len(keys)


def test_a_batch_of_known_rows_is_loaded_again_without_moving_them(spark, monkeypatch):
    moved = []
    monkeypatch.setattr(L, "new_rows", lambda b, e, k, real=L.new_rows, **how: moved.append(k) or real(b, e, k, **how))
    t = L.Target(path=work_path(spark, "test", "again"))
    rows = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("KEY"), "id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert L.incremental_insert(rows, t, "KEY", create_if_missing=True).rows_written == 500
        for listed in (1000, 5):
            monkeypatch.setattr(L, "LISTED_KEYS", listed)
            moved.clear()
            again = L.incremental_insert(rows, t, "KEY")
            assert (again.rows_in, again.rows_written, moved) == (500, 0, [])
        more = spark.range(498, 503).select(F.sha2(F.col("id").cast("string"), 256).alias("KEY"), "id")
        assert L.incremental_insert(more, t, "KEY").rows_written == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert L.read_target(spark, t).count() == 503
