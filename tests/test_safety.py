"""Nothing is lost: overwrites, rejects, odd sizes, hot keys, drifted csv rows."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.functions import cells
from sluice.operators import conform as C
from sluice.operators import load as L
from sluice.operators.counts import reconcile
from sluice.plans import ingest as P
from sluice.plans.tpch_queries import dirty_lineitem
from sluice.session import work_path
from sluice.sources import raw
from sluice.spec import make_spec
from sluice.specs import tpch
from pyspark.sql.types import StringType

from conftest import AS_OF, SF001


def bare(path):
    return path.split(":", 1)[1] if path.startswith("file:") else path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_self_overwrite_is_refused_however_the_path_is_written(spark):
    path = work_path(spark, "test", "with a space")
    spark.range(10).write.parquet(path)
    plain = "/" + bare(path).lstrip("/")
    for written in (path, plain, f"file://{plain}", f"file:{plain}/", plain.rsplit("/", 1)[0]):
        df = spark.read.parquet(path).where("id > 3")
        assert raw.reads_path(df, written), written
        with pytest.raises(ValueError, match="refusing"):
            raw.write_raw(df, written)
    assert spark.read.parquet(path).count() == 10
    assert not raw.reads_path(spark.read.parquet(path), path + "x")


def failing(df):
    return df.withColumn("id", F.expr("CASE WHEN id >= 0 THEN raise_error('stop') END").cast("long"))


def test_failed_overwrites_leave_the_old_rows(spark):
    path = work_path(spark, "test", "kept")
    raw.write_raw(spark.range(10), path)
    with pytest.raises(Exception, match="stop"):
        raw.write_raw(failing(spark.range(5)), path)
    assert spark.read.parquet(path).count() == 10
    target = L.Target(path=work_path(spark, "test", "kept_target"))
    L.create_target(spark, target, spark.range(1).schema)
    L.append_table(spark.range(7), target)
    with pytest.raises(Exception, match="stop"):
        L.reload_table(failing(spark.range(5)), target)
    assert L.read_target(spark, target).count() == 7
    assert L.reload_table(spark.range(3), target).rows_written == 3
    assert L.read_target(spark, target).count() == 3
    left = [f for p in (path, target.path) for f in os.listdir(os.path.dirname(bare(p))) if ".new-" in f or ".old-" in f]
    assert left == []


def test_rejects_need_a_place(spark):
    spec = tpch.lineitem_spec(strict_quantity=True)
    job = P.IngestJob(spec, lambda: dirty_lineitem(spark, SF001), L.Target(path=work_path(spark, "test", "norej")))
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True)
    with pytest.raises(ValueError, match="reject target"):
        P.ingest_table(spark, job, opts)
    opts.drop_rejects = True
    rec = P.ingest_table(spark, job, opts)
    assert rec.rows_rejected > 0 and rec.rows_written + rec.rows_rejected == rec.rows_in


def test_rejects_keep_their_raw_row_once(spark):
    root = work_path(spark, "test", "rej_once")
    spec = tpch.lineitem_spec(strict_quantity=True)
    job = P.IngestJob(spec, lambda: dirty_lineitem(spark, SF001), L.Target(path=f"{root}/t"), L.Target(path=f"{root}/r"))
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True)
    first = P.ingest_table(spark, job, opts)
    P.ingest_table(spark, job, opts)
    rejects = L.read_target(spark, job.reject_target)
    assert rejects.count() == first.rows_rejected > 0
    row = rejects.first()
    assert '"qty_text"' in row[C.RAW_ROW_COL] and row[C.REASON_COL]
    stage = os.path.dirname(bare(work_path(spark, "stage", spec.name)))
    assert not os.path.exists(stage) or os.listdir(stage) == []  # staged batches are removed


def test_json_of_any_size_is_json(spark):
    texts = ['"' + "y" * 21_000_000 + '"', "9" * 1500, "[" * 3000 + "]" * 3000, "null", '{"a":1,"a":2}', "NaN", "1 2", "'a'", '1}, {"v":2', ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"] for r in df.select("i", cells.json_text_cell(F.col("t"), StringType()).alias("j")).where("j is not null").select("i").collect()}
    assert got == {0, 1, 2, 3, 4}
    nested = spark.createDataFrame([((1, None),)], "s struct<a int, b string>")
    assert nested.select(cells.json_text_cell(F.col("s"), nested.schema["s"].dataType).alias("j")).first()["j"] == '{"a":1,"b":null}'


def test_csv_records_that_do_not_fit_are_set_aside(spark):
    path = work_path(spark, "test", "csv")
    os.makedirs(bare(path))
    with open(f"{bare(path)}/a.csv", "w") as f:
        f.write("a,b\n1,2\n3,4,5,6\n7\n")
    back = raw.read_raw(spark, path, "csv", corrupt_col="_bad")
    assert back.columns == ["a", "b", "_bad"]
    root = work_path(spark, "test", "csv_out")
    spec = make_spec("t", "K", [("a", "A", "string"), ("b", "B", "string")])
    job = P.IngestJob(spec, lambda: raw.read_raw(spark, path, "csv", corrupt_col="_bad"), L.Target(path=f"{root}/t"),
                      L.Target(path=f"{root}/r"), corrupt_col="_bad")
    P.ingest_table(spark, job, P.IngestOptions(as_of=AS_OF, create_if_missing=True))
    assert [r["A"] for r in L.read_target(spark, job.target).collect()] == ["1"]
    rejected = L.read_target(spark, job.reject_target).collect()
    assert sorted(r["A"] for r in rejected) == ["3", "7"] and "3,4,5,6" in str([r[C.RAW_ROW_COL] for r in rejected])


def test_numbers_are_epoch_seconds_and_future_parsed_text_can_be_clamped(spark):
    spec = make_spec("t", "K", [("n", "N", "timestamp"), ("a", "A", "timestamp"), ("b", "B", "timestamp")],
                     future_policy={"A": "clamp_parsed"})
    df = spark.createDataFrame([(1700000000, "03/10/2025", "03/10/2025"), (999, "2025-03-10 00:00:00", "x")], "n long, a string, b string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        rows = C.conform(df, spec, AS_OF).select(*[F.col(c).cast("string") for c in "NAB"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(rows[0]) == ("2023-11-14 22:13:20", "2024-06-01 12:00:00", "2025-03-10 00:00:00")
    assert tuple(rows[1]) == (None, "2025-03-10 00:00:00", None)


def test_reconcile_reads_each_side_once(spark):
    a = work_path(spark, "test", "rec_a")
    b = work_path(spark, "test", "rec_b")
    keys = F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 50).cast("string")).alias("k")
    spark.range(1000).select(keys).write.parquet(a)
    spark.range(30).select(keys).write.parquet(b)
    out = reconcile(spark.read.parquet(a), spark.read.parquet(b), "k", "x")
    assert plan_of(out).count("FileScan parquet") == 2
    left, right = [r["k"] for r in spark.read.parquet(a).collect()], {r["k"] for r in spark.read.parquet(b).collect()}
    assert out.first()["missing_in_target"] == sum(k is None or k not in right for k in left)
    empty = reconcile(spark.range(0), spark.range(0), "id").first()
    assert (empty["source_rows"], empty["target_rows"], empty["missing_in_target"]) == (0, 0, 0)


def test_hot_key_is_split_on_a_bucketed_target(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    name = "hot_bucketed_" + os.urandom(4).hex()
    target = L.Target(table=name, buckets=8)
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("KEY"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    rows.write.parquet(path := work_path(spark, "test", "hot"))
    batch = spark.read.parquet(path)
    L.create_target(spark, target, batch.schema, "KEY")
    L.incremental_insert(batch.limit(100), target, "KEY")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = L.new_rows(batch, spark.table(name), "KEY", split_keys_of=batch)
        n = len(out.collect())
        known = {r["KEY"] for r in spark.table(name).select("KEY").collect()}
        assert n == sum(r["KEY"] not in known for r in batch.select("KEY").collect())
        assert "SortMergeJoin(skew=true)" in plan_of(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.sql(f"DROP TABLE {name}")


def test_a_rerun_on_a_bucketed_target_counts_its_rows(spark):
    target = L.Target(table="rerun_bucketed_" + os.urandom(4).hex(), buckets=4)
    rows = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("KEY"), "id")
    L.create_target(spark, target, rows.schema, "KEY")
    results = [L.incremental_insert(rows, target, "KEY") for _ in range(2)]
    assert [(r.rows_in, r.rows_written) for r in results] == [(500, 500), (500, 0)]
    spark.sql(f"DROP TABLE {target.table}")


def test_a_batch_reads_only_its_partitions_of_the_target(spark):
    target = L.Target(path=work_path(spark, "test", "by_month"), partition_by=("month",))
    rows = spark.range(1200).select(F.sha2(F.col("id").cast("string"), 256).alias("KEY"), (F.col("id") % 12).cast("int").alias("month"))
    L.incremental_insert(rows, target, "KEY", create_if_missing=True, schema=rows.schema, partition_col="month")
    one = rows.where("month = 3")
    assert L.incremental_insert(one, target, "KEY", partition_col="month").rows_written == 0
    current = L.read_target(spark, L.resolve_target(target, rows.schema))
    months = one.select(F.col("month").alias("_part")).distinct()
    probe = current.join(F.broadcast(months), F.col("month").eqNullSafe(F.col("_part")), "left_semi")
    assert probe.count() == 100
    assert L.read_target(spark, L.resolve_target(target, rows.schema)).count() == 1200


def test_dedupe_of_rows_that_differ_needs_an_order(spark):
    spec = make_spec("t", "K", [("a", "A", "string"), ("b", "B", "string")], hash_cols=("A",))
    src = spark.createDataFrame([("x", "2"), ("x", "1"), ("y", None)], "a string, b string")
    job = P.IngestJob(spec, lambda: src, L.Target(path=work_path(spark, "test", "dd")))
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True, dedupe=True)
    with pytest.raises(ValueError, match="order_cols"):
        P.ingest_table(spark, job, opts)
    opts.order_cols = ("B",)
    P.ingest_table(spark, job, opts)
    assert sorted((r["A"], r["B"]) for r in L.read_target(spark, job.target).collect()) == [("x", "1"), ("y", None)]


def test_failed_table_is_logged_before_the_error(spark):
    from sluice.plans import runlog

    log = work_path(spark, "test", "fail_log")
    root = work_path(spark, "test", "fail")

    def jobs():
        good = lambda: spark.read.parquet(f"{SF001}/orders.parquet")
        bad = lambda: spark.read.parquet(f"{SF001}/absent.parquet")
        return [P.IngestJob(tpch.orders_spec(), good, L.Target(path=f"{root}/o")),
                P.IngestJob(tpch.customer_spec(), bad, L.Target(path=f"{root}/c"))]

    for parallel in (1, 2):
        with pytest.raises(Exception, match="absent"):
            P.ingest_tables(spark, jobs(), P.IngestOptions(as_of=AS_OF, create_if_missing=True), run_log=log, max_parallel=parallel)
    rows = runlog.read_run_log(spark, log).select("table", "status").collect()
    assert sorted(map(tuple, rows)) == [("customer", "failed")] * 2 + [("orders", "ok")] * 2


def test_sync_passes_writer_options(spark):
    path = work_path(spark, "test", "sync_opts")
    job = P.SyncJob("n", lambda: spark.range(5), path, options={"compression": "gzip"})
    assert P.sync_tables(spark, [job], audit=tpch.AUDIT, as_of=AS_OF)[0].status == "ok"
    assert any(f.endswith(".gz.parquet") for f in os.listdir(bare(path)))
