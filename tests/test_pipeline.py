"""Batch pipelines: sync, ingest of several tables, error isolation, run log."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import conform as C
from sluice.operators import load as L
from sluice.operators.counts import reconcile, table_counts
from sluice.plans import ingest as P
from sluice.plans import runlog
from sluice.session import work_path
from sluice.sources import jdbc, raw
from sluice.spec import make_spec
from sluice.specs import tpch

from conftest import AS_OF, SF001


def orders(spark):
    return spark.read.parquet(f"{SF001}/orders.parquet")


def test_ingest_tables_continue_and_stop(spark):
    root = work_path(spark, "test", "batch")
    good = P.IngestJob(tpch.orders_spec(), lambda: orders(spark), L.Target(path=f"{root}/orders"))
    bad = P.IngestJob(tpch.customer_spec(), lambda: spark.read.parquet(f"{root}/nope"),
                      L.Target(path=f"{root}/customer"))
    log = f"{root}/log"
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True)
    recs = P.ingest_tables(spark, [bad, good], opts, on_error="continue", run_log=log)
    assert [r.status for r in recs] == ["failed", "ok"]
    assert recs[1].rows_written == orders(spark).count()
    with pytest.raises(Exception):
        P.ingest_tables(spark, [bad, good], opts, on_error="stop")
    recs = P.ingest_tables(spark, [bad, good], opts, enabled={"orders": True}, run_log=log)
    assert [r.status for r in recs] == ["skipped", "ok"] and recs[1].rows_written == 0
    latest = {r["table"]: r for r in runlog.latest_runs(runlog.read_run_log(spark, log)).collect()}
    assert latest["orders"]["rows_written"] == 0 and "customer" not in latest


def test_parallel_tables_and_staging(spark):
    root = work_path(spark, "test", "parallel")
    jobs = [P.IngestJob(tpch.orders_spec(), lambda: orders(spark), L.Target(path=f"{root}/o{i}"))
            for i in range(3)]
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True, stage=True)
    recs = P.ingest_tables(spark, jobs, opts, max_parallel=3)
    n = orders(spark).count()
    assert [r.rows_written for r in recs] == [n, n, n]


def test_rejects_go_to_their_own_target(spark):
    from sluice.plans.tpch_queries import dirty_lineitem
    root = work_path(spark, "test", "rejects")
    job = P.IngestJob(tpch.lineitem_spec(strict_quantity=True), lambda: dirty_lineitem(spark, SF001),
                      L.Target(path=f"{root}/t"), reject_target=L.Target(path=f"{root}/r"))
    rec = P.ingest_table(spark, job, P.IngestOptions(as_of=AS_OF, create_if_missing=True))
    total = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    rejected = L.read_target(spark, job.reject_target).count()
    assert rec.rows_rejected == rejected > 0
    assert rec.rows_written + rejected == rec.rows_in == total


def test_sync_overwrites_and_refuses_self_overwrite(spark):
    path = work_path(spark, "test", "raw")
    job = P.SyncJob("orders", lambda: orders(spark), path)
    for _ in range(2):
        rec = P.sync_tables(spark, [job], audit=tpch.AUDIT, as_of=AS_OF)[0]
        assert rec.status == "ok"
    back = raw.read_raw(spark, path)
    assert back.count() == orders(spark).count()
    assert "ETL_CREATED_DATE" in back.columns
    with pytest.raises(ValueError, match="refusing"):
        raw.write_raw(raw.read_raw(spark, path), path)
    failing = P.SyncJob("gone", lambda: spark.read.parquet(path + "-missing"), path + "-x")
    assert P.sync_tables(spark, [failing], audit=tpch.AUDIT)[0].status == "failed"


def test_raw_text_formats(spark):
    path = work_path(spark, "test", "csv")
    spark.createDataFrame([("1", 'multi\nline')], "a string, b string").write.option("header", "true") \
        .csv(path)
    back = raw.read_raw(spark, path, "csv", multi_line=True)
    assert back.count() == 1 and back.first()["b"] == "multi\nline"


def test_counts_and_reconcile(spark):
    o = orders(spark)
    tc = {r["table_name"]: r["n_rows"] for r in table_counts({"orders": o, "half": o.limit(10)}).collect()}
    assert tc == {"orders": o.count(), "half": 10}
    r = reconcile(o, o.filter("o_orderstatus = 'F'"), "o_orderkey", "orders").first()
    nf = o.filter("o_orderstatus = 'F'").count()
    assert (r["source_rows"], r["target_rows"], r["missing_in_target"]) == (o.count(), nf, o.count() - nf)


def test_jdbc_name_guard():
    assert jdbc.parse_table_name('public."LeadAssignment"') == ("public", '"LeadAssignment"')
    assert jdbc.parse_table_name('"a.b"."c""d"') == ('"a.b"', '"c""d"') and jdbc.bare_name('"c""d"') == 'c"d'
    assert jdbc.parse_table_name("lead") == ("public", "lead")
    assert jdbc.parse_table_name("s.t.u") == ("s.t", "u")
    for bad in ("lead; drop table x", "", "a..b", '"open', "a.", "a b", "a.b.c.d"):
        with pytest.raises(ValueError):
            jdbc.parse_table_name(bad)
    assert raw.raw_path("s3://b/base/", "RAW", "db", 'public."lead_xref"') == "s3://b/base/RAW/db/lead_xref"


def test_extraction_time_survives_the_ingest_stamp(spark):
    from sluice.operators.conform import conform
    from sluice.spec import make_spec

    path = work_path(spark, "test", "raw_extracted")
    P.sync_tables(spark, [P.SyncJob("orders", lambda: orders(spark), path)], audit=tpch.AUDIT,
                  as_of="2024-01-01 00:00:00")
    spec = make_spec("o", "K", [("o_orderkey", "ID", "decimal(38,0)")], extracted_col="EXTRACTED_AT")
    out = conform(raw.read_raw(spark, path), spec, AS_OF).select(
        F.col("EXTRACTED_AT").cast("string").alias("x"), F.col("ETL_CREATED_DATE").cast("string").alias("c"))
    r = out.first()
    assert r["x"] == "2024-01-01 00:00:00" and r["c"] == "2024-06-01 12:00:00"
    assert spec.target_columns[-6] == "EXTRACTED_AT" and "EXTRACTED_AT" not in spec.key_inputs()


def test_dynamic_partition_overwrite(spark):
    path = work_path(spark, "test", "raw_parts")
    o = orders(spark).select("o_orderkey", "o_orderstatus")
    raw.write_raw(o, path, partition_by=("o_orderstatus",))
    raw.write_raw(o.filter("o_orderstatus = 'F'").limit(3), path, partition_by=("o_orderstatus",),
                  dynamic_partitions=True)
    back = raw.read_raw(spark, path)
    assert back.filter("o_orderstatus = 'F'").count() == 3
    assert back.filter("o_orderstatus = 'O'").count() == o.filter("o_orderstatus = 'O'").count()


def test_rows_are_rebalanced_only_when_asked(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "Rebalance" in plan(raw.spread(orders(spark)))
    target = L.Target(path=work_path(spark, "test", "rebalance"))
    job = P.IngestJob(tpch.orders_spec(), lambda: orders(spark), target)
    for rebalance in (False, True):
        rec = P.ingest_table(spark, job, P.IngestOptions(as_of=AS_OF, create_if_missing=True, rebalance=rebalance))
        assert rec.rows_in == orders(spark).count()


def test_run_log_residue_matches_schema_report(spark):
    import json as _json

    from sluice.operators.conform import schema_report
    from sluice.plans.tpch_queries import dirty_lineitem

    root = work_path(spark, "test", "residue")
    spec = tpch.lineitem_spec()
    job = P.IngestJob(spec, lambda: dirty_lineitem(spark, SF001), L.Target(path=f"{root}/t"))
    log = f"{root}/log"
    rec = P.ingest_tables(spark, [job], P.IngestOptions(as_of=AS_OF, create_if_missing=True), run_log=log)[0]
    residue = _json.loads(rec.residue)
    report = {r["column"]: r["n_unparseable"]
              for r in schema_report(dirty_lineitem(spark, SF001), spec, AS_OF).collect() if r["n_unparseable"]}
    assert residue == report and residue  # e.g. QUANTITY 'n/a', '+5'; SHIP_DATE 'n/a'; broken META
    assert rec.rows_rejected == 0 and rec.rows_written == rec.rows_in  # reported, not rejected
    logged = runlog.latest_runs(runlog.read_run_log(spark, log)).first()
    assert _json.loads(logged["residue"]) == residue


def test_json_raw_keeps_corrupt_records(spark):
    import os

    path = work_path(spark, "test", "json_raw")
    local = path.split(":", 1)[-1] if path.startswith("file:") else path
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "part.json"), "w") as fh:
        fh.write('{"leadguid": "g1", "age": "40"}\n{"leadguid": "g2", \n{"leadguid": "g3", "age": "x"}\n')
    back = raw.read_raw(spark, path, "json", corrupt_col="_corrupt").cache()
    assert back.count() == 3
    assert back.filter("_corrupt IS NOT NULL").count() == 1


def test_lead_sync_jobs_shape(spark):
    from sluice.plans.lead import lead_sync_jobs, warehouse_table

    jobs = lead_sync_jobs(spark, "jdbc:x://h/db", "abfss://c@a/base", "RAW", "db", partition_column="id")
    assert [j.name for j in jobs] == ["leadassignment", "leadxref", "lead"]
    assert [j.raw_path for j in jobs] == [f"abfss://c@a/base/RAW/db/{n}" for n in ("leadassignment", "leadxref", "lead")]
    assert warehouse_table("lead_xref") == "STG_LEAD_XREF"
    assert warehouse_table("lead", "stage", prefix="W_") == "stage.W_LEAD"


def test_sync_into_daily_partitions(spark):
    from pyspark.sql import functions as F

    path = work_path(spark, "test", "raw_daily")
    day1 = orders(spark).limit(5).withColumn("extract_day", F.lit("2024-06-01"))
    day2 = orders(spark).limit(3).withColumn("extract_day", F.lit("2024-06-02"))
    for frame in (day1, day2, day2):  # re-running a day replaces only that day
        job = P.SyncJob("orders", lambda f=frame: f, path, partition_by=("extract_day",), dynamic_partitions=True)
        assert P.sync_tables(spark, [job], audit=tpch.AUDIT, as_of=AS_OF)[0].status == "ok"
    counts = {str(r["extract_day"]): r["n"] for r in raw.read_raw(spark, path).groupBy("extract_day")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"2024-06-01": 5, "2024-06-02": 3}


def test_parallel_sync_with_run_log(spark):
    root = work_path(spark, "test", "psync")
    names = ("orders", "customer", "nation")
    jobs = [P.SyncJob(n, lambda n=n: spark.read.parquet(f"{SF001}/{n}.parquet"), f"{root}/{n}") for n in names]
    recs = P.sync_tables(spark, jobs, audit=tpch.AUDIT, as_of=AS_OF, run_log=f"{root}/log", max_parallel=3)
    assert [r.table for r in recs] == list(names) and all(r.status == "ok" for r in recs)
    for n, r in zip(names, recs):
        assert r.rows_written == spark.read.parquet(f"{SF001}/{n}.parquet").count() == raw.read_raw(
            spark, f"{root}/{n}").count()
    assert runlog.read_run_log(spark, f"{root}/log").count() == 3


def test_lenient_option_through_the_pipeline(spark):
    from sluice.spec import make_spec

    root = work_path(spark, "test", "lenient_pipe")
    spec = make_spec("t", "K", [("a", "A", "timestamp")])
    src = spark.createDataFrame([("March 2024",), ("2024-03-10 00:00:00",)], "a string")
    for lenient, expect_null in ((False, 1), (True, 0)):
        t = L.Target(path=f"{root}/{lenient}")
        job = P.IngestJob(spec, lambda: src, t)
        rec = P.ingest_table(spark, job, P.IngestOptions(as_of=AS_OF, create_if_missing=True, lenient=lenient))
        assert rec.rows_written == 2
        assert L.read_target(spark, t).filter("A IS NULL").count() == expect_null


def test_staged_rows_are_kept_without_the_digest_of_their_values(spark, monkeypatch):
    """... and loaded with the key they would have had; a clamped value keeps its digest."""
    rows = [("a", "2024-01-02 03:04:05", 1.5), ("b", "2031-01-02", -0.0), ("c", None, None), ("d", "x1234", 2.0)]
    raw = spark.createDataFrame(rows, "id string, at string, v double")
    kept = []
    monkeypatch.setattr(P, "remove_folder", lambda s, path: kept.append(path))
    for policy, keyless in (("keep", True), ("clamp", False), ("null", False)):
        spec = make_spec("t", "K", [("id", "ID", "string"), ("at", "AT", "timestamp"), ("v", "V", "double")],
                         future_policy={"AT": policy}, audit=None)
        root = work_path(spark, "test", "keyless")
        job = P.IngestJob(spec, lambda: raw, L.Target(path=f"{root}/good"), L.Target(path=f"{root}/bad"))
        P.ingest_table(spark, job, P.IngestOptions(as_of=AS_OF, create_if_missing=True, reject_unparseable=True))
        assert ("K" not in spark.read.parquet(kept[-1]).columns) is keyless
        want = {r["ID"]: r["K"] for r in C.conform(raw, spec, AS_OF).collect()}
        got = L.read_target(spark, job.target).select("ID", "K").collect() + L.read_target(spark, job.reject_target).select("ID", "K").collect()
        assert {r["ID"]: r["K"] for r in got} == want and len(got) == 4
