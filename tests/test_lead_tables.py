"""The three lead contracts: table-specific rules on a small raw fixture."""

import datetime as dt

from sluice.operators import conform as C
from sluice.operators import load as L
from sluice.plans import ingest as P
from sluice.plans.lead import lead_ingest_jobs, warehouse_table
from sluice.session import work_path
from sluice.spec import AuditSpec
from sluice.specs import lead_specs

from sluice.plans.tpch_queries import ntz

from conftest import AS_OF


def test_assignment_rules(spark):
    spec = lead_specs()["lead_assignment"]
    raw = spark.createDataFrame(
        [("a1", "2030-01-01 00:00:00", '{"k": 1}', "yes", "12.5", "2025-12-31 10:00:00"),
         ("a2", "2020-05-01 08:00:00", "{bad", "0", "n/a", "2031-01-01 00:00:00")],
        "leadassignmentguid string, purchasedate string, metadata string, isdeletedsource string, "
        "purchaseprice string, exclusivityenddate string")
    rows = {r["LEAD_ASSIGNMENT_GUID"]: r for r in ntz(C.conform(raw, spec, AS_OF)).collect()}
    a1, a2 = rows["a1"], rows["a2"]
    # 2030 is beyond year(as_of)+1: NULL; 2025-12-31 is within range but future: clamped
    assert a1["PURCHASE_DATE"] is None
    assert a1["EXCLUSIVITY_END_DATE"] == dt.datetime(2024, 6, 1, 12, 0)
    assert a2["PURCHASE_DATE"] == dt.datetime(2020, 5, 1, 8, 0)
    assert a1["METADATA"] == '{"k": 1}' and a2["METADATA"] is None
    assert a1["IS_DELETED_SOURCE"] is True and a2["IS_DELETED_SOURCE"] is False  # boolean here
    assert a1["PURCHASE_PRICE"] == 12.5 and a2["PURCHASE_PRICE"] is None
    assert a1["EDW_EXTERNAL_SOURCE_SYSTEM"] == "SOURCE_SYSTEM" and a1["TO_PROCESS"] is True


def test_lead_rules(spark):
    spec = lead_specs()["lead"]
    raw = spark.createDataFrame(
        [("g1", "t", '{"x": [1]}', "1,200", "02/29/2024", "no")],
        "LeadGuid string, IsDeletedSource string, LeadAttributes string, Age string, LoanDate string, "
        "SubSourceId string")
    r = C.conform(raw, spec, AS_OF).first()
    assert r["IS_DELETED_SOURCE"] == "TRUE"  # string column: token text
    assert r["LEAD_ATTRIBUTES"] == '{"x": [1]}'
    assert r["AGE"] == 1200 and r["LOAN_DATE"] == dt.date(2024, 2, 29) and r["SUB_SOURCE_ID"] is False
    assert r["COBORROWER_NAME"] is None  # unmapped in this extract: typed NULL
    assert len(r) == 101


def test_lead_jobs_end_to_end(spark):
    base = work_path(spark, "test", "lead_raw")
    spark.createDataFrame([("x1", "l1", "A", "2024-01-01 00:00:00")],
                          "leadxrefguid string, legacyleadid string, leadlevel string, createdate string") \
        .write.parquet(f"{base}/leadxref")
    spark.createDataFrame([("a1", "x1", "2024-01-02 00:00:00")],
                          "leadassignmentguid string, leadxrefguid string, assigndate string") \
        .write.parquet(f"{base}/leadassignment")
    spark.createDataFrame([("g1", "Ann")], "leadguid string, firstname string").write.parquet(f"{base}/lead")
    out = work_path(spark, "test", "lead_wh")
    jobs = lead_ingest_jobs(spark, base, lambda n: L.Target(path=f"{out}/{warehouse_table(n)}"))
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True)
    recs = P.ingest_tables(spark, jobs, opts)
    assert [r.table for r in recs] == ["lead_assignment", "lead_xref", "lead"]
    assert [r.rows_written for r in recs] == [1, 1, 1]
    again = P.ingest_tables(spark, jobs, opts)
    assert [r.rows_written for r in again] == [0, 0, 0]
    assert L.read_target(spark, jobs[2].target).first()["FIRST_NAME"] == "Ann"


def test_command_line_ingest(spark):
    import json
    import subprocess
    import sys

    base = work_path(spark, "test", "cli_raw")
    spark.createDataFrame([("x1", "l1")], "leadxrefguid string, legacyleadid string").write.parquet(f"{base}/leadxref")
    out = work_path(spark, "test", "cli_wh")
    ckpt = work_path(spark, "test", "cli_ckpt")
    cmd = [sys.executable, "-m", "sluice", "--master", "local[2]", "--as-of", AS_OF, "ingest",
           "--raw-base", base, "--target-base", out, "--write-mode", "incremental_insert",
           "--create-if-missing", "--tables", "lead_xref"]
    env = {"PYSPARK_SUBMIT_ARGS": f"--conf spark.checkpoint.dir={ckpt} pyspark-shell"}
    import os

    env = {**os.environ, **env}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run(cmd, cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    recs = [json.loads(line) for line in res.stdout.splitlines() if line.startswith("{")]
    assert [(r["table"], r["status"]) for r in recs] == [
        ("lead_assignment", "skipped"), ("lead_xref", "ok"), ("lead", "skipped")]
    assert recs[1]["rows_written"] == 1
    assert L.read_target(spark, L.Target(path=f"{out}/STG_LEAD_XREF")).count() == 1


def test_command_line_report(spark, capsys):
    import json

    from sluice.__main__ import main

    base = work_path(spark, "test", "report_raw")
    spark.createDataFrame([("x1", "2024-01-01", "maybe"), ("x2", "n/a", "yes")],
                          "leadxrefguid string, leveldate string, isdeletedsource string") \
        .write.parquet(f"{base}/leadxref")
    assert main(["--as-of", AS_OF, "report", "--raw-base", base, "--tables", "lead_xref"]) == 0
    rows = {r["column"]: r for r in map(json.loads, capsys.readouterr().out.splitlines())}
    assert rows["LEVEL_DATE"]["n_present"] == 2 and rows["LEVEL_DATE"]["n_unparseable"] == 1
    assert rows["LEAD_CODE"]["issue"] == "missing" and len(rows) == 12


def test_two_hop_sync_then_ingest(spark):
    from sluice.operators.counts import reconcile
    from sluice.plans.lead import lead_ingest_jobs, warehouse_table
    from sluice.plans import lead_oracle
    from sluice.plans.tpch_queries import read
    from sluice.sources.raw import raw_path
    from conftest import SF001

    base = work_path(spark, "test", "two_hop")

    def extract(listed, src, number, day):
        """A stand-in for one of the three source tables (JDBC in production)."""
        read(spark, SF001, src).createOrReplaceTempView(f"two_hop_{src}")
        rows = (f"SELECT {number} AS k, CAST({day} AS STRING) AS d, "
                f"CAST(CAST({day} + INTERVAL 27 YEARS AS DATE) AS STRING) AS f FROM two_hop_{src}")
        return lambda: spark.sql(lead_oracle.extract_sql(listed, rows))

    extracts = {
        'public."leadassignment"': extract(lead_oracle.LEAD_ASSIGNMENT, "lineitem", "l_orderkey * 10 + l_linenumber",
                                           "CAST(l_shipdate AS DATE)"),
        'public."leadxref"': extract(lead_oracle.LEAD_XREF, "orders", "o_orderkey", "CAST(o_orderdate AS DATE)"),
        'public."lead"': extract(lead_oracle.LEAD, "customer", "c_custkey", "DATE '1997-03-10'"),
    }
    jobs = [P.SyncJob(t.split(".")[1].strip('"'),
                      source, raw_path(base, "RAW", "db", t)) for t, source in extracts.items()]
    assert all(r.status == "ok" for r in P.sync_tables(spark, jobs, audit=AuditSpec(), as_of=AS_OF))

    out = work_path(spark, "test", "two_hop_wh")
    ingest = lead_ingest_jobs(spark, f"{base}/RAW/db", lambda n: L.Target(path=f"{out}/{warehouse_table(n)}"))
    opts = P.IngestOptions(mode="incremental_insert", as_of=AS_OF, create_if_missing=True)
    first = P.ingest_tables(spark, ingest, opts)
    again = P.ingest_tables(spark, ingest, opts)
    assert [r.status for r in first] == ["ok"] * 3 and [r.rows_written for r in again] == [0, 0, 0]
    for job, rec in zip(ingest, first):
        src = C.conform(job.source(), job.spec, AS_OF)
        row = reconcile(src, L.read_target(spark, job.target), job.spec.key_col).first()
        assert row["missing_in_target"] == 0 and row["target_rows"] == rec.rows_written > 0


def test_a_small_file_is_conformed_by_many_tasks(spark):
    from sluice.plans import tpch_queries as Q

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("lead_contract", "lead_xref_contract", "lead_assignment_contract"):
        rows = Q.QUERIES[name][0](spark, "/root/testdata/sf0.001")
        assert rows.rdd.getNumPartitions() == n, name


def test_a_contract_of_many_rows_takes_little_disk(spark, tmp_path):
    from sluice.plans import tpch_queries as Q

    def bytes_a_row(name):
        rows = Q.QUERIES["lead_assignment_contract"][0](spark, "/root/testdata/sf0.001")
        rows.write.parquet(str(tmp_path / name))
        files = list((tmp_path / name).glob("*.parquet"))
        return sum(f.stat().st_size for f in files) / rows.count(), files[0].name

    codec = "spark.sql.parquet.compression.codec"
    found = spark.conf.get(codec, None)
    try:
        spark.conf.unset(codec)
        size, file = bytes_a_row("unnamed")
        assert "zstd" in file and size < 190
        spark.conf.set(codec, "snappy")  # a codec the session names is kept
        size, file = bytes_a_row("named")
        assert "snappy" in file and size < 248
    finally:
        spark.conf.unset(codec) if found is None else spark.conf.set(codec, found)


def test_neighbours_by_key_stay_together_in_order(spark):
    from pyspark.sql import functions as F

    from sluice.sources.raw import spread_in_order

    rows = spread_in_order(spark.range(4000).select((F.col("id") * 1237 % 4000).alias("k")), "k")
    parts = [[r["k"] for r in part] for part in rows.rdd.glom().collect()]
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and all(parts)
    assert [k for part in sorted(parts) for k in part] == list(range(4000))
