"""Loads survive failed tasks: retried attempts give the same rows, once."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import json, sys
sys.path.insert(0, ROOT)
from pyspark import TaskContext
from pyspark.sql import functions as F
from sluice.operators import conform as C, load as L
from sluice.session import build_session, work_path
from sluice.specs import tpch

spark = build_session("local[4,4]", extra={"spark.checkpoint.dir": CKPT})
spark.sparkContext.setLogLevel("OFF")
spec = tpch.orders_spec()
orders = spark.read.parquet(SF + "/orders.parquet").repartition(4)

@F.udf("string")
def flaky(v):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() in (0, 2):
        raise RuntimeError("injected task failure")
    return v

batch = C.conform(orders, spec, "2024-06-01 12:00:00").withColumn("STATUS", flaky(F.col("STATUS")))
target = L.Target(path=work_path(spark, "failures", "t"))
first = L.incremental_insert(batch, target, spec.key_col, create_if_missing=True, schema=spec.schema)
again = L.incremental_insert(batch, target, spec.key_col)
loaded = L.read_target(spark, target)
print(json.dumps({"first": first.rows_written, "again": again.rows_written, "rows": loaded.count(),
                  "keys": loaded.select(spec.key_col).distinct().count(), "source": orders.count()}))
'''


def test_incremental_insert_survives_task_failures():
    ckpt = tempfile.mkdtemp(prefix="sluice-fail-")
    code = SCRIPT.replace("ROOT", repr(ROOT)).replace("CKPT", repr(ckpt)) \
        .replace("SF +", repr("/root/testdata/sf0.001") + " +")
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-3000:]
    out = json.loads([line for line in res.stdout.splitlines() if line.startswith("{")][-1])
    assert out["first"] == out["rows"] == out["keys"] == out["source"]
    assert out["again"] == 0
