"""Checked queries on loads that read little of their target."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from sluice.operators import load as L
from sluice.operators.keydiff import key_diff
from sluice.plans.replay import replay_rejects
from sluice.plans.tpch_queries import (
    AS_OF, ORDERS_CONFORMED_SQL, SQL_LINEITEM_INGEST, Query, dirty_lineitem, ntz, orders_conformed, read,
)
from sluice.operators import conform as C
from sluice.plans import ingest as P
from sluice.session import work_path
from sluice.specs import tpch

#: Orders with a key below this share of the largest are loaded a second time.
OLD_SHARE = 100


def changed_orders(spark, sf_dir):
    """Every order at another price: rows that the target does not hold."""
    orders = read(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1000000.0))
    return C.conform(orders, tpch.orders_spec(), AS_OF)


CHANGED_SQL = ORDERS_CONFORMED_SQL.replace("FROM orders", "FROM (SELECT * REPLACE (o_totalprice + 1000000.0 AS o_totalprice) FROM orders) o")


def q_sketched_insert(spark, sf_dir):
    """A batch of new orders and one in a hundred loaded before: only the files that hold those are read."""
    target = L.Target(path=work_path(spark, "queries", "sketched"), sketch=True)
    spec = tpch.orders_spec()
    first = orders_conformed(spark, sf_dir)
    L.create_target(spark, target, spec.schema)
    L.append_table(first.repartitionByRange(40, F.col("ORDER_KEY")), target)
    newest = first.agg((F.max("ORDER_KEY") / OLD_SHARE).alias("m")).first()["m"]
    batch = changed_orders(spark, sf_dir).unionByName(first.where(F.col("ORDER_KEY") <= newest))
    res = L.incremental_insert(batch, target, spec.key_col)
    again = L.incremental_insert(batch, target, spec.key_col)
    return ntz(L.read_target(spark, target)).select(
        "STG_ORDERS_KEY", "ORDER_KEY", "TOTAL_PRICE", F.lit(10 * res.files_read <= res.files_total).alias("under_a_tenth_read"),
        F.lit(again.rows_written).cast("long").alias("written_again"),
    )


SQL_SKETCHED = f"""
SELECT STG_ORDERS_KEY, ORDER_KEY, TOTAL_PRICE, true AS under_a_tenth_read, CAST(0 AS BIGINT) AS written_again
FROM ({ORDERS_CONFORMED_SQL} UNION ALL {CHANGED_SQL}) t"""

def q_key_diff(spark, sf_dir):
    """Orders against a target that lacks some, holds some at another price and some twice."""
    source = orders_conformed(spark, sf_dir)
    number = F.col("ORDER_KEY")
    target = (
        source.where(number % 97 != 0).unionByName(changed_orders(spark, sf_dir).where(number % 89 == 0))
        .unionByName(source.where((number % 83 == 0) & (number % 97 != 0)))
    )
    return key_diff(source, target, tpch.orders_spec().key_col)


SQL_KEY_DIFF = f"""
SELECT STG_ORDERS_KEY AS key, CAST(1 AS BIGINT) AS source_rows, CAST(0 AS BIGINT) AS target_rows, 'missing' AS status
FROM ({ORDERS_CONFORMED_SQL}) o WHERE ORDER_KEY % 97 = 0
UNION ALL
SELECT STG_ORDERS_KEY, 0, 1, 'extra' FROM ({CHANGED_SQL}) c WHERE ORDER_KEY % 89 = 0
UNION ALL
SELECT STG_ORDERS_KEY, 1, 2, 'repeated' FROM ({ORDERS_CONFORMED_SQL}) o WHERE ORDER_KEY % 83 = 0 AND ORDER_KEY % 97 <> 0"""


def q_replayed_once(spark, sf_dir):
    """Orders in three batches, two of which crash: after the commit but before the log, and before the commit."""
    spec = tpch.orders_spec()
    target = L.Target(path=work_path(spark, "queries", "ledger"), versioned=True)
    L.create_target(spark, target, spec.schema)
    orders = read(spark, sf_dir, "orders")
    reads = []

    def source(k):
        def rows():
            reads.append(k)
            return orders.where(F.col("o_orderkey") % 3 == k)
        return rows

    def run(k):
        opts = P.IngestOptions(mode="append", as_of=AS_OF, epoch=f"batch-{k}")
        return P.ingest_table(spark, P.IngestJob(spec, source(k), target), opts)

    run(0)  # ... and the driver dies before its log
    lost = C.conform(source(1)(), spec, AS_OF)
    lost.write.parquet(f"{target.path}/data/lost")  # written, never published
    replays = [run(k).status for k in (0, 1, 2, 1)]
    return ntz(L.read_target(spark, target)).select(
        "STG_ORDERS_KEY", "ORDER_KEY", "ORDER_DATE", F.lit(",".join(replays)).alias("replays"),
        F.lit(len(reads)).alias("sources_read"),
    )


SQL_REPLAYED = f"""
SELECT STG_ORDERS_KEY, ORDER_KEY, ORDER_DATE, 'replayed,ok,ok,replayed' AS replays, 4 AS sources_read
FROM ({ORDERS_CONFORMED_SQL}) t"""


def q_version_pointer(spark, sf_dir):
    """Orders, more orders and a reload: each version's rows, and a frame opened before the reload."""
    spec = tpch.orders_spec()
    target = L.Target(path=work_path(spark, "queries", "versions"), versioned=True)
    L.create_target(spark, target, spec.schema)
    first = orders_conformed(spark, sf_dir)
    L.append_table(first.where("ORDER_KEY % 2 = 0"), target)
    L.incremental_insert(first, target, spec.key_col)
    pinned = L.read_target(spark, target)
    L.reload_table(changed_orders(spark, sf_dir), target)
    seen = [L.read_target(spark, replace(target, version=n)).withColumn("seen", F.lit(str(n))) for n in range(4)]
    seen += [L.read_target(spark, target).withColumn("seen", F.lit("latest")), pinned.withColumn("seen", F.lit("pinned"))]
    rows = seen[0]
    for frame in seen[1:]:
        rows = rows.unionByName(frame)
    return rows.groupBy("seen").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("STG_ORDERS_KEY").alias("n_keys"),
        F.round(F.sum(F.col("TOTAL_PRICE").cast("decimal(20,2)")), 2).cast("double").alias("total"),
    )


SQL_VERSIONS = f"""
SELECT seen, count(*) AS n_rows, count(DISTINCT STG_ORDERS_KEY) AS n_keys,
       CAST(sum(CAST(TOTAL_PRICE AS DECIMAL(20,2))) AS DOUBLE) AS total
FROM (
  SELECT '1' AS seen, * FROM ({ORDERS_CONFORMED_SQL}) a WHERE ORDER_KEY % 2 = 0
  UNION ALL SELECT s.seen, a.* FROM ({ORDERS_CONFORMED_SQL}) a, (VALUES ('2'), ('pinned')) s(seen)
  UNION ALL SELECT s.seen, a.* FROM ({CHANGED_SQL}) a, (VALUES ('3'), ('latest')) s(seen)) t
GROUP BY seen"""


def q_reject_replay(spark, sf_dir):
    """Lineitem under a strict contract, then its rejects replayed twice under a looser one: a clean load's rows."""
    root = work_path(spark, "queries", "reject_replay")
    target, rejects, settled = (L.Target(path=f"{root}/{x}") for x in ("good", "bad", "settled"))
    source = dirty_lineitem(spark, sf_dir)
    strict = P.IngestJob(tpch.lineitem_spec(strict_quantity=True), lambda: source, target, rejects)
    P.ingest_table(spark, strict, P.IngestOptions(as_of=AS_OF, create_if_missing=True, reject_unparseable=True))
    job = replace(strict, spec=tpch.lineitem_spec())
    opts = P.IngestOptions(as_of=AS_OF)
    first = replay_rejects(spark, job, opts, source.schema, settled)
    again = replay_rejects(spark, job, opts, source.schema, settled)
    return ntz(L.read_target(spark, target)).select(
        "*", F.lit(first.still_open).cast("long").alias("still_open"), F.lit(again.opened).cast("long").alias("opened_again")
    )


SQL_REJECT_REPLAY = f"""
SELECT *, CAST(0 AS BIGINT) AS still_open, CAST(0 AS BIGINT) AS opened_again FROM ({SQL_LINEITEM_INGEST}) t"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "sketched_insert": (q_sketched_insert, SQL_SKETCHED),
    "key_diff": (q_key_diff, SQL_KEY_DIFF),
    "replayed_once": (q_replayed_once, SQL_REPLAYED),
    "reject_replay": (q_reject_replay, SQL_REJECT_REPLAY),
    "version_pointer": (q_version_pointer, SQL_VERSIONS),
}
