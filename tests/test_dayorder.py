"""Votes on the order of day and month."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.operators import conform as C
from sluice.operators import load as L
from sluice.plans.ingest import IngestJob, IngestOptions, ingest_table
from sluice.session import work_path
from sluice.spec import make_spec

from conftest import AS_OF

SPEC = make_spec("t", "K", [("a", "A", "date"), ("b", "B", "timestamp"), ("c", "C", "date"), ("d", "D", "date"), ("e", "E", "string")], audit=None)
ROWS = [("3/10/2023", "10:00 3-10-23", "13.1.2023", "4/4/2023", "31/1/2023"), ("25/10/2023", "10-25-23 8:00", "1.13.2023", "5/6/2023", "x"),
        (None, "", "2023-01-14", "Jan 15, 2023", None), ("99/99/2023", "2023-01-02 03:04:05", "no", "32/1/2023", "")]


def votes(spark, rows):
    got = C.date_votes(spark.createDataFrame(rows, "a string, b string, c string, d string, e string"), SPEC).collect()
    return {r["column"]: tuple(r)[1:] for r in got}


def test_votes(spark):
    assert votes(spark, ROWS) == {
        "A": (1, 0, 1, "day_first"), "B": (0, 1, 1, "month_first"), "C": (1, 1, 0, "conflict"), "D": (0, 0, 1, "undecided"),
    }
    assert votes(spark, []) == {c: (0, 0, 0, "undecided") for c in "ABCD"}


def test_typed_and_missing_columns_do_not_vote(spark):
    typed = spark.createDataFrame([(dt.date(2023, 1, 2), "1")], "a date, e string")
    assert C.date_votes(typed, SPEC).collect() == [] and C.day_first_columns(typed, SPEC) == set()


def test_ambiguous_cells_follow_the_vote(spark):
    raw = spark.createDataFrame(ROWS, "a string, b string, c string, d string, e string")
    target = L.Target(path=work_path(spark, "test", "votes"))
    ingest_table(spark, IngestJob(SPEC, lambda: raw, target), IngestOptions(as_of=AS_OF, create_if_missing=True, vote_dates=True))
    got = L.read_target(spark, target).where(F.col("E") == "31/1/2023").withColumn("B", F.col("B").cast("string")).first()
    assert got["A"] == dt.date(2023, 10, 3) and got["B"] == "2023-03-10 10:00:00" and got["D"] == dt.date(2023, 4, 4)
    report = {r["column"]: (r["reading"], r["issue"]) for r in C.schema_report(raw, SPEC, AS_OF, vote_dates=True).collect()}
    assert report["C"] == ("conflict", "day order") and report["A"] == ("day_first", "type") and report["E"] == (None, None)


def test_one_row_group_is_voted_on_and_read_by_many_tasks(spark):
    from sluice.plans.time_queries import q_date_column_vote

    plan = q_date_column_vote(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert plan.count("REPARTITION_BY_NUM") >= 3 and "o_orderkey" in plan and f", {n}), REPARTITION_BY_NUM" in plan
