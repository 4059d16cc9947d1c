"""Replay of rejects: what passes, what stays open, repeated rows, crashes."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import load as L
from sluice.operators import conform as C
from sluice.plans import replay as R
from sluice.plans.ingest import IngestJob, IngestOptions, ingest_table
from sluice.session import work_path
from sluice.spec import make_spec

from conftest import AS_OF


def spec(kind="decimal(38,0)", nullable=False):
    return make_spec("t", "K", [("id", "ID", "decimal(38,0)"), ("n", "N", kind, nullable), ("at", "AT", "timestamp")], audit=None)


@pytest.fixture()
def job(spark):
    root = work_path(spark, "test", "replay")
    rows = [(1, "5", "2024-01-02"), (2, "x", "2024-01-02"), (2, "x", "2024-01-02"), (3, None, None), (4, 'a"\n,é', "2023-05-06 07:08:09")]
    raw = spark.createDataFrame(rows, "id int, n string, at string").withColumn("seen", F.lit(1.5)).withColumn("day", F.lit("2024-01-01").cast("date"))
    made = IngestJob(spec(), lambda: raw, L.Target(path=f"{root}/good"), L.Target(path=f"{root}/bad"))
    ingest_table(spark, made, IngestOptions(as_of=AS_OF, create_if_missing=True, reject_unparseable=True, mode="append"))
    return made, raw, L.Target(path=f"{root}/settled")


def loaded(spark, job):
    return sorted(tuple(r) for r in L.read_target(spark, job.target).select("ID", "N").collect())


def test_rows_pass_when_the_contract_takes_them(spark, job):
    made, raw, settled = job
    opts = IngestOptions(as_of=AS_OF, reject_unparseable=True)
    same = R.replay_rejects(spark, made, opts, raw.schema, settled)
    assert (same.opened, same.loaded, same.settled, same.still_open) == (3, 0, 0, 3)
    loose = R.replay_rejects(spark, IngestJob(spec(nullable=True), made.source, made.target, made.reject_target), opts, raw.schema, settled)
    assert (loose.loaded, loose.settled, loose.still_open) == (1, 1, 2)  # the null; text is no number still
    again = R.replay_rejects(spark, IngestJob(spec(nullable=True), made.source, made.target, made.reject_target),
                             IngestOptions(as_of=AS_OF), raw.schema, settled)
    assert (again.opened, again.loaded, again.still_open) == (2, 3, 0)
    assert [i for i, _ in loaded(spark, made)] == [1, 2, 2, 3, 4]
    none = R.replay_rejects(spark, made, opts, raw.schema, settled)
    assert (none.opened, none.loaded) == (0, 0)


def test_a_crash_before_the_marks_loads_nothing_twice(spark, job, monkeypatch):
    made, raw, settled = job
    loose = IngestJob(spec(nullable=True), made.source, made.target, made.reject_target)
    insert = L.incremental_insert

    def dies(df, target, key, **how):
        if target.path == settled.path:
            raise RuntimeError("lost")
        return insert(df, target, key, **how)

    monkeypatch.setattr(R.L, "incremental_insert", dies)
    with pytest.raises(RuntimeError):
        R.replay_rejects(spark, loose, IngestOptions(as_of=AS_OF), raw.schema, settled)
    monkeypatch.undo()
    before = loaded(spark, made)
    again = R.replay_rejects(spark, loose, IngestOptions(as_of=AS_OF), raw.schema, settled)
    assert (again.loaded, again.settled, again.still_open) == (0, 3, 0) and loaded(spark, made) == before


def test_one_row_set_aside_for_two_reasons_is_loaded_once(spark, job):
    made, raw, settled = job
    bad = L.read_target(spark, made.reject_target)
    twin = bad.withColumn(C.REASON_COL, F.lit("another")).withColumn("_reject_key", F.concat(F.lit("z"), "_reject_key"))
    L.append_table(twin, made.reject_target)
    loose = IngestJob(spec(nullable=True), made.source, made.target, made.reject_target)
    got = R.replay_rejects(spark, loose, IngestOptions(as_of=AS_OF), raw.schema, settled)
    assert (got.opened, got.loaded, got.still_open) == (3, 4, 0)
    assert L.read_target(spark, settled).count() == 6


def test_text_that_is_no_row_stays_open(spark, job):
    made, raw, settled = job
    broken = L.read_target(spark, made.reject_target).limit(1).withColumn(C.RAW_ROW_COL, F.lit("{oops")).withColumn("_reject_key", F.lit("q"))
    L.append_table(broken, made.reject_target)
    loose = IngestJob(spec(nullable=True), made.source, made.target, made.reject_target)
    got = R.replay_rejects(spark, loose, IngestOptions(as_of=AS_OF), raw.schema, settled)
    assert (got.opened, got.still_open) == (4, 1)
    with pytest.raises(ValueError):
        R.replay_rejects(spark, IngestJob(spec(), made.source, made.target), IngestOptions(), raw.schema, settled)


def test_rejects_of_a_rerun_are_compared_by_their_keys(spark, job, monkeypatch):
    made, raw, settled = job
    moved = []
    monkeypatch.setattr(L, "new_rows", lambda b, e, k, real=L.new_rows, **how: moved.append(k) or real(b, e, k, **how))
    monkeypatch.setattr(L, "LISTED_KEYS", 2)
    before = L.read_target(spark, made.reject_target).count()
    again = ingest_table(spark, made, IngestOptions(as_of=AS_OF, reject_unparseable=True))
    assert (again.rows_in, again.rows_written, again.rows_rejected) == (5, 0, 4) and moved == []
    assert L.read_target(spark, made.reject_target).count() == before == 4
