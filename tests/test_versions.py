"""Versioned targets: pinned readers, lost races, replays, crashes; corrupt records in streams."""

import threading

import pytest
from pyspark.sql import functions as F

from sluice.operators import load as L
from sluice.operators import versions as V
from sluice.plans import ingest as P
from sluice.session import work_path
from sluice.spec import make_spec
from sluice.streaming.incremental import batch_loader, start_incremental_stream

from conftest import AS_OF


def rows(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("KEY"), "id")


def target(spark):
    t = L.Target(path=work_path(spark, "test", "versions"), versioned=True)
    L.create_target(spark, t, rows(spark, 0, 1).schema)
    return t


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_reader_keeps_its_version_and_never_misses_the_table(spark):
    t = target(spark)
    L.append_table(rows(spark, 0, 100), t)
    pinned, stop, seen, wrong = L.read_target(spark, t), threading.Event(), set(), []

    def read_on():
        while not stop.is_set():
            try:
                seen.add(L.read_target(spark, t).count())
            except Exception as exc:  # noqa: BLE001
                wrong.append(exc)

    reader = threading.Thread(target=read_on)
    reader.start()
    for k in range(4):
        L.reload_table(rows(spark, 0, 200 + k), t)
    stop.set()
    reader.join()
    assert not wrong and seen <= {100, 200, 201, 202, 203} and ids(pinned) == list(range(100))
    old = L.Target(path=t.path, versioned=True, version=1)
    assert ids(L.read_target(spark, old)) == list(range(100)) and V.numbers(spark, t.path) == list(range(6))


def test_reload_may_read_its_own_target(spark):
    t = target(spark)
    L.append_table(rows(spark, 0, 10), t)
    L.reload_table(L.read_target(spark, t).where("id > 6"), t)
    assert ids(L.read_target(spark, t)) == [7, 8, 9]


def test_a_lost_race_is_published_after_the_winner(spark):
    t = target(spark)
    tries = []

    def slow(s, root, version):
        if not tries:  # another load publishes the same number first
            tries.append(version.number)
            V.commit(rows(s, 50, 60), root)
        return V._publish(s, root, version)

    done = V.commit(rows(spark, 0, 5), t.path, publish=slow)
    assert (tries, done.number) == ([1], 2)
    assert ids(L.read_target(spark, t)) == [*range(5), *range(50, 60)]


def test_same_epoch_in_two_runs_lands_once(spark):
    t = target(spark)

    def slow(s, root, version):
        V.commit(rows(s, 0, 5), root, epoch="e")
        return V._publish(s, root, version)

    assert V.commit(rows(spark, 0, 5), t.path, epoch="e", publish=slow) is None
    assert ids(L.read_target(spark, t)) == list(range(5))


def test_replays_skip_without_reading(spark):
    t = target(spark)
    assert L.append_table(rows(spark, 0, 5), t, epoch="a").rows_written == 5
    for again in (L.append_table, L.reload_table):
        assert again(rows(spark, 0, 5), t, epoch="a").replayed
    assert L.incremental_insert(rows(spark, 0, 5), t, "KEY", epoch="a").replayed
    assert L.load(rows(spark, 3, 8), t, "KEY", "incremental_insert", epoch="b").rows_written == 3
    assert V.load_version(spark, t.path).epochs == ["a", "b"]
    with pytest.raises(ValueError, match="epochs"):
        L.append_table(rows(spark, 0, 1), L.Target(path="/x"), epoch="a")


def test_crash_before_publishing_leaves_nothing_visible(spark):
    t = target(spark)

    def die(*_):
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        V.commit(rows(spark, 0, 5), t.path, epoch="a", publish=die)
    assert ids(L.read_target(spark, t)) == [] and not V.committed(spark, t.path, "a")
    assert L.append_table(rows(spark, 0, 5), t, epoch="a").rows_written == 5
    assert len(V.vacuum(spark, t.path)) == 1 and ids(L.read_target(spark, t)) == list(range(5))
    assert V.vacuum(spark, t.path) == [] and V.numbers(spark, t.path) == [1]


def test_misuse_is_refused(spark):
    t = target(spark)
    with pytest.raises(ValueError, match="exists"):
        L.create_target(spark, t, rows(spark, 0, 1).schema)
    with pytest.raises(FileNotFoundError):
        V.read(spark, t.path, 9)
    with pytest.raises(ValueError, match="versioned"):
        L.Target(path="/x", versioned=True, partition_by=("a",))
    missing = L.Target(path=work_path(spark, "test", "none"), versioned=True)
    assert not L.target_exists(spark, missing)
    with pytest.raises(L.TargetMissingError):
        L.append_table(rows(spark, 0, 1), missing)


SPEC = make_spec("s", "S_KEY", [("id", "ID", "string"), ("n", "N", "decimal(38,0)")])


def test_replayed_stream_batch_is_skipped_by_its_number(spark):
    t = L.Target(path=work_path(spark, "test", "stream_versions"), versioned=True)
    log = work_path(spark, "test", "stream_log")
    load = batch_loader(SPEC, t, options=P.IngestOptions(as_of=AS_OF), run_log=log, stream_id="s1")
    batch = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, n string")
    load(batch, 0)
    load(batch, 0)
    load(spark.createDataFrame([("c", "3")], "id string, n string"), 1)
    assert sorted(r["ID"] for r in L.read_target(spark, t).collect()) == ["a", "b", "c"]
    status = [r["status"] for r in spark.read.parquet(log).orderBy("ended_at").collect()]
    assert status == ["ok", "replayed", "ok"] and V.load_version(spark, t.path).epochs == ["s1:0", "s1:1"]


def test_corrupt_records_of_a_stream_are_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": "a", "n": "1"}\n{"id": "b", \n{"id": "c", "n": "3"}\n')
    t = L.Target(path=work_path(spark, "test", "stream_corrupt"), versioned=True)
    rejects = L.Target(path=work_path(spark, "test", "stream_corrupt_rejects"))
    start_incremental_stream(
        spark, str(tmp_path / "in"), "id string, n string, _bad string", SPEC, t, fmt="json", corrupt_col="_bad",
        reject_target=rejects, options=P.IngestOptions(as_of=AS_OF), checkpoint_location=str(tmp_path / "ckpt"),
    ).awaitTermination()
    assert sorted(r["ID"] for r in L.read_target(spark, t).collect()) == ["a", "c"]
    assert ["format" in r["_reject_reason"] for r in L.read_target(spark, rejects).collect()] == [True]
