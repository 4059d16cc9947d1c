"""JDBC reads: the options handed to Spark's JDBC source (no database is started)."""

from types import SimpleNamespace

from sluice.sources import jdbc


class Recorder:
    """Stands in for ``spark.read``: records format/options, returns canned rows."""

    def __init__(self, log, rows=None):
        self.log, self.rows, self.opts = log, rows, {}

    def format(self, fmt):
        self.opts["format"] = fmt
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(dict(self.opts))
        rows = self.rows
        return SimpleNamespace(first=lambda: rows, schema=None)


def fake_spark(log, rows=None, parallelism=8):
    return SimpleNamespace(read=None, sparkContext=SimpleNamespace(defaultParallelism=parallelism),
                           _log=log, _rows=rows)


def patch(monkeypatch, log, rows=None):
    monkeypatch.setattr(jdbc, "_reader", lambda spark, url, props, fs: Recorder(log, rows)
                        .format("jdbc").option("url", url).option("fetchsize", str(fs)))


def test_whole_table_read_is_one_query(monkeypatch):
    log = []
    patch(monkeypatch, log)
    jdbc.read_jdbc(fake_spark(log), "jdbc:x://h/db", 'public."lead"')
    assert log == [{"format": "jdbc", "url": "jdbc:x://h/db", "fetchsize": "10000", "dbtable": 'public."lead"'}]


def test_partitioned_read_fetches_bounds_by_query(monkeypatch):
    from pyspark.sql import Row

    log = []
    patch(monkeypatch, log, rows=Row(LO=1, HI=1000))
    jdbc.read_jdbc(fake_spark(log, parallelism=16), "jdbc:x://h/db", "leadxref", partition_column="id")
    bounds, read = log
    assert bounds["query"] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM public.leadxref"
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == \
        ("id", "1", "1000", "16")
    assert read["dbtable"] == "public.leadxref"


def test_given_bounds_skip_the_query(monkeypatch):
    log = []
    patch(monkeypatch, log)
    jdbc.read_jdbc(fake_spark(log), "u", "s.t", partition_column="k", lower_bound=0, upper_bound=9,
                   num_partitions=4)
    assert len(log) == 1 and log[0]["numPartitions"] == "4" and log[0]["dbtable"] == "s.t"


class Driver(Exception):
    """A Spark error with a Java cause that answers getSQLState."""

    def __init__(self, state):
        super().__init__("the database does not exist")
        self.java_exception = SimpleNamespace(getCause=lambda: SimpleNamespace(getSQLState=lambda: state))


def test_only_a_missing_table_is_absent(monkeypatch):
    import pytest

    def fail(state):
        def scan(*_, **__):
            raise Driver(state)
        return scan

    monkeypatch.setattr(jdbc, "query_scan", fail("42P01"))
    assert jdbc.jdbc_table_exists(None, "u", "lead") is False
    monkeypatch.setattr(jdbc, "query_scan", fail("28000"))  # the role does not exist
    with pytest.raises(Driver):
        jdbc.jdbc_table_exists(None, "u", "lead")


def test_query_scan_and_count(monkeypatch):
    log = []
    patch(monkeypatch, log)
    jdbc.query_scan(fake_spark(log), "u", "SELECT 1")
    jdbc.jdbc_count(fake_spark(log), "u", "lead")
    assert log[0]["query"] == "SELECT 1"
    assert log[1]["query"] == "SELECT COUNT(*) AS ROWS_ FROM public.lead"
