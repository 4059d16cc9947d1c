import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
AS_OF = "2024-06-01 12:00:00"
ZONE = "America/New_York"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="sluice-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="sluice-tests",
        time_zone=ZONE,
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sluice-wh-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def zone(spark):
    """Run a test in another session zone, then restore."""
    old = spark.conf.get("spark.sql.session.timeZone")

    def set_zone(z):
        spark.conf.set("spark.sql.session.timeZone", z)

    yield set_zone
    spark.conf.set("spark.sql.session.timeZone", old)


@pytest.fixture()
def ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")

    def set_ansi(on: bool):
        spark.conf.set("spark.sql.ansi.enabled", "true" if on else "false")

    yield set_ansi
    spark.conf.set("spark.sql.ansi.enabled", old)
