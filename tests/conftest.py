import os
import sys
import tempfile
import datetime as dt

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradelake-ckpt-"))
    yield s


@pytest.fixture
def fx1(spark):
    """12-row monthly fixture of the reference's unit tests."""
    qt = [100, 150, 200, 80, 120, 90, 110, 140, 180, 95, 130, 105]
    rows = [(dt.date(2023, m + 1, 1), float(q), q * 10.0, q * 100.0, q * 5.0, q * 2.0) for m, q in enumerate(qt)]
    return spark.createDataFrame(
        rows, "date date, qt_stat double, kg_net double, fob_usd double, freight_usd double, insurance_usd double")


def d(s):
    return dt.date.fromisoformat(s)
