from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from frames import F1_ROWS, SALES_DDL  # noqa: E402

from salesforge.session import ensure_checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 8, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sf-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only because none is configured here.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="sf-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sf-test-")


@pytest.fixture()
def f1(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(F1_ROWS, SALES_DDL)
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))
