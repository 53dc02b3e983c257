import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from locations import SF001  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("scholarmetrics-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only because none is configured.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sm-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001_tables(spark):
    from scholarmetrics.sources.fixtures import load_tables

    return load_tables(spark, SF001)


@pytest.fixture
def split_conf(spark):
    """Session settings under which the fixture's frequent keys count as hot."""
    from scholarmetrics.plans.compare import SPLIT_CONF

    old = {k: spark.conf.get(k, None) for k in SPLIT_CONF}
    for k, v in SPLIT_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
