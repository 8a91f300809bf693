import os

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("netload-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    # TEST_CONF="key=value;key=value" runs the suite under other session settings.
    for pair in filter(None, os.environ.get("TEST_CONF", "").split(";")):
        builder = builder.config(*pair.split("=", 1))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def setting(spark):
    """Sets session options for one test and restores them."""
    saved = {}

    def apply(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield apply
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
