import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillpoint.session import BASE_CONF, ensure_checkpoint_dir

    b = (SparkSession.builder.master("local[4]").appName("tillpoint-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    # tests own their lineage-cut folder; a cluster session would bring one
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillpoint-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tillpoint-test-")
