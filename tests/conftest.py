import sys
import tempfile

import pytest
from locations import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sigflow.session import BASE_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").appName("sigflow-tests")
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = "8"
    for k, v in conf.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only when the cluster names none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sigflow-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test."""
    return tempfile.mkdtemp(prefix="sigflow-test-")
