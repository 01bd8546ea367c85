import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from acadlake.session import BASE_CONF, ensure_defaults
    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):      # tests only: a private folder
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="acadlake-test-"))
    ensure_defaults(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SMOKE
