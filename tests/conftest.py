from __future__ import annotations

import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)
# Python workers import the package too, wherever the tests are started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [REPO, os.environ.get("PYTHONPATH")]))

# A binned table (header 0..9,class) to check the golden numbers with, read in place.
GOLDEN_CSV = os.environ.get("ENTROTREE_GOLDEN_CSV", "")
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .appName("entrotree-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tests-ck-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    if not GOLDEN_CSV or not os.path.exists(GOLDEN_CSV):
        pytest.skip("ENTROTREE_GOLDEN_CSV is not set")
    from entrotree.sources.delimited import read_binned_csv
    return read_binned_csv(spark, GOLDEN_CSV).cache()


GOLDEN_FEATURES = [f"f{i}" for i in range(10)]


@pytest.fixture(scope="session")
def golden_tree(spark, golden):
    from entrotree.operators.grow import fit_id3
    return fit_id3(golden, GOLDEN_FEATURES, "y", 3)
