"""Execution helpers: checkpoint folder, size checks, running sums."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import entrotree.runtime as rt


def test_materialize_cuts_the_plan(spark):
    out = rt.materialize(spark.range(10))
    assert out.count() == 10
    # a checkpointed plan starts from the written RDD, not from the range
    assert "Range" not in out._jdf.queryExecution().analyzed().toString()


def test_a_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        rt.checkpoint_dir(Session())


def test_fits_broadcast_counts_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "s string, n int")
    assert rt.fits_broadcast(df, 1100) and not rt.fits_broadcast(df, 1000)
    assert rt.fits_broadcast(df.limit(0), 0)


def test_global_sum(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("k"), F.lit(2).alias("v"))
    got = rt.global_sum(df, F.col("v"), F.col("k"), name="s").collect()
    assert all(r["s"] == 2 * (r["k"] + 1) for r in got) and len(got) == 100
