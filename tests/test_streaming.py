"""The batch operators on Structured Streaming sources: a file stream scored and counted."""

from __future__ import annotations

import tempfile

from conftest import SF001

from entrotree.operators.counts import contingency
from entrotree.operators.grow import fit_id3
from entrotree.operators.metrics import confusion_counts
from entrotree.operators.score import predict
from entrotree.sources.fixtures import LI_FEATURES, li_bins


def test_stream_scoring_and_counts_equal_batch(spark):
    df = li_bins(spark, SF001)
    tree = fit_id3(df, LI_FEATURES, "y", 3)
    src = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp")
    df.repartition(3).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)

    scored = predict(stream, tree, LI_FEATURES)
    q1 = (confusion_counts(scored, "y").writeStream.outputMode("complete")
          .format("memory").queryName("conf_stream").start())
    q2 = (contingency(stream, LI_FEATURES, "y").writeStream.outputMode("complete")
          .format("memory").queryName("cont_stream").start())
    try:
        q1.processAllAvailable()
        q2.processAllAvailable()
    finally:
        q1.stop()
        q2.stop()

    batch = predict(df, tree, LI_FEATURES).groupBy("y", "prediction").count()
    want = {(r["y"], r["prediction"]): r["count"] for r in batch.collect()}
    got = {(r["actual"], r["predicted"]): r["n"] for r in spark.table("conf_stream").collect()}
    assert got == want

    want_c = {tuple(r) for r in contingency(df, LI_FEATURES, "y").collect()}
    got_c = {tuple(r) for r in spark.table("cont_stream").collect()}
    assert got_c == want_c


def test_stream_scoring_with_binary_tree(spark):
    from entrotree.operators.binary import fit_binary
    df = li_bins(spark, SF001)
    tree = fit_binary(df, LI_FEATURES, "y", 3)
    src = tempfile.mkdtemp(prefix="stream-bin-", dir="/tmp")
    df.repartition(2).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (predict(stream, tree, LI_FEATURES)
         .select("k", "y", "prediction")
         .writeStream.outputMode("append").format("memory").queryName("bin_stream").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = sorted(tuple(r) for r in predict(df, tree, LI_FEATURES).select("k", "y", "prediction").collect())
    got = sorted(tuple(r) for r in spark.table("bin_stream").collect())
    assert got == want
