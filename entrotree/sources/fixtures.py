"""Labelled, binned views derived from the driver's parquet tables.

The given tables carry no tree-shaped label, so ``li_bins`` plants one (with
noise) on ``lineitem``; ``doc_bins`` joins documents to their quality label;
``ev_bins`` uses the event type as a five-way label.  Definitions are the
fixed ones of FIXTURES.md; each view reads only the columns it needs, so the
parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entrotree.operators.prep import equal_width_bins
from entrotree.runtime import materialize
from entrotree.sources.tables import read_table

LI_FEATURES = ["f0", "f1", "f2", "f3", "f4", "f5", "f6"]
DOC_FEATURES = ["lang", "source", "nb"]
EV_FEATURES = ["f0", "f1", "f2"]
URL_FEATURES = ["u", "lang"]


def li_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as seven binned features ``f0..f6``, key ``k`` and label ``y``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    binned = li.select(
        k.alias("k"),
        F.least(F.lit(6), F.floor((F.col("l_quantity") - 1) * 7 / 49)).cast("int").alias("f0"),
        F.least(F.lit(6), F.floor(F.col("l_discount") * 7 / 0.10)).cast("int").alias("f1"),
        F.least(F.lit(6), F.floor(F.col("l_tax") * 7 / 0.08)).cast("int").alias("f2"),
        (F.col("l_linenumber") - 1).cast("int").alias("f3"),
        F.when(F.col("l_returnflag") == "A", 0)
         .when(F.col("l_returnflag") == "N", 1).otherwise(2).cast("int").alias("f4"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).cast("int").alias("f5"),
        (F.year("l_shipdate") - 1995).cast("int").alias("f6"),
    )
    y0 = F.when(((F.col("f0") >= 3) & (F.col("f1") >= 2)) | (F.col("f2") >= 5), 1).otherwise(0)
    flip = F.pmod(F.col("k") * 7, F.lit(11)) == 0
    return binned.withColumn("y", F.when(flip, 1 - y0).otherwise(y0).cast("int"))


def doc_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: nominal ``lang``, ``source`` and binned length ``nb``.

    ``nb`` is an equal-width bin of ``n_chars`` over the labelled rows; it is
    cast to a string so that all three features share one value type.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    # Read twice (bounds, bins): joined once.  Planner and AQE choose the strategy.
    joined = materialize(docs.join(labels, "doc_id"))
    binned = equal_width_bins(joined, ["n_chars"], bins=7, suffix="_bin")
    return binned.select(
        F.col("doc_id").alias("k"), "lang", "source",
        F.col("n_chars_bin").cast("string").alias("nb"),
        F.col("quality").cast("int").alias("y"))


def ev_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: binned ``value``, hour of day and user bucket; label ``event_type``."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    binned = equal_width_bins(ev, ["value"], bins=7, suffix="_bin")
    return binned.select(
        F.col("event_id").alias("k"),
        F.col("value_bin").alias("f0"),
        F.hour("ts").cast("int").alias("f1"),
        F.pmod(F.col("user_id"), F.lit(7)).cast("int").alias("f2"),
        F.col("event_type").alias("y"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: nominal ``u`` (the URL without digits) and ``lang``, with a planted label.

    The values hold the characters that part node paths.
    """
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    y = F.when((F.octet_length("html") % 3 == 0) | F.contains("url", F.lit("=")), 1).otherwise(0)
    return pages.select(F.col("page_id").alias("k"), F.regexp_replace("url", "[0-9]+", "").alias("u"),
                        F.split_part(F.col("url"), F.lit("/"), F.lit(4)).alias("lang"), y.alias("y"))
