"""Execution helpers shared by all operators.

* ``materialize`` cuts lineage of an intermediate table with a reliable
  ``checkpoint()`` into the cluster's shared ``spark.checkpoint.dir``.  It
  survives the loss of executors, and it truncates the logical plan, which
  level-wise loops would otherwise re-analyse at ever greater length.  Spark
  deletes the files with the table's last reference when
  ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
* ``fits_broadcast`` says whether a table is proven small enough, in bytes, to
  be sent to every task; callers join it by a plain join otherwise.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Largest table, in bytes of its values, that an operator broadcasts on its own.
BROADCAST_BYTES = 8 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    The cluster's ``spark.checkpoint.dir`` (or a folder set on the context) is
    used as is.  Only a ``local[...]`` session without one -- a single machine,
    e.g. tests -- gets a fresh temporary folder; a cluster without a shared
    folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="entrotree-ck-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage.

    A checkpointed table does not report its partitioning to later plans.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def value_bytes(df: DataFrame):
    """Aggregate column: bytes of the values of a flat table."""
    sizes = [F.coalesce(F.octet_length(c).cast("long"), F.lit(0)) + 16 if kind in ("string", "binary")
             else F.lit(8).cast("long") for c, kind in df.dtypes]
    return F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True if the values of ``df`` take at most ``limit`` bytes (one aggregate)."""
    return df.agg(value_bytes(df)).first()[0] <= limit


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, marked to be broadcast if it fits.

    A join with one row a node needs the mark: planned by node, it would give the
    task of the root all rows, and adaptive execution keeps it so, as most
    partitions of the small side are empty.
    """
    return F.broadcast(df) if fits_broadcast(df) else df


def global_sum(df: DataFrame, value: Column, *order: Column, name: str) -> DataFrame:
    """Add the running sum of ``value`` over the whole table in ``order``, this row included.

    No one-task window: rows are range-partitioned and summed within their
    partition; the driver reads one total per partition.
    """
    dealt = materialize(df.withColumn("_value", value).repartitionByRange(*order)
                        .withColumn("_part", F.spark_partition_id()))
    before, offsets = 0, []
    for part, total in sorted(dealt.groupBy("_part").agg(F.sum("_value")).collect()):
        offsets += [F.lit(part), F.lit(before).cast("long")]
        before += total
    offset = F.element_at(F.create_map(*offsets), F.col("_part")) if offsets else F.lit(0)
    window = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn(name, (F.sum("_value").over(window) + offset).cast("long")).drop("_part", "_value")
