"""Operator 9: mix sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to and
including it, in a keyed pseudo-random order, divided by the source's target.
Passing over a source again continues its clock.  Documents are served in the
global order of their finish times until the running sum of their words reaches
the budget.  The document a source has on the wire when its share ends is two
entries of that queue, cut there, so that a source's words equal its target up to
rounding.

Scale: only (doc_id, source, size) leaves the scan.  A source's running sum is
taken in two steps -- within 4,096 slices of the shuffle key, and over the
slice totals -- so a source that holds a third of all rows is spread over
4,096 groups.  The queue is sorted in ranges, and summed within them and over
their totals.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a null doc_id is an ordinary row; repeated rows each count; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import global_rank, global_sum, materialize, text_of, words

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
SEED = 9
SLICE_DIGITS = 3  # hexadecimal digits of the shuffle key that name a slice


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Sources in code point order (null last) take the weights in turn and share
    the total; a share above ``max_passes`` times the source is cut there and
    the excess shared by weight among the others until none is above.
    """
    turn = F.element_at(F.array(*map(F.lit, weights)),
                        ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = materialize(
        global_rank(totals, F.col("source").asc_nulls_last())
        .select("source", "source_size", turn.cast("long").alias("weight"),
                (F.col("source_size") * max_passes).alias("cap")))
    level, full = 0.0, -1
    while True:  # the capped set only grows: ends after at most one round per source
        over = F.col("weight") * F.lit(level) > F.col("cap")
        total, capped, n_capped, open_weight = ranked.agg(
            F.sum("source_size"), F.sum(F.when(over, F.col("cap")).otherwise(0)),
            F.sum(over.cast("int")), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if n_capped is None or n_capped == full or not open_weight:
            break
        full, level = n_capped, (total - capped) / open_weight
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("cap").cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES,
        seed: int = SEED) -> DataFrame:
    """One row per document, globally sorted by virtual finish time.

    Columns doc_id, size, source_size, target, taken (words the mix takes,
    repeats counted) and finish (virtual finish time of the first pass; the
    budget is spent at 1; null when the target is 0).
    """
    size = F.size(words(text_of())).cast("long")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                         F.lit(":"), F.col("size").cast("string")))
    sized = materialize(docs.select("doc_id", "source", size.alias("size"))
                        .withColumn("key", key)
                        .withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
                        .withColumn("_row", F.monotonically_increasing_id()))
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice")
                                      .rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select("source", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_passes)
    within = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, 0))
    s, t, d = slices.alias("s"), targets.alias("t"), sized.withColumn("within", within).alias("d")
    offsets = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("source"), "slice", "before", "source_size", "target").alias("o")
    served = d.join(offsets, F.col("d.source").eqNullSafe(F.col("o.source"))
                    & (F.col("d.slice") == F.col("o.slice")))
    end = F.col("before") + F.col("within")
    served = served.select(F.col("d._row").alias("_row"), "doc_id", "size", "source_size", "target", "key", end.alias("end"))
    budget = targets.agg(F.sum(F.round("target")).cast("long")).first()[0] or 0
    # The queue: each pass over a document, cut in two where its source's share ends.
    due = F.round("target").cast("long") - F.col("end") + F.col("size") - F.col("source_size") * F.col("pass")
    due = F.greatest(F.lit(0), F.least(F.col("size"), due)).cast("long")
    time = F.when(F.col("target") > 0, (F.col("end") + F.col("pass") * F.col("source_size")) / F.col("target"))
    piece = F.explode(F.array(
        F.struct(F.least(time, F.lit(1.0)).alias("finish"), F.lit(0).alias("late"), due.alias("words")),
        F.struct(F.greatest(time, F.lit(1.0)).alias("finish"), F.lit(1).alias("late"),
                 (F.col("size") - due).alias("words")))).alias("p")
    queue = (served.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))))
             .select("_row", "pass", "key", piece)
             .select("_row", "pass", "key", "p.*").where("words > 0"))
    # Served in the global order of finish times until the budget is spent.
    order = [F.col(c) for c in ("finish", "late", "key", "pass", "_row")]
    ordered = global_sum(queue, F.col("words"), *order, name="upto")
    taken = F.greatest(F.lit(0), F.least(F.col("words"), F.lit(budget) - F.col("upto") + F.col("words")))
    per_row = ordered.groupBy("_row").agg(F.sum(taken).cast("long").alias("taken"))
    first = F.when(F.col("target") > 0, F.col("end") / F.col("target")).alias("finish")
    return (served.join(per_row, "_row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), first)
            .orderBy("finish", "doc_id"))


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES,
             seed: int = SEED) -> DataFrame:
    """The mix as a reading list: (doc_id, pass, finish, words) in serving order."""
    passes = F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1)))
    left = F.col("taken") - F.col("pass") * F.col("size")
    return (mix(docs, weights, max_passes, seed)
            .withColumn("pass", passes)
            .select("doc_id", "pass",
                    (F.col("finish") + F.col("pass") * F.col("source_size") / F.col("target")).alias("finish"),
                    F.least(F.col("size"), left).alias("words"))
            .where("words > 0").orderBy("finish", "doc_id"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
o AS (
  SELECT *, CAST(sum(size) OVER (
              PARTITION BY source ORDER BY md5('{SEED}:' || doc_id || ':' || size), doc_id, size
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM d GROUP BY source),
c AS (SELECT *, {MAX_PASSES} * source_size AS cap FROM s),
r AS (
  SELECT *, row_number() OVER w - 1 AS n,
         sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM c WINDOW w AS (ORDER BY cap / weight, source)),
l AS (
  SELECT CAST(total - fixed AS DOUBLE) / open AS level FROM r
  WHERE (CAST(total - fixed AS DOUBLE) / open) * weight <= cap ORDER BY n LIMIT 1),
t AS (SELECT source, source_size, least(weight * level, CAST(cap AS DOUBLE)) AS target FROM c, l)
SELECT doc_id, size, source_size, target,
       CAST(list_sum([greatest(0, least(size, CAST(round(target) AS BIGINT) - done + size - source_size * p))
                      FOR p IN range({MAX_PASSES})]) AS BIGINT) AS taken
FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
"""
