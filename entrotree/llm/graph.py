"""Connected components of an edge table, by local contraction and alternating stars.

Links are cut into parts of at most about ``EDGES`` rows, as many as they make;
every task joins what is linked within its part and gives back one link per
node, to the smallest node it found.  Stars then bring the parts together:
large-star links every larger neighbour of a node to the smallest node of its
neighbourhood, small-star every smaller one; repeating both ends, after a
number of rounds logarithmic in the input, in one star per component.  Every
step is a grouped minimum (merged before the shuffle) and a join with it; rounds
are cut with ``materialize``.  A round is left out where the links are stars
already: one aggregation tells, and only its answer reaches the driver.

A hub holds many rows of a join.  The planner splits such a partition only if
both sides come straight from an exchange, which the grouped side does not when
it is grouped by the join's own key; joining on a hash of the node as well makes
it deal the minima out anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


# Links that one task contracts.
EDGES = 200_000


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """Links (u, v) of every node to the smallest one it is linked with in its part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def root(x):
            top = x
            while (y := above.get(top, top)) != top:
                top = y
            while x != top:  # later look-ups go there at once
                above[x], x = top, above[x]
            return top
        schema = None
        for batch in batches:
            schema = batch.schema
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    above[max(a, b)] = min(a, b)
        if above:
            nodes = list(above)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, schema.field(0).type),
                                              pa.array([root(x) for x in nodes], schema.field(1).type)], schema=schema)
    return edges.coalesce(parts).mapInArrow(run, edges.schema)


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One large-star (or small-star) step over edges (u, v), u > v."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if larger else edges
    low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hashed = F.xxhash64("u").alias("_h")
    near = around.select("*", hashed).join(low.select("*", hashed), ["u", "_h"])
    if larger:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller one has just that, and none larger."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return per_node.where("below > 1 or (below > 0 and above > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links between comparable ids -> (node, root): root is the smallest id linked.

    Ids without a link do not appear; self links and repeated links are fine.
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct())
    parts = max(1, -(-now.count() // EDGES))
    now = materialize(_contracted(now, parts))
    while parts > 1 and not _stars(now):
        now = materialize(_contracted(_star(_star(now, True), False), parts))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v"), F.col("v")).distinct())
