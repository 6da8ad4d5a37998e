"""Counting operators: unpivot (R3), class histogram (A1), contingency (A2, A3).

Contingency schema: ``keys..., feature STRING, value, label, n LONG``.  Every
count is a ``groupBy`` whose partial aggregate runs in the same codegen stage
as the unpivot, so at most (#keys x #features x #values x #labels) rows per
task reach the shuffle however many input rows there are; a hot key is merged
map-side before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_expr(weight: str | None) -> Column:
    """Row count, or the sum of a weight column (rows pre-aggregated upstream)."""
    return F.sum(weight).cast("long") if weight else F.count(F.lit(1))


def unpivot_features(df: DataFrame, features: Sequence[str], label: str, *,
                     keys: Sequence[str] = (), weight: str | None = None,
                     value_type: str = "int") -> DataFrame:
    """One record per (row, feature): ``keys..., label, [weight], feature, value``.

    All features are cast to ``value_type`` (``int`` for bins, ``string`` for
    nominal values), since one ``value`` column holds them all.
    """
    ids = [*keys, F.col(label).alias("label")] + ([weight] if weight else [])
    id_names = [*keys, "label"] + ([weight] if weight else [])
    narrow = df.select(*ids, *[F.col(f).cast(value_type).alias(f) for f in features])
    return narrow.unpivot(id_names, list(features), "feature", "value")


def contingency(df: DataFrame, features: Sequence[str], label: str, *,
                keys: Sequence[str] = (), weight: str | None = None,
                value_type: str = "int", where: Column | None = None) -> DataFrame:
    """Counts per (keys, feature, value, label) -- all nodes of a level in one job.

    ``where`` (over the unpivoted columns) drops (row, feature) pairs before
    counting, e.g. features that a key's tree may not use.
    """
    long = unpivot_features(df, features, label, keys=keys, weight=weight,
                            value_type=value_type)
    if where is not None:
        long = long.where(where)
    return long.groupBy(*keys, "feature", "value", "label").agg(count_expr(weight).alias("n"))


def class_histogram(df: DataFrame, label: str, *, keys: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """Rows per label (A1): ``keys..., label, n``."""
    return (df.groupBy(*keys, F.col(label).alias("label"))
              .agg(count_expr(weight).alias("n")))


def compact_rows(df: DataFrame, columns: Sequence[str], *,
                 weight: str | None = None, out: str = "w") -> DataFrame:
    """Merge identical rows into one row with a weight (``out``).

    For binned features the number of distinct rows is bounded by the product
    of the bin counts and is usually far below the row count; later passes
    then read the compact table instead of the source.
    """
    return df.groupBy(*columns).agg(count_expr(weight).alias(out))


# Merging must leave at most this share of the rows to pay for its exchange.
MERGED_SHARE = 0.5


def worth_merging(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether ``compact_rows`` over ``columns`` makes the table much smaller.

    One pass with a distinct-count sketch of the rows' hashes; no wide exchange.
    """
    row = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*columns), 0.02).alias("d")).first()
    return row["d"] <= MERGED_SHARE * row["n"]
