"""Preparation operators: equal-width discretisation (P1), feature subset (P2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrotree.functions.exprs import equal_width_bin


def column_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """``{column: (min, max)}`` from a single aggregation.

    The result is one row of 2 x len(columns) scalars however large ``df`` is
    (partial aggregation per task, one tiny final merge).
    """
    aggs = []
    for c in columns:
        x = F.col(c)
        if dict(df.dtypes)[c] in ("double", "float"):  # bounds over finite values
            x = F.when(F.abs(x) < F.lit(float("inf")), x)
        aggs += [F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def equal_width_bins(df: DataFrame, columns: Sequence[str], bins: int = 7, *,
                     bounds: dict[str, tuple] | None = None,
                     suffix: str | None = None) -> DataFrame:
    """Replace (or, with ``suffix``, add) each column by its equal-width bin.

    Bin of ``x`` is ``least(bins-1, floor((x - lo) * bins / (hi - lo)))`` with
    ``lo``/``hi`` the column's min/max (or ``bounds`` given, e.g. the training
    bounds when binning new data).  Nulls stay null and NaN becomes null;
    infinities fall into the outer bins.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    bounds = bounds or column_bounds(df, columns)
    out = df
    for c in columns:
        lo, hi = bounds[c]
        target = f"{c}{suffix}" if suffix else c
        out = out.withColumn(target, equal_width_bin(F.col(c), lo, hi, bins))
    return out


def bin_occupancy(binned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, bin): ``column STRING, bin INT, n LONG``."""
    long = binned.select(*[F.col(c).cast("int").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "bin")
    return long.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))


def select_features(df: DataFrame, features: Sequence[str], label: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Feature subset and label split by name (P2); pruned down to the scan."""
    return df.select(*keys, *features, label)
