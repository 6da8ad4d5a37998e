"""Entropy operators over a contingency table (A4-A11, A13, R9, T1, T2).

All of them read the small contingency table, never the data rows:
* ``label_stats``   -- size, entropy, majority of a label distribution (A4, A9)
* ``value_stats``   -- the same per (feature, value) (A5, A6, A7, A9)
* ``feature_scores``-- weighted entropy and information gain per feature (A8, A10, A11)
* ``best_feature``  -- arg-min of the weighted entropy per node (T1, T2)

Entropy is in bits.  One aggregation gives it: ``log2 N - sum(n log2 n) / N``.
Majority ties go to the highest label (as the reference decides a tie);
``tie="low"`` gives the lowest label instead.  Feature ties go to the lowest
position in the feature list; weighted entropies are compared after rounding
to 12 places so that summation-order noise cannot decide a tie.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entrotree.functions.exprs import entropy_from_sums, feature_index, nlog2n
from entrotree.runtime import materialize

TIE_DIGITS = 12


def majority_expr(label: str = "label", n: str = "n", tie: str = "high") -> Column:
    """Label with the largest count in the group; ``tie`` = ``high`` or ``low``."""
    if tie == "high":
        return F.max_by(F.col(label), F.struct(F.col(n), F.col(label)))
    if tie == "low":
        return F.min_by(F.col(label), F.struct(-F.col(n), F.col(label)))
    raise ValueError("tie must be 'high' or 'low'")


def _distribution_aggs(tie: str) -> list[Column]:
    return [F.sum("n").cast("long").alias("n"),
            F.sum(nlog2n("n")).alias("_s"),
            F.count(F.lit(1)).alias("_k"),
            majority_expr("label", "n", tie).alias("majority")]


def _finish(df: DataFrame) -> DataFrame:
    return (df.withColumn("entropy", entropy_from_sums("n", "_s", "_k"))
              .drop("_s", "_k"))


def label_stats(counts: DataFrame, keys: Sequence[str] = (), *,
                tie: str = "high") -> DataFrame:
    """``keys..., n, majority, entropy`` from rows ``keys..., label, n``.

    ``counts`` may hold several rows per label (they are summed first).
    """
    per_label = counts.groupBy(*keys, "label").agg(F.sum("n").alias("n"))
    return _finish(per_label.groupBy(*keys).agg(*_distribution_aggs(tie)))


def value_stats(cont: DataFrame, keys: Sequence[str] = (), *,
                tie: str = "high") -> DataFrame:
    """``keys..., feature, value, n, majority, entropy`` (support, purity, label)."""
    return _finish(cont.groupBy(*keys, "feature", "value").agg(*_distribution_aggs(tie)))


def node_stats(cont: DataFrame, keys: Sequence[str], first_feature: str | Column, *,
               tie: str = "high") -> DataFrame:
    """Per-node label statistics read off one feature's slice of the contingency.

    Every row of a node is counted once under every feature, so any single
    feature's counts summed over its values are the node's label counts.
    """
    first = F.lit(first_feature) if isinstance(first_feature, str) else first_feature
    return label_stats(cont.where(F.col("feature") == first), keys, tie=tie)


def weighted_scores(vstats: DataFrame, features: Sequence[str],
                    keys: Sequence[str] = (), *more: Column) -> DataFrame:
    """``keys..., feature, feature_index, node_n, weighted_entropy, n_values``
    from value statistics alone (A8, A10); ``more`` aggregates beside."""
    return (vstats.groupBy(*keys, "feature")
                  .agg(F.sum("n").cast("long").alias("node_n"),
                       (F.sum(F.col("n") * F.col("entropy")) / F.sum("n")).alias("weighted_entropy"),
                       F.count(F.lit(1)).alias("n_values"), *more)
                  .withColumn("feature_index", feature_index("feature", features)))


def feature_scores(cont: DataFrame, features: Sequence[str],
                   keys: Sequence[str] = ()) -> DataFrame:
    """``keys..., feature, feature_index, node_n, node_entropy, weighted_entropy,
    gain, n_values`` from a contingency table.

    ``weighted_entropy = sum(n_v * H_v) / sum(n_v)`` over the feature's values;
    ``gain = node_entropy - weighted_entropy``.  All sums are partially
    aggregated before they are shuffled, by (feature, value) and by (feature,
    label); no task holds a whole feature.  The label totals of a feature give
    the node entropy, and join one row per feature.
    """
    by = [*keys, "feature"]
    cont = materialize(cont)  # read twice below; its source only once
    scores = weighted_scores(value_stats(cont, keys), features, keys)
    node = label_stats(cont, by).select(*by, F.col("entropy").alias("node_entropy"))
    on = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in by])
    return (scores.alias("s").join(node.alias("t"), on)
            .select(*[F.col(f"s.{k}").alias(k) for k in by], "feature_index", "node_n", "node_entropy",
                    "weighted_entropy", (F.col("node_entropy") - F.col("weighted_entropy")).alias("gain"),
                    "n_values"))


def best_feature(fs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Arg-min of the weighted entropy per node, tie -> lowest feature index."""
    payload = [c for c in fs.columns if c not in keys]
    order = F.struct(F.round("weighted_entropy", TIE_DIGITS), F.col("feature_index"))
    best = fs.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in payload]), order).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def dataset_entropy(df: DataFrame, label: str, *, keys: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """Entropy of the label over the whole table (A4): ``keys..., n, entropy``."""
    from entrotree.operators.counts import class_histogram
    st = label_stats(class_histogram(df, label, keys=keys, weight=weight), keys)
    return st.select(*keys, "n", "entropy")
