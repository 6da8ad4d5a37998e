"""Classification metrics (M1-M9) from scored rows.

Everything starts from ``confusion_counts`` -- one ``groupBy(by, actual,
predicted)`` whose partial aggregate leaves at most K^2 rows per task -- and the
rest reads that K^2-row table.  ``by`` computes one set of metrics per key
(e.g. per fold model).  Precision and recall follow the usual definitions:
a zero denominator gives 0; macro averages run over the labels that occur as
actual or predicted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrotree.operators.counts import count_expr
from entrotree.runtime import materialize


def confusion_counts(scored: DataFrame, actual: str, predicted: str = "prediction", *,
                     by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Present cells of the confusion matrix: ``by..., actual, predicted, n``."""
    return (scored.groupBy(*by, F.col(actual).alias("actual"),
                           F.col(predicted).alias("predicted"))
                  .agg(count_expr(weight).alias("n")))


# Parts of the predicted labels that a matrix is built in.
LABEL_PARTS = 64


def confusion_matrix(conf: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """All label x label cells (M1) of the labels that occur; absent cells are 0.

    A null label is a label of its own, as in the other metrics.  Labels stay
    rows: every actual label meets the predicted ones of each part in a join by
    (key, part), so no row and no task holds all labels of a key squared.
    """
    cells = materialize(conf)  # read twice below: labels and cells
    label = F.explode(F.array(F.struct(F.col("actual").alias("l")), F.struct(F.col("predicted").alias("l")))).alias("l")
    labels = cells.select(*by, label).distinct()
    # Keys packed as one struct column, whose null fields are equal to each other.
    key = F.struct(F.lit(0).alias("_"), *[F.col(k) for k in by]).alias("_key")
    part = F.pmod(F.xxhash64("l"), F.lit(LABEL_PARTS)).cast("int")
    actual = labels.select(key, F.col("l.l").alias("actual"),
                           F.explode(F.sequence(F.lit(0), F.lit(LABEL_PARTS - 1))).alias("_part"))
    predicted = labels.select(key, F.col("l.l").alias("predicted"), part.alias("_part"))
    grid = actual.join(predicted, ["_key", "_part"]).select(
        *[F.col(f"_key.{k}").alias(k) for k in by], "actual", "predicted")
    keys = [*by, "actual", "predicted"]
    on = reduce(lambda x, y: x & y, [F.col(f"g.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    return (grid.alias("g").join(cells.alias("c"), on, "left")
                .select(*[F.col(f"g.{k}").alias(k) for k in keys],
                        F.coalesce(F.col("c.n"), F.lit(0)).cast("long").alias("n")))


def label_metrics(conf: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Per label (M5, M8): ``by..., label, tp, n_actual, n_predicted, precision, recall``.

    Each cell counts once for its actual label and once for its predicted
    label: one ``explode`` of two records per cell (a single pass over the
    cells, so whatever computes them runs once).
    """
    zero = F.lit(0).cast("long")
    n = F.col("n").cast("long")
    tp = F.when(F.col("actual") == F.col("predicted"), n).otherwise(zero)
    records = F.explode(F.array(
        F.struct(F.col("actual").alias("label"), tp.alias("tp"), n.alias("n_actual"),
                 zero.alias("n_predicted")),
        F.struct(F.col("predicted").alias("label"), zero.alias("tp"), zero.alias("n_actual"),
                 n.alias("n_predicted"))))
    per = (conf.select(*by, records.alias("_r"))
               .select(*by, "_r.*")
               .groupBy(*by, "label")
               .agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "n_actual", "n_predicted")]))
    return per.select(
        *by, "label", "tp", "n_actual", "n_predicted",
        F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted"))
         .otherwise(F.lit(0.0)).alias("precision"),
        F.when(F.col("n_actual") > 0, F.col("tp") / F.col("n_actual"))
         .otherwise(F.lit(0.0)).alias("recall"))


def summary(conf: DataFrame, *, by: Sequence[str] = (), positive=1) -> DataFrame:
    """One row per key: accuracy (M2), error rate (M9), precision / recall of
    ``positive`` (M3, M6) and their macro means over labels (M4, M7).

    A single aggregation over the per-label table.
    """
    per = label_metrics(conf, by=by)
    is_pos = F.col("label").cast("string") == F.lit(str(positive))  # in the label's own type
    agg = per.groupBy(*by).agg(
        F.sum("n_actual").cast("long").alias("n"),
        F.sum("tp").cast("long").alias("correct"),
        F.coalesce(F.max(F.when(is_pos, F.col("precision"))), F.lit(0.0)).alias("precision"),
        F.coalesce(F.max(F.when(is_pos, F.col("recall"))), F.lit(0.0)).alias("recall"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"))
    return agg.select(*by, "n", "correct",
                      (F.col("correct") / F.col("n")).alias("accuracy"),
                      (1 - F.col("correct") / F.col("n")).alias("error_rate"),
                      "precision", "recall", "precision_macro", "recall_macro")
