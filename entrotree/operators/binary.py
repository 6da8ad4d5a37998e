"""Binary-split entropy tree on ordered features (V4).

The reference cross-validates a CART-style tree (entropy criterion, depth 3,
threshold splits).  Here it is grown level by level like the multiway tree:

1. one pass over the (compacted) rows: counts per (node, feature, value, label);
   below the root only the smaller child of a node is counted, the other one is
   the parent's counts minus those;
2. for every cut between two adjacent present values, the label entropy left and
   right of it from running sums.  With ``f(c) = c log2 c`` a side's entropy is
   ``log2 n - sum(f(c)) / n``; a row that moves ``n`` rows of one label to the
   left changes the sums by ``f(l) - f(l - n)`` and ``f(t - l) - f(t - l + n)``.
   So labels stay rows, however many there are;
3. arg-min of the weighted entropy per node (tie -> lowest feature position,
   then lowest threshold);
4. children's statistics from the same counts, so leaves cost no extra pass.

Cuts separate the values they lie between, always.  Integers are compared as
64-bit integers with ``cut``, their floored mean; other numbers as doubles with
``threshold``, the midpoint where it is at least the lower and below the upper
value, else the lower value itself.  For integers ``threshold`` shows the
midpoint while doubles hold it exactly, else the cut.

A level whose counts have more than ``RANGE_ROWS`` rows is dealt to ranges of
(node, feature, value), as many as it has that many rows; running sums are taken
within a range and over the range totals, so no task holds a whole feature.
Cross-validation models (``fold``) share one pass: a model's counts are those of
all rows at the node minus those of its held-out fold, and rows are routed once
for every different split of a node, not once per model.

Values up to the cut go left, null and NaN go right.  Rows with a null label are
dropped.  Leaf labels are the majority with ties to the lowest label (the
scikit-learn classifier the reference uses); pure nodes are not split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from entrotree.functions.exprs import (binary_path, entropy_from_sums, is_whole, nlog2n, sql_literal, sql_name,
                                       sql_text)
from entrotree.operators.counts import count_expr
from entrotree.operators.entropy import TIE_DIGITS, label_stats, node_stats
from entrotree.operators.grow import FEW_SPLITS, case_of, feature_set_exprs, prepare_rows, with_largest_children
from entrotree.runtime import broadcast_if_small, materialize

# Rows of a level's counts that make one range.
RANGE_ROWS = 200_000
# Integers up to here, and the midpoints of two of them, are exact doubles.
EXACT = 1 << 52
VALUES = ["whole", "number"]  # a value: an integer, or a double; null: neither

BINARY_TREE_COLUMNS = ["node", "parent", "depth", "parent_feature", "branch_value",
                       "split_feature", "split_index", "threshold", "cut", "n", "entropy",
                       "majority", "weighted_entropy", "gain", "is_leaf"]


def threshold_text(threshold: Column, cut: Column) -> Column:
    """The cut as it stands in branches and node paths."""
    return F.when((cut >= EXACT) | (cut <= -EXACT), cut.cast("string")).otherwise(threshold.cast("string"))


def _contingency(data: DataFrame, features: Sequence[str], keys: Sequence[str], weight: str | None,
                 where: Column | None = None) -> DataFrame:
    """Counts per (keys, feature, whole, number, label)."""
    kinds = dict(data.dtypes)

    def value(f: str, kind: str) -> Column:
        return F.col(f) if kinds[f] == kind else F.lit(None).cast(kind)
    each = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), value(f, "bigint").alias("whole"),
                                       value(f, "double").alias("number")) for f in features]))
    long = data.select(*keys, F.col("_y").alias("label"), *([weight] if weight else []), each)
    if where is not None:
        long = long.where(where)
    return long.groupBy(*keys, "feature", *VALUES, "label").agg(count_expr(weight).alias("n"))


def _ranged(cont: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, bool]:
    """``cont`` with the number of its range, and whether there are several.

    Ranges ascend in (keys, feature, value); one value's rows are in one range.
    """
    ranges = -(-cont.count() // RANGE_ROWS)
    if ranges <= 1:
        return cont.withColumn("_range", F.lit(0)), False
    dealt = cont.repartitionByRange(ranges, *keys, "feature", *VALUES)
    return materialize(dealt.withColumn("_range", F.spark_partition_id())), True


def _running(df: DataFrame, group: Sequence[str], sums: Sequence[str], several: bool) -> DataFrame:
    """Replace ``sums`` by running sums in the order of the values.

    Within a range by a window, before it by the totals of the ranges: a window
    of as many rows as a group has ranges.
    """
    parts = [*group, "_range"]
    within = Window.partitionBy(*parts).orderBy(*VALUES).rowsBetween(Window.unboundedPreceding, 0)
    rest = [c for c in df.columns if c not in sums]
    if not several:
        return df.select(*rest, *[F.sum(c).over(within).alias(c) for c in sums])
    prior = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (df.groupBy(*parts).agg(*[F.sum(c).alias(c) for c in sums])
              .select(*parts, *[F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(f"_b_{c}") for c in sums]))
    return (df.join(before, parts)
            .select(*rest, *[(F.sum(c).over(within) + F.col(f"_b_{c}")).alias(c) for c in sums]))


def _following(per_value: DataFrame, group: Sequence[str], several: bool) -> DataFrame:
    """Add ``next_whole`` and ``next_number``: the value that follows in the feature."""
    nxt = [(c, f"next_{c}") for c in VALUES]
    within = Window.partitionBy(*group, "_range").orderBy(*VALUES)
    led = per_value.select("*", *[F.lead(c).over(within).alias(a) for c, a in nxt])
    if not several:
        return led
    # After the last value of a range, the first of the next.
    firsts = per_value.groupBy(*group, "_range").agg(F.min(F.struct(*VALUES)).alias("_first"))
    after = firsts.select(*group, "_range", F.lead("_first").over(
        Window.partitionBy(*group).orderBy("_range")).alias("_after"))
    return led.join(after, [*group, "_range"]).select(
        *per_value.columns, *[F.coalesce(F.col(a), F.col(f"_after.{c}")).alias(a) for c, a in nxt])


def _cuts() -> tuple[Column, Column]:
    """(cut, threshold) between a value and the one that follows it."""
    a, b, x, y = (F.col(c) for c in ("whole", "next_whole", "number", "next_number"))
    cut = a.bitwiseAND(b) + F.shiftright(a.bitwiseXOR(b), 1)  # floored mean, cannot overflow
    exact = (a > -EXACT) & (b < EXACT)
    middle = (x + y) / 2
    return cut, F.when(a.isNotNull(), F.when(exact, (a + b) / 2).otherwise(cut.cast("double"))).otherwise(
        F.when((middle >= x) & (middle < y), middle).otherwise(x))


def _thresholds(cont: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Candidate splits: ``keys, feature, split_index, threshold, cut, n_left, weighted_entropy``.

    ``cont`` has keys, feature, whole, number, label and n; null values count on
    the right side of every cut.
    """
    group = [*keys, "feature"]
    cont, several = _ranged(cont, keys)
    totals = cont.groupBy(*group, "label").agg(F.sum("n").alias("t"))
    if several:  # one row a label of a feature: joined by key, a task would get all rows of a label
        totals = materialize(totals)
    node = totals.groupBy(*group).agg(F.sum("t").alias("total"), F.sum(nlog2n("t")).alias("all"))
    if several:
        totals, node = broadcast_if_small(totals), broadcast_if_small(node)
    present = cont.where("whole is not null or number is not null")
    left = _running(present.withColumn("l", F.col("n")), [*group, "label"], ["l"], several)
    r = F.col("t") - F.col("l")
    change = left.join(totals, [*group, "label"]).select(
        *group, "_range", *VALUES, "n",
        (nlog2n("l") - nlog2n(F.col("l") - F.col("n"))).alias("dl"),
        (nlog2n(r) - nlog2n(r + F.col("n"))).alias("dr"))
    per_value = change.groupBy(*group, "_range", *VALUES).agg(
        F.sum("n").alias("n"), F.sum("dl").alias("dl"), F.sum("dr").alias("dr"))
    summed = _running(_following(per_value, group, several), group, ["n", "dl", "dr"], several)
    n_left, n_right = F.col("n"), F.col("total") - F.col("n")
    h_left = entropy_from_sums(n_left, F.col("dl"))
    h_right = entropy_from_sums(n_right, F.col("all") + F.col("dr"))
    index = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1
    cut, threshold = _cuts()
    return (summed.where("next_whole is not null or next_number is not null").join(node, group)
            .select(*group, index.cast("int").alias("split_index"), threshold.alias("threshold"), cut.alias("cut"),
                    n_left.alias("n_left"), n_right.alias("n_right"),
                    ((n_left * h_left + n_right * h_right) / F.col("total")).alias("weighted_entropy")))


def goes_left(whole: Column, number: Column) -> Column:
    """Whether a value lies up to the cut of its split; null and NaN do not."""
    return F.coalesce(F.when(F.col("cut").isNotNull(), whole <= F.col("cut")).otherwise(number <= F.col("threshold")),
                      F.lit(False))


def left_sql(feature: str, kind: str, threshold: float, cut: int | None) -> str:
    """The same as SQL text for a known split and the type of the feature's column."""
    if cut is not None and is_whole(kind):
        return f"{sql_name(feature)} <= {sql_literal(cut, 'BIGINT')}"
    return f"CAST({sql_name(feature)} AS DOUBLE) <= {sql_literal(threshold, 'DOUBLE')}"


def _route(data: DataFrame, splits: DataFrame, few: Sequence[Row] | None, by: Sequence[str],
           features: Sequence[str]) -> DataFrame:
    """Move rows to the child chosen by each split of their node; rows without one drop out.

    ``splits`` has distinct rows of by, node, the split, its two children (small,
    big) and whether the left one is the small one.  Adds ``_counted``: whether
    the row is in the smaller child.
    """
    keep = [c for c in data.columns if c not in ("node", "_counted", "_big")]
    if few is not None:
        kinds, per_node = dict(data.dtypes), {}
        for r in few:
            per_node.setdefault((r["node"], *[r[k] for k in by]), []).append(r)

        def children(r: Row) -> str:
            each = []
            for s in per_node[r["node"], *[r[k] for k in by]]:
                small = f"named_struct('node', {sql_text(s['small'])}, '_big', {sql_text(s['big'])}, '_counted', true)"
                big = f"named_struct('node', {sql_text(s['big'])}, '_big', {sql_text(s['big'])}, '_counted', false)"
                left, right = (small, big) if s["left_small"] else (big, small)
                test = left_sql(s["split_feature"], kinds[s["split_feature"]], s["threshold"], s["cut"])
                each.append(f"CASE WHEN {test} THEN {left} ELSE {right} END")
            return f"array({', '.join(each)})"
        case = case_of([rows[0] for rows in per_node.values()], by, kinds, children)
        return data.select(*keep, F.inline(F.expr(case)))
    whole = [F.col(f) if k == "bigint" else F.lit(None).cast("bigint") for f, k in data.dtypes if f in features]
    number = [F.col(f) if k == "double" else F.lit(None).cast("double") for f, k in data.dtypes if f in features]
    at = F.col("split_index") + 1
    left = goes_left(F.element_at(F.array(*whole), at), F.element_at(F.array(*number), at))
    is_small = left == F.col("left_small")
    return data.join(broadcast_if_small(splits), [*by, "node"]).select(
        *keep, F.when(is_small, F.col("small")).otherwise(F.col("big")).alias("node"),
        F.col("big").alias("_big"), is_small.alias("_counted"))


def _without_fold(base: DataFrame, nodes: DataFrame | None, fold: str, k: int) -> DataFrame:
    """Counts of every model: of all rows at a node minus those of the model's fold.

    ``base`` has the fold in its keys; ``nodes`` (model, node) names the models
    that have a node, all of them if not given.
    """
    cell = ["node", "feature", *VALUES, "label"]
    sums = [F.sum(F.when(F.col(fold) == m, F.col("n")).otherwise(0)) for m in range(k)]
    per_cell = base.groupBy(*cell).agg(F.sum("n").alias("_all"), F.array(*sums).alias("_out"))
    models = per_cell.select(*cell, "_all", F.posexplode("_out").alias("model", "_held"))
    kept = models.select(F.col("model").cast("int").alias("model"), *cell,
                         (F.col("_all") - F.col("_held")).cast("long").alias("n")).where("n > 0")
    return kept if nodes is None else kept.join(broadcast_if_small(nodes.select("model", "node")), ["model", "node"])


def fit_binary(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 3, *,
               by: Sequence[str] = (), weight: str | None = None, compact: bool | str = True,
               tie: str = "low", feature_sets: Mapping | None = None,
               fold: str | None = None, k: int = 0) -> DataFrame:
    """Grow binary entropy trees (one per ``by`` key) with up to ``max_depth`` split levels.

    ``feature_sets`` restricts each key's tree to its own features, as in
    ``fit_id3``.  With ``fold``, a column of numbers below ``k``, one tree per
    ``model`` in 0 .. k-1 is grown from the rows of all other folds.
    """
    if max_depth < 0:
        raise ValueError("max_depth must be >= 0")
    features, by = list(features), list(by)
    if fold and by:
        raise ValueError("fold models have no other key")
    rows_by, tree_by = ([fold], ["model"]) if fold else (by, by)
    keys = [*tree_by, "node"]
    allowed = first = None
    if feature_sets is not None:
        allowed, first, _ = feature_set_exprs(feature_sets, by)
    kinds = dict(df.dtypes)
    numbers = df.withColumns({f: F.col(f).cast("bigint") if is_whole(kinds[f]) else
                              F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features})
    data, w = prepare_rows(numbers, features, label, by=rows_by, weight=weight, value_type=None, compact=compact)
    payload = ["feature", "split_index", "threshold", "cut", "n_left", "n_right", "weighted_entropy"]
    order = F.struct(F.round("weighted_entropy", TIE_DIGITS), F.col("split_index"), F.col("threshold"), F.col("cut"))
    none = {"split_feature": "string", "split_index": "int", "threshold": "double", "cut": "bigint",
            "weighted_entropy": "double", "gain": "double"}
    text = threshold_text(F.col("threshold"), F.col("cut"))

    def child(node: str, feature: str, op: str) -> Column:
        return binary_path(F.col(node), F.col(feature), op, text)

    nodes = base = families = None
    levels = []
    for depth in range(max_depth + 1):
        if depth < max_depth or nodes is None:
            # The one pass over the rows of this level.
            if families is None:
                base = _contingency(data, features, [*rows_by, "node"], w, allowed)
            else:
                counted = _contingency(data.where("_counted"), features, [*rows_by, "node", "_big"], w, allowed)
                base = with_largest_children(base, counted, families, by, rows_by, VALUES)
            base = materialize(base)
            cont = materialize(_without_fold(base, nodes, fold, k)) if fold else base
        if nodes is None:
            nodes = node_stats(cont, keys, features[0] if first is None else first, tie=tie).select(
                *keys, *[F.lit(None).cast("string").alias(c) for c in ("parent", "parent_feature", "branch_value")],
                "n", "entropy", "majority")
        if depth == max_depth:
            levels.append(nodes.select("*", F.lit(depth).alias("depth"), F.lit(True).alias("is_leaf"),
                                       *[F.lit(None).cast(t).alias(c) for c, t in none.items()]))
            break
        best = (_thresholds(cont, keys, features).groupBy(*keys)
                .agg(F.min_by(F.struct(*payload), order).alias("_b"))
                .select(*keys, F.col("_b.feature").alias("split_feature"),
                        *[F.col(f"_b.{c}").alias(c) for c in payload[1:]]))
        leaf = F.col("split_feature").isNull() | (F.col("entropy") <= 0)
        level = nodes.join(best, keys, "left").withColumn("is_leaf", leaf).withColumn(
            "gain", F.col("entropy") - F.col("weighted_entropy"))
        level = materialize(level.withColumns(
            {c: F.when(~F.col("is_leaf"), F.col(c)) for c in none} | {"depth": F.lit(depth)}))
        levels.append(level)
        split = level.where(~F.col("is_leaf"))
        # Children's label counts: the split feature's values on either side.
        chosen = split.select(*keys, F.col("split_feature").alias("feature"), "threshold", "cut")
        left = goes_left(F.col("whole"), F.col("number"))
        sides = (cont.join(broadcast_if_small(chosen), [*keys, "feature"])
                 .select(*tree_by, F.col("node").alias("parent"), F.col("feature").alias("parent_feature"),
                         F.concat(F.when(left, F.lit("<=")).otherwise(F.lit(">")), text).alias("branch_value"),
                         F.when(left, child("node", "feature", "<=")).otherwise(child("node", "feature", ">"))
                         .alias("node"), "label", "n"))
        own = [*keys, "parent", "parent_feature", "branch_value"]
        nodes = label_stats(sides, own, tie=tie).select(*own, "n", "entropy", "majority")
        if depth + 1 == max_depth:
            continue
        # One routing per different split of a node; models may share it.
        halves = [child("node", "split_feature", op) for op in ("<=", ">")]
        left_small = F.sum("n_left") <= F.sum("n_right")
        splits = (split.groupBy(*by, "node", "split_feature", "split_index", "threshold", "cut")
                  .agg(left_small.alias("left_small"))
                  .select("*", F.when(F.col("left_small"), halves[0]).otherwise(halves[1]).alias("small"),
                          F.when(F.col("left_small"), halves[1]).otherwise(halves[0]).alias("big")))
        few = splits.limit(FEW_SPLITS + 1).collect()
        if not few:
            break
        few = few if len(few) <= FEW_SPLITS else None
        data = _route(data, splits, few, by, features)
        families = splits.select(*by, F.col("node").alias("parent"), "big")

    columns = [*tree_by, *BINARY_TREE_COLUMNS]
    return reduce(lambda a, b: a.unionByName(b), [x.select(columns) for x in levels])
