"""Multiway entropy (ID3) tree growth, level by level (T1-T6).

One pass over the data per level: the contingency of the nodes of the level
is one ``groupBy(keys, node, feature, value, label)``; everything after it
(entropies, scores, the arg-min per node, the child nodes) reads that small
table.  Below the root, the largest child of a node is not counted: it is the
parent's contingency minus its siblings'.  Rows move to their child node by one
compiled expression while a level has few splits, else through a join with the
level's split table.  No exchange is keyed by node alone before a partial
aggregate, so the root, which holds every row, is spread over its (feature,
value, label) groups.

Input rows are first merged into distinct (features, label) rows with a
weight (``compact=True``), so a level reads the compact table, not the source;
``compact="auto"`` merges only if a sketch says that it halves the rows at least.

Tree table (one row per node)::

    [by...], node STRING (path "/f7=3/f0=2", root ""; parts escaped), parent STRING,
    depth INT, parent_feature STRING, branch_value STRING,
    split_feature STRING, split_index INT, n LONG, entropy DOUBLE,
    majority <label type>, weighted_entropy DOUBLE, gain DOUBLE,
    is_leaf BOOLEAN

``max_depth`` counts the levels at which a best feature is chosen, as in the
reference: with 3, the root and its children are split, and the grandchildren
are leaves whose best feature is still named (``split_feature``).
Options follow the reference by default: a feature may be reused below
itself (``reuse_features``) and pure nodes are still split
(``split_pure_nodes``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from entrotree.functions.exprs import (NULL_BRANCH, child_path, escaped_part, pick_feature, sql_literal, sql_name,
                                       sql_path_part, sql_text, value_type_of)
from entrotree.operators.counts import compact_rows, contingency, worth_merging
from entrotree.operators.entropy import best_feature, node_stats, value_stats, weighted_scores
from entrotree.runtime import broadcast_if_small, materialize

# Splits of a level that are compiled into one expression; more are joined.
FEW_SPLITS = 64

TREE_COLUMNS = ["node", "parent", "depth", "parent_feature", "branch_value",
                "split_feature", "split_index", "n", "entropy", "majority",
                "weighted_entropy", "gain", "is_leaf"]


def prepare_rows(df: DataFrame, features: Sequence[str], label: str, *,
                 by: Sequence[str] = (), weight: str | None = None,
                 value_type: str | None = "int", compact: bool | str = True) -> tuple[DataFrame, str | None]:
    """Project (and by default compact) the fit input.

    Features are cast to ``value_type`` if given.  Returns ``(rows, weight_column)`` with columns ``by..., features..., _y,
    [_w,] node``; rows with a null label are dropped and every row starts at
    the root node ``""``.  The compacted table is materialised, so ``node`` is
    a stored column there (not a literal the optimiser would fold into the
    first level's join).
    """
    cols = [*by, *[F.col(f).cast(value_type).alias(f) if value_type else F.col(f) for f in features],
            F.col(label).alias("_y")]
    if weight:
        cols.append(F.col(weight).alias("_w"))
    rows = df.select(*cols).where(F.col("_y").isNotNull())
    w = "_w" if weight else None
    if compact == "auto":
        compact = worth_merging(rows, [*by, *features, "_y"])
    if compact:
        rows = compact_rows(rows, [*by, *features, "_y"], weight=w, out="_w")
        w = "_w"
    rows = rows.withColumn("node", F.lit(""))
    if compact:
        rows = materialize(rows)
    return rows, w


def feature_set_exprs(feature_sets: Mapping, by: Sequence[str]):
    """Expressions for per-key feature sets (one ``by`` column).

    Returns ``(allowed, first, uses)``: ``allowed`` is true for unpivoted
    (key, feature) pairs the key's tree may use, ``first`` is the key's first
    feature, ``uses(f)`` tells whether the key's set contains feature ``f``.
    """
    if len(by) != 1:
        raise ValueError("feature_sets needs exactly one by column")
    sets = F.create_map(*[x for k, fs in feature_sets.items()
                          for x in (F.lit(k), F.array(*[F.lit(f) for f in fs]))])
    mine = F.element_at(sets, F.col(by[0]))
    return (F.array_contains(mine, F.col("feature")), F.element_at(mine, 1),
            lambda f: F.array_contains(mine, F.lit(f)))


def case_of(splits: Sequence[Row], by: Sequence[str], by_types: Mapping[str, str],
            then: Callable[[Row], str]) -> str:
    """SQL text: what ``then`` gives for the split of a row's (by, node), else null."""
    whens = []
    for r in splits:
        own = [f"{sql_name(k)} <=> {sql_literal(r[k], by_types[k])}" for k in by]
        whens.append(f"WHEN {' AND '.join([*own, 'node = ' + sql_text(r['node'])])} THEN {then(r)}")
    return f"CASE {' '.join(whens)} END"


def route_rows(data: DataFrame, splits: DataFrame, few: Sequence[Row] | None, by: Sequence[str],
               features: Sequence[str], value_type: str) -> DataFrame:
    """Move rows to the child node chosen by their node's split; rows of nodes without a split drop out.

    ``splits`` holds by, node, split_feature, split_index and _big (the largest
    child).  ``few`` has its rows if they are few: the splits are then compiled
    into one expression, with no join.  Adds ``_counted``: whether the row's
    child is to be counted, i.e. is not the largest of its siblings.
    """
    keep = [c for c in data.columns if c not in ("node", "_counted", "_big")]
    if few is not None:
        def child(r: Row) -> str:
            path = (f"concat({sql_text(r['node'] + '/' + escaped_part(r['split_feature']) + '=')}, coalesce("
                    f"{sql_path_part(f'CAST({sql_name(r.split_feature)} AS {value_type})')}, {sql_text(NULL_BRANCH)}))")
            return f"array(named_struct('node', {path}, '_big', {sql_text(r['_big'])}))"
        # A generator, so that later levels read the node and do not evaluate its expression again.
        routed = data.select(*keep, F.inline(F.expr(case_of(few, by, dict(data.dtypes), child))))
    else:
        value = pick_feature(features, "split_index", cast=value_type)
        routed = data.select(*keep, "node").join(broadcast_if_small(splits), [*by, "node"]).select(
            *keep, child_path("node", "split_feature", value).alias("node"), "_big")
    return routed.withColumn("_counted", F.col("node") != F.col("_big"))


def with_largest_children(parents: DataFrame, counted: DataFrame, families: DataFrame, by: Sequence[str],
                          rows_by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Counts of all children: those counted, and each largest one as its parent minus its siblings.

    ``parents`` and ``counted`` have rows_by, node, feature, values, label, n;
    ``families`` has by, parent, big (the largest child) of every split node,
    ``counted`` a column ``_big`` beside.
    """
    own = [*rows_by, "node", "feature", *values, "label"]
    rest = [c for c in own if c != "node"]
    both = F.explode(F.array(F.struct(F.col("node").alias("node"), F.col("n").alias("n")),
                             F.struct(F.col("_big").alias("node"), (-F.col("n")).alias("n")))).alias("_c")
    change = counted.select(*rest, both).select(*rest, F.col("_c.node").alias("node"), F.col("_c.n").alias("n"))
    above = parents.join(broadcast_if_small(families.withColumnRenamed("parent", "node")), [*by, "node"]).select(
        *rest, F.col("big").alias("node"), "n")
    return (change.unionByName(above).groupBy(*own).agg(F.sum("n").cast("long").alias("n")).where("n > 0"))


def fit_id3(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 3, *,
            by: Sequence[str] = (), weight: str | None = None, value_type: str | None = None,
            reuse_features: bool = True, split_pure_nodes: bool = True,
            compact: bool | str = True, tie: str = "high",
            feature_sets: Mapping | None = None) -> DataFrame:
    """Grow a multiway entropy tree; ``by`` grows one independent tree per key.

    ``feature_sets`` (with exactly one ``by`` column) maps each key value to
    the features its tree may use, so trees over different feature groups
    grow in the same jobs; ``features`` is then the union, in tie-break order.
    """
    if max_depth < 1:
        raise ValueError("max_depth must be >= 1")
    features = list(features)
    by = list(by)
    keys = [*by, "node"]
    value_type = value_type or value_type_of(df, features)
    allowed = first = None
    if feature_sets is not None:
        allowed, first, _ = feature_set_exprs(feature_sets, by)
    data, w = prepare_rows(df, features, label, by=by, weight=weight,
                           value_type=value_type, compact=compact)

    nodes = cont = families = None
    levels = []
    for depth in range(max_depth):
        # The one pass over the rows of this level (all nodes at once).
        if families is None:
            cont = contingency(data, features, "_y", keys=keys, weight=w, value_type=value_type, where=allowed)
        else:
            counted = contingency(data.where("_counted"), features, "_y", keys=[*keys, "_big"], weight=w,
                                  value_type=value_type, where=allowed)
            cont = with_largest_children(cont, counted, families, by, by, ["value"])
        cont = materialize(cont)
        vstats = value_stats(cont, keys, tie=tie)
        if nodes is None:
            nodes = node_stats(cont, keys, features[0] if first is None else first,
                               tie=tie).select(
                *keys,
                F.lit(None).cast("string").alias("parent"),
                F.lit(None).cast("string").alias("parent_feature"),
                F.lit(None).cast("string").alias("branch_value"),
                "n", "entropy", "majority",
                F.array().cast("array<string>").alias("_used"))
        largest = F.max_by(child_path("node", "feature", "value"), F.struct("n", child_path("node", "feature", "value")))
        fs = weighted_scores(vstats, features, keys, largest.alias("_big"))
        if not reuse_features:
            fs = (fs.join(nodes.select(*keys, "_used"), keys)
                    .where(~F.array_contains("_used", F.col("feature")))
                    .drop("_used"))
        best = best_feature(fs, keys).select(
            *keys, F.col("feature").alias("split_feature"),
            F.col("feature_index").alias("split_index"), "weighted_entropy", "_big")
        is_last = depth == max_depth - 1
        stop = F.col("split_feature").isNull() | F.lit(is_last)
        if not split_pure_nodes:
            stop = stop | (F.col("entropy") <= 0)
        level = materialize(nodes.join(best, keys, "left")
                            .withColumn("depth", F.lit(depth))
                            .withColumn("gain", F.col("entropy") - F.col("weighted_entropy"))
                            .withColumn("is_leaf", stop))
        levels.append(level)
        if is_last:
            break

        expand = level.where(~F.col("is_leaf")).select(*keys, "split_feature", "split_index", "_used", "_big")
        few = expand.limit(FEW_SPLITS + 1).collect()
        if not few:
            break
        # Child nodes: the (feature, value) groups of each node's split feature.
        chosen = expand.drop("_big").withColumnRenamed("split_feature", "feature")
        chosen = F.broadcast(chosen) if len(few) <= FEW_SPLITS else broadcast_if_small(chosen)
        nodes = (vstats.join(chosen, [*keys, "feature"])
                 .select(*by,
                         child_path("node", "feature", "value").alias("node"),
                         F.col("node").alias("parent"),
                         F.col("feature").alias("parent_feature"),
                         F.col("value").cast("string").alias("branch_value"),
                         "n", "entropy", "majority",
                         F.array_union("_used", F.array(F.col("feature"))).alias("_used")))
        families = expand.select(*by, F.col("node").alias("parent"), F.col("_big").alias("big"))
        # Rows follow their node's split (rows of leaves drop out).
        data = route_rows(data, expand.drop("_used"), few if len(few) <= FEW_SPLITS else None, by, features, value_type)

    tree = reduce(lambda a, b: a.unionByName(b), levels)
    return tree.select(*by, *TREE_COLUMNS)
