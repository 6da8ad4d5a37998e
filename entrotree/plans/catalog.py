"""The named queries of the driver contract, one per operator family.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the driver's parquet
tables (or the fixture views Spark derives from them).  Doubles are rounded
to 6 places here, in the query output only, so that results compare exactly
with the equivalent SQL in ``entrotree.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entrotree.operators.binary import fit_binary
from entrotree.operators.counts import class_histogram, contingency
from entrotree.operators.entropy import best_feature, dataset_entropy, feature_scores, value_stats
from entrotree.operators.grow import fit_id3
from entrotree.operators.metrics import confusion_counts, confusion_matrix, label_metrics, summary
from entrotree.operators.prep import bin_occupancy, equal_width_bins
from entrotree.operators.score import leaf_labels, predict, tree_listing
from entrotree.operators.validate import (assign_equal_folds, assign_folds, cross_validate, exact_split,
                                          feature_group_error, keyed_split, random_split, split_frames)
from entrotree.sources.delimited import read_binned_csv, split_fields, typed_fields
from entrotree.sources.fixtures import (DOC_FEATURES, EV_FEATURES, LI_FEATURES, URL_FEATURES, doc_bins,
                                        ev_bins, li_bins, url_parts)
from entrotree.runtime import checkpoint_dir, materialize
from entrotree.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

SEED = 200
DEPTH = 3
FEATURE_GROUPS = {"g01": ["f0", "f1"], "g23": ["f2", "f3"], "g456": ["f4", "f5", "f6"]}


def r6(c: str | Column) -> Column:
    """Round to 6 places; ``+ 0.0`` turns a negative zero into zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


# --------------------------------------------------------------- scans, prep
def scan_count(spark, sf):
    return read_table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def peek(spark, sf):
    li = read_table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate"]
    return (li.orderBy(*order).limit(2)
              .withColumn("l_shipdate", F.col("l_shipdate").cast("string")))


_BIN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def equal_width_bins_q(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_BIN_COLS)
    return equal_width_bins(li, _BIN_COLS, bins=7)


def bin_occupancy_q(spark, sf):
    li = read_table(spark, sf, "lineitem").select(*_BIN_COLS)
    return bin_occupancy(equal_width_bins(li, _BIN_COLS, bins=7), _BIN_COLS)


# ------------------------------------------------------------ counts, entropy
def class_histogram_q(spark, sf):
    return class_histogram(li_bins(spark, sf), "y")


def class_histogram_events(spark, sf):
    return class_histogram(ev_bins(spark, sf), "y")


def dataset_entropy_q(spark, sf):
    return dataset_entropy(li_bins(spark, sf), "y").select("n", r6("entropy").alias("entropy"))


def dataset_entropy_events(spark, sf):
    return dataset_entropy(ev_bins(spark, sf), "y").select("n", r6("entropy").alias("entropy"))


def unpivot_counts(spark, sf):
    cont = contingency(li_bins(spark, sf), LI_FEATURES, "y")
    return cont.select(F.concat_ws("_", "feature", F.col("value").cast("string")).alias("key"),
                       "feature", "value", "label", "n")


def _vstats(df, features, value_type="int"):
    return value_stats(contingency(df, features, "y", value_type=value_type))


def value_entropy(spark, sf):
    vs = _vstats(li_bins(spark, sf), LI_FEATURES)
    return vs.select("feature", "value", "n", r6("entropy").alias("entropy"), "majority")


def value_entropy_docs(spark, sf):
    vs = _vstats(doc_bins(spark, sf), DOC_FEATURES, "string")
    return vs.select("feature", "value", "n", r6("entropy").alias("entropy"), "majority")


def majority_label_events(spark, sf):
    vs = _vstats(ev_bins(spark, sf), EV_FEATURES)
    return vs.select("feature", "value", "n", "majority")


def _scores(df, features, value_type="int"):
    return feature_scores(contingency(df, features, "y", value_type=value_type), features)


def _wh(fs):
    return fs.select("feature", "feature_index", "node_n", "n_values",
                     r6("weighted_entropy").alias("weighted_entropy"))


def weighted_entropy(spark, sf):
    return _wh(_scores(li_bins(spark, sf), LI_FEATURES))


def weighted_entropy_docs(spark, sf):
    return _wh(_scores(doc_bins(spark, sf), DOC_FEATURES, "string"))


def weighted_entropy_events(spark, sf):
    return _wh(_scores(ev_bins(spark, sf), EV_FEATURES))


def info_gain(spark, sf):
    fs = _scores(li_bins(spark, sf), LI_FEATURES)
    return fs.select("feature", r6("node_entropy").alias("node_entropy"),
                     r6("weighted_entropy").alias("weighted_entropy"), r6("gain").alias("gain"))


def min_weighted_entropy(spark, sf):
    parts = [("li_bins", li_bins(spark, sf), LI_FEATURES, "int"),
             ("doc_bins", doc_bins(spark, sf), DOC_FEATURES, "string"),
             ("ev_bins", ev_bins(spark, sf), EV_FEATURES, "int")]
    out = None
    for name, df, feats, vt in parts:
        m = _scores(df, feats, vt).agg(F.min("weighted_entropy").alias("w"))
        m = m.select(F.lit(name).alias("table_name"), r6("w").alias("min_weighted_entropy"))
        out = m if out is None else out.unionByName(m)
    return out


# ------------------------------------------------------------------- tree
def root_feature(spark, sf):
    best = best_feature(_scores(li_bins(spark, sf), LI_FEATURES))
    return best.select("feature", "feature_index", r6("weighted_entropy").alias("weighted_entropy"))


def root_profile(spark, sf):
    df = li_bins(spark, sf)
    # read twice below (scores and the winner's profile): computed once
    cont = materialize(contingency(df, LI_FEATURES, "y"))
    best = best_feature(feature_scores(cont, LI_FEATURES)).select("feature")
    vs = value_stats(cont).join(best, "feature", "left_semi")
    return vs.select("feature", "value", "n", r6("entropy").alias("entropy"), "majority")


def _li_tree(spark, sf, train_only=False):
    df = li_bins(spark, sf)
    if train_only:
        df = split_frames(df, "k", seed=SEED, train_percent=80)[0]
    return fit_id3(df, LI_FEATURES, "y", DEPTH)


def _level_counts(spark, sf, depth):
    """Contingency of every node at ``depth``: rows are routed to their node by
    a tree grown one level deeper, then counted in one job keyed by node."""
    df = li_bins(spark, sf)
    tree = fit_id3(df, LI_FEATURES, "y", depth + 1)
    routed = predict(df, tree, LI_FEATURES, node_out="node")
    return contingency(routed, LI_FEATURES, "y", keys=["node"])


def branch_counts(spark, sf):
    return _level_counts(spark, sf, 1)


def path_counts(spark, sf):
    return _level_counts(spark, sf, 2)


def _level_features(spark, sf, depth):
    tree = _li_tree(spark, sf)
    return tree.where(F.col("depth") == depth).select(
        "node", "split_feature", r6("weighted_entropy").alias("weighted_entropy"))


def level2_features(spark, sf):
    return _level_features(spark, sf, 1)


def level3_features(spark, sf):
    return _level_features(spark, sf, 2)


def id3_tree(spark, sf):
    return _tree_cols(_li_tree(spark, sf))


def id3_tree_docs(spark, sf):
    tree = fit_id3(doc_bins(spark, sf), DOC_FEATURES, "y", DEPTH, value_type="string")
    return tree.select("node", "depth", "split_feature", "n", r6("entropy").alias("entropy"),
                       "majority", "is_leaf")


def tree_listing_q(spark, sf):
    return tree_listing(_li_tree(spark, sf), numeric=True)


def leaf_labels_q(spark, sf):
    return leaf_labels(_li_tree(spark, sf))


def score_rows(spark, sf):
    df = li_bins(spark, sf)
    return predict(df, _li_tree(spark, sf), LI_FEATURES).select("k", "y", "prediction")


def score_rows_compiled(spark, sf):
    """The tree as one expression."""
    df = li_bins(spark, sf)
    scored = predict(df, _li_tree(spark, sf), LI_FEATURES, node_out="node", compiled_nodes=1_000)
    return scored.select("k", "y", "node", "prediction")


def score_rows_joined(spark, sf):
    """The same walked by one join a level, as trees of many nodes are."""
    df = li_bins(spark, sf)
    scored = predict(df, _li_tree(spark, sf), LI_FEATURES, node_out="node", compiled_nodes=0)
    return scored.select("k", "y", "node", "prediction")


def _holdout_scored(spark, sf):
    df = li_bins(spark, sf)
    tree = _li_tree(spark, sf, train_only=True)
    test = split_frames(df, "k", seed=SEED, train_percent=80)[1]
    return predict(test, tree, LI_FEATURES, node_out="node")


def score_unseen(spark, sf):
    """A tree grown on a part of the values; the others stop at depth 0 or 1."""
    df = li_bins(spark, sf)
    tree = fit_id3(df.where("f2 <= 3 AND f0 <= 4"), LI_FEATURES, "y", DEPTH)
    return predict(df, tree, LI_FEATURES, node_out="node").select("k", "y", "node", "prediction")


def _tree_cols(tree):
    return tree.select("node", "parent", "depth", "parent_feature", "branch_value",
                       "split_feature", "n", r6("entropy").alias("entropy"), "majority",
                       r6("weighted_entropy").alias("weighted_entropy"),
                       r6("gain").alias("gain"), "is_leaf")


def id3_tree_no_reuse(spark, sf):
    return _tree_cols(fit_id3(li_bins(spark, sf), LI_FEATURES, "y", DEPTH, reuse_features=False))


def id3_tree_stop_pure(spark, sf):
    return _tree_cols(fit_id3(li_bins(spark, sf), LI_FEATURES, "y", DEPTH, split_pure_nodes=False))


def _url_tree(spark, sf):
    df = url_parts(spark, sf)
    return df, fit_id3(df, URL_FEATURES, "y", 2)


def id3_tree_paths(spark, sf):
    """Nominal values that hold the characters of node paths."""
    return _url_tree(spark, sf)[1].select("node", "depth", "split_feature", "n",
                                          r6("entropy").alias("entropy"), "majority", "is_leaf")


def score_paths(spark, sf):
    df, tree = _url_tree(spark, sf)
    return predict(df, tree, URL_FEATURES, node_out="node").select("k", "y", "node", "prediction")


def _holdout_conf(spark, sf):
    return confusion_counts(_holdout_scored(spark, sf), "y")


# ---------------------------------------------------------------- metrics
def confusion(spark, sf):
    return confusion_matrix(_holdout_conf(spark, sf))


def _summary_col(name):
    def q(spark, sf):
        return summary(_holdout_conf(spark, sf)).select(r6(name).alias(name))
    q.__name__ = name
    return q


def _per_label_col(name):
    def q(spark, sf):
        lm = label_metrics(_holdout_conf(spark, sf))
        return lm.select("label", r6(name).alias(name))
    q.__name__ = f"{name}_per_label"
    return q


def metrics_summary(spark, sf):
    s = summary(_holdout_conf(spark, sf))
    return s.select("n", "correct", *[r6(c).alias(c) for c in
                                      ("accuracy", "error_rate", "precision", "recall",
                                       "precision_macro", "recall_macro")])


# ------------------------------------------------------------- validation
def holdout_split(spark, sf):
    li = read_table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return keyed_split(li, "k", seed=SEED, train_percent=80).groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n"))


def holdout_split_70(spark, sf):
    li = read_table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return keyed_split(li, "k", seed=SEED, train_percent=70).groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n"))


def fold_sizes(spark, sf):
    li = read_table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    folded = keyed_split(assign_folds(li, "k", k=5, seed=SEED), "k", seed=SEED, train_percent=80)
    return folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("is_train").cast("long")).alias("n_train"))


def _keys_of(folded, *by):
    return folded.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("k").cast("long").alias("sum_k"))


def fold_sizes_equal(spark, sf):
    """Folds by exact rank: their sizes and, as a check of their rows, sums of keys."""
    li = read_table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return _keys_of(assign_equal_folds(li, "k", k=7, seed=SEED), "fold")


def holdout_exact_70(spark, sf):
    li = read_table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return _keys_of(exact_split(li, "k", seed=SEED, train_percent=70), "is_train")


def random_split_sizes(spark, sf):
    """Spark's seeded ``randomSplit`` 80:20 (V1 literal form).  Which rows a side gets
    depends on the input partitioning, so its size is held against its share."""
    li = materialize(read_table(spark, sf, "lineitem").select("l_orderkey"))
    sides = random_split(li, (0.8, 0.2), seed=SEED)
    n, out = li.count(), None
    for side, share, rows in zip(("train", "test"), (0.8, 0.2), sides, strict=True):
        most = 6 * (0.16 * n) ** 0.5  # six standard deviations
        one = rows.agg((F.abs(F.count(F.lit(1)) - share * n) <= most).alias("near_share")).select(
            F.lit(side).alias("side"), "near_share")
        out = one if out is None else out.unionByName(one)
    return out


def random_split_partition(spark, sf):
    """The sides of ``randomSplit`` hold every row once."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey")
    train, test = random_split(li.withColumn("row", F.monotonically_increasing_id()), (0.8, 0.2), seed=SEED)
    sides = train.select("row", F.lit(1).alias("s")).unionAll(test.select("row", F.lit(1).alias("s")))
    per_row = sides.groupBy("row").agg(F.sum("s").alias("s"))
    return per_row.agg(F.count("*").alias("n"), F.sum("s").cast("long").alias("n_sides"),
                       F.sum((F.col("s") > 1).cast("long")).alias("n_both"))


def text_fields(spark, sf):
    """Lines of text, split on a character that regular expressions give a meaning."""
    li = read_table(spark, sf, "lineitem")
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    return li.select(line.alias("line")).select(*split_fields(F.col("line"), ["a", "b", "c"], sep="|"))


_TYPED = ["a", "b", "c", "d", "e", "f"]


def _typed_lines(spark, sf):
    """Lines of an integer, a wide integer, a number, a text, and two columns with empty fields."""
    li = read_table(spark, sf, "lineitem")
    odd = F.col("l_linenumber") % 2 == 1
    fields = [F.col("l_orderkey"), F.col("l_orderkey") * 4_000_000_000 + F.col("l_linenumber"), F.col("l_extendedprice"),
              F.col("l_returnflag"), F.when(odd, F.col("l_partkey").cast("string")).otherwise(F.lit("")),
              F.when(odd, F.col("l_linenumber").cast("string")).otherwise(F.lit(" x"))]
    return li.select(F.concat_ws("|", *[f.cast("string") for f in fields]).alias("line"))


def typed_fields_q(spark, sf):
    """Types inferred from split lines."""
    texts = _typed_lines(spark, sf).select(*split_fields(F.col("line"), _TYPED, sep="|", kind="string"))
    return typed_fields(texts)


def csv_scan(spark, sf):
    """The same lines written as text files with a header, and read as a CSV with inferred types."""
    path = f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines = _typed_lines(spark, sf).select(F.concat(F.lit("|".join(_TYPED) + "\n"), F.lit("")).alias("head"), "line")
    # The files of a folder have the same header each: one line before every file's first.
    first = F.monotonically_increasing_id() == F.spark_partition_id().cast("long") * (1 << 33)
    lines.select(F.concat(F.when(first, F.col("head")).otherwise(F.lit("")), F.col("line"))).write.text(path)
    return read_binned_csv(spark, path, columns=_TYPED, sep="|")


CUT_CASES = {"near": ["near"], "huge": ["huge"], "endless": ["endless"], "wide": ["wide"]}


def binary_tree_cuts(spark, sf):
    """Values that a rounded midpoint cannot separate: neighbouring doubles, sums beyond the largest double,
    infinity, and integers that doubles cannot tell apart.  One tree for each kind."""
    n = F.col("l_linenumber")
    li = read_table(spark, sf, "lineitem").select(
        (F.lit(1.0) + n * F.lit(2.0 ** -52)).alias("near"), (n * F.lit(2.5e307)).alias("huge"),
        F.when(n == 7, F.lit(float("inf"))).when(n == 1, F.lit(float("-inf"))).otherwise(n.cast("double")).alias("endless"),
        (F.lit(1 << 53) + n).alias("wide"),
        F.when((n >= 3) & ((F.col("l_orderkey") % 9 > 0) | (n == 7)), 1).otherwise(0).alias("y"))
    each = li.withColumn("kind", F.explode(F.array(*map(F.lit, CUT_CASES))))
    tree = fit_binary(each, list(CUT_CASES), "y", 3, by=["kind"], feature_sets=CUT_CASES)
    return tree.select("kind", "depth", "split_feature", "threshold", "cut", "n", r6("entropy").alias("entropy"),
                       "majority", r6("weighted_entropy").alias("weighted_entropy"), "is_leaf")


def binary_root_split(spark, sf):
    tree = fit_binary(li_bins(spark, sf), LI_FEATURES, "y", 1)
    return tree.where(F.col("depth") == 0).select(
        "split_feature", "threshold", r6("weighted_entropy").alias("weighted_entropy"),
        r6("gain").alias("gain"))


def binary_tree(spark, sf):
    tree = fit_binary(li_bins(spark, sf), LI_FEATURES, "y", DEPTH)
    return tree.select("node", "parent", "depth", "split_feature", "threshold", "n",
                       r6("entropy").alias("entropy"), "majority",
                       r6("weighted_entropy").alias("weighted_entropy"), "is_leaf")


def _binary_cols(tree):
    return tree.select("depth", "split_feature", r6("threshold").alias("threshold"), "n",
                       r6("entropy").alias("entropy"), "majority",
                       r6("weighted_entropy").alias("weighted_entropy"), "is_leaf")


def binary_tree_wide(spark, sf):
    """A feature with about as many values as rows."""
    li = read_table(spark, sf, "lineitem")
    y = F.when((F.col("l_extendedprice") > 40000) | (F.col("l_linenumber") == 2), 1).otherwise(0)
    df = li.select(F.col("l_extendedprice").alias("price"),
                   F.least(F.lit(6), F.floor(F.col("l_tax") * 7 / 0.08)).alias("f2"), y.alias("y"))
    return _binary_cols(fit_binary(df, ["price", "f2"], "y", 2))


def binary_tree_nulls(spark, sf):
    """A feature that is null in a part of the rows."""
    df = li_bins(spark, sf).withColumn("f0", F.when(F.col("f3") % 3 != 1, F.col("f0")))
    return _binary_cols(fit_binary(df, LI_FEATURES, "y", 2))


def weighted_entropy_wide(spark, sf):
    li = read_table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    return _wh(_scores(li, ["part", "supp"], "bigint"))


def cv_fold_metrics_docs(spark, sf):
    fm = cross_validate(doc_bins(spark, sf), DOC_FEATURES, "y", "k", k=5, seed=SEED, holdout_percent=30,
                        max_depth=DEPTH, kind="id3", holdout=False)["fold_metrics"]
    return fm.select("model", "n", *[r6(c).alias(c) for c in ("accuracy", "precision_macro", "recall_macro")])


def cv_holdout_events(spark, sf):
    s = cross_validate(ev_bins(spark, sf), EV_FEATURES, "y", "k", k=5, seed=SEED, holdout_percent=30,
                       max_depth=DEPTH, kind="binary", positive="click")["holdout_summary"]
    return s.select("n", "correct", *[r6(c).alias(c) for c in (
        "accuracy", "precision", "recall", "precision_macro", "recall_macro")])


def confusion_events(spark, sf):
    train, test = split_frames(ev_bins(spark, sf), "k", seed=SEED, train_percent=80)
    tree = fit_id3(train, EV_FEATURES, "y", 2)
    return confusion_matrix(confusion_counts(predict(test, tree, EV_FEATURES), "y"))


def binary_tree_events(spark, sf):
    tree = fit_binary(ev_bins(spark, sf), EV_FEATURES, "y", DEPTH)
    return tree.select("node", "depth", "split_feature", "threshold", "n",
                       r6("entropy").alias("entropy"), "majority", "is_leaf")


def id3_tree_events(spark, sf):
    tree = fit_id3(ev_bins(spark, sf), EV_FEATURES, "y", 2)
    return tree.select("node", "depth", "split_feature", "n", r6("entropy").alias("entropy"),
                       "majority", r6("weighted_entropy").alias("weighted_entropy"), "is_leaf")


def _cv(spark, sf, holdout=True):
    return cross_validate(li_bins(spark, sf), LI_FEATURES, "y", "k", k=5, seed=SEED,
                          holdout_percent=30, max_depth=DEPTH, kind="binary", holdout=holdout)


def cv_fold_metrics(spark, sf):
    fm = _cv(spark, sf, holdout=False)["fold_metrics"]
    return fm.select("model", "n", *[r6(c).alias(c) for c in
                                     ("accuracy", "precision_macro", "recall_macro")])


def cv_mean(spark, sf):
    m = _cv(spark, sf, holdout=False)["mean"]
    return m.select(*[r6(c).alias(c) for c in ("accuracy", "precision_macro", "recall_macro")])


def cv_best_fold(spark, sf):
    b = _cv(spark, sf, holdout=False)["best"]
    return b.select("model", r6("accuracy").alias("accuracy"))


def cv_holdout(spark, sf):
    s = _cv(spark, sf)["holdout_summary"]
    return s.select("n", "correct", *[r6(c).alias(c) for c in
                                      ("accuracy", "precision_macro", "recall_macro")])


def cv_holdout_labels(spark, sf):
    lm = _cv(spark, sf)["holdout_labels"]
    return lm.select("label", "tp", "n_actual", "n_predicted",
                     r6("precision").alias("precision"), r6("recall").alias("recall"))


def feature_group_error_q(spark, sf):
    e = feature_group_error(li_bins(spark, sf), FEATURE_GROUPS, "y", "k", seed=SEED,
                            train_percent=70, max_depth=DEPTH, kind="id3")
    return e.select("group", "n", r6("error_rate").alias("error_rate"))


def best_feature_group(spark, sf):
    e = feature_group_error(li_bins(spark, sf), FEATURE_GROUPS, "y", "k", seed=SEED,
                            train_percent=70, max_depth=DEPTH, kind="id3")
    return e.agg(F.min_by(F.col("group"), F.struct(F.round("error_rate", 12), F.col("group")))
                  .alias("group"), r6(F.min("error_rate")).alias("error_rate"))


QUERIES: dict[str, Query] = {
    "scan_count": scan_count,
    "peek": peek,
    "equal_width_bins": equal_width_bins_q,
    "bin_occupancy": bin_occupancy_q,
    "class_histogram": class_histogram_q,
    "class_histogram_events": class_histogram_events,
    "dataset_entropy": dataset_entropy_q,
    "dataset_entropy_events": dataset_entropy_events,
    "unpivot_counts": unpivot_counts,
    "value_entropy": value_entropy,
    "value_entropy_docs": value_entropy_docs,
    "majority_label_events": majority_label_events,
    "weighted_entropy": weighted_entropy,
    "weighted_entropy_docs": weighted_entropy_docs,
    "weighted_entropy_events": weighted_entropy_events,
    "weighted_entropy_wide": weighted_entropy_wide,
    "info_gain": info_gain,
    "min_weighted_entropy": min_weighted_entropy,
    "root_feature": root_feature,
    "root_profile": root_profile,
    "branch_counts": branch_counts,
    "path_counts": path_counts,
    "level2_features": level2_features,
    "level3_features": level3_features,
    "id3_tree": id3_tree,
    "id3_tree_docs": id3_tree_docs,
    "tree_listing": tree_listing_q,
    "leaf_labels": leaf_labels_q,
    "score_rows": score_rows,
    "score_rows_compiled": score_rows_compiled,
    "score_rows_joined": score_rows_joined,
    "score_unseen": score_unseen,
    "id3_tree_no_reuse": id3_tree_no_reuse,
    "id3_tree_stop_pure": id3_tree_stop_pure,
    "id3_tree_paths": id3_tree_paths,
    "score_paths": score_paths,
    "confusion": confusion,
    "confusion_events": confusion_events,
    "accuracy": _summary_col("accuracy"),
    "precision_pos": _summary_col("precision"),
    "precision_macro": _summary_col("precision_macro"),
    "precision_per_label": _per_label_col("precision"),
    "recall_pos": _summary_col("recall"),
    "recall_macro": _summary_col("recall_macro"),
    "recall_per_label": _per_label_col("recall"),
    "error_rate": _summary_col("error_rate"),
    "metrics_summary": metrics_summary,
    "holdout_split": holdout_split,
    "holdout_split_70": holdout_split_70,
    "fold_sizes": fold_sizes,
    "fold_sizes_equal": fold_sizes_equal,
    "holdout_exact_70": holdout_exact_70,
    "random_split_sizes": random_split_sizes,
    "random_split_partition": random_split_partition,
    "text_fields": text_fields,
    "typed_fields": typed_fields_q,
    "csv_scan": csv_scan,
    "binary_root_split": binary_root_split,
    "binary_tree_cuts": binary_tree_cuts,
    "binary_tree": binary_tree,
    "binary_tree_events": binary_tree_events,
    "binary_tree_wide": binary_tree_wide,
    "binary_tree_nulls": binary_tree_nulls,
    "id3_tree_events": id3_tree_events,
    "cv_fold_metrics": cv_fold_metrics,
    "cv_mean": cv_mean,
    "cv_best_fold": cv_best_fold,
    "cv_holdout": cv_holdout,
    "cv_holdout_labels": cv_holdout_labels,
    "cv_fold_metrics_docs": cv_fold_metrics_docs,
    "cv_holdout_events": cv_holdout_events,
    "feature_group_error": feature_group_error_q,
    "best_feature_group": best_feature_group,
}
