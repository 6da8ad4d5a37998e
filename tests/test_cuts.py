"""Binary trees: cuts that separate, ranges, folds by difference, routing with and without joins."""

from __future__ import annotations

import math

import pytest
from conftest import SF001
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entrotree.operators import binary, grow
from entrotree.operators.binary import fit_binary
from entrotree.operators.grow import fit_id3
from entrotree.operators.score import predict
from entrotree.operators.validate import cross_validate
from entrotree.runtime import materialize
from entrotree.sources.fixtures import LI_FEATURES, li_bins

INF = float("inf")
APART = [([2.0, INF], "double"), ([1.0, math.nextafter(1.0, 2)], "double"), ([1e308, 1.7e308], "double"),
         ([-INF, 3.0], "double"), ([0.0, 5e-324], "double"), ([2**53, 2**53 + 1], "bigint"),
         ([-2**63, 2**63 - 1], "bigint"), ([-3, -2], "int")]


@pytest.mark.parametrize("values, kind", APART)
def test_a_cut_separates_its_neighbours(spark, values, kind):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values) for _ in range(5)], f"a {kind}, y int")
    tree = fit_binary(df, ["a"], "y", 2)
    assert tree.where("depth = 0").first()["weighted_entropy"] == 0
    assert [r["n"] for r in tree.where("depth = 1").collect()] == [5, 5]
    for compiled in (512, 0):
        assert predict(df, tree, ["a"], compiled_nodes=compiled).where("y <> prediction").count() == 0


numbers = st.one_of(st.sampled_from([v for vs, k in APART if k == "double" for v in vs]), st.floats(allow_nan=True), st.none())
wide = st.one_of(st.integers(-2**63, 2**63 - 1), st.integers(2**53 - 3, 2**53 + 3), st.none())


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(numbers, wide, st.integers(0, 1)), min_size=2, max_size=30))
def test_both_sides_of_every_split_hold_the_counted_rows(spark, rows):
    df = spark.createDataFrame(rows, "a double, b bigint, y int")
    tree = fit_binary(df, ["a", "b"], "y", 3)
    nodes = {r["node"]: r["n"] for r in tree.where("is_leaf").collect()}
    for compiled in (512, 0):
        got = predict(df, tree, ["a", "b"], node_out="node", compiled_nodes=compiled).groupBy("node").count().collect()
        assert {r["node"]: r["count"] for r in got} == nodes


def _rows(tree, *columns):
    return sorted(map(str, tree.select(*columns).collect()))


COLUMNS = ["node", "depth", "split_feature", "threshold", "cut", "n", "majority", "is_leaf"]


def test_many_ranges_give_the_same_tree(spark, monkeypatch):
    df = spark.range(3000).select(
        (F.pmod(F.col("id") * 7919, F.lit(3000)) / 7).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 977).alias("b"),
        ((F.col("id") * 7919 % 3000 > 1234) != (F.col("id") % 11 == 0)).cast("int").alias("y"))
    want = fit_binary(df, ["a", "b"], "y", 2)
    monkeypatch.setattr(binary, "RANGE_ROWS", 50)
    cont = binary._contingency(df.withColumnRenamed("y", "_y").withColumn("node", F.lit("")), ["a", "b"], ["node"], None)
    dealt, several = binary._ranged(cont, ["node"])
    assert several and dealt.select("_range").distinct().count() > 64
    assert _rows(fit_binary(df, ["a", "b"], "y", 2), *COLUMNS) == _rows(want, *COLUMNS)


def test_levels_of_many_splits_are_joined(spark, monkeypatch):
    df = li_bins(spark, SF001)
    want = fit_binary(df, LI_FEATURES, "y", 3), fit_id3(df, LI_FEATURES, "y", 3)
    monkeypatch.setattr(binary, "FEW_SPLITS", 0)
    monkeypatch.setattr(grow, "FEW_SPLITS", 0)
    assert _rows(fit_binary(df, LI_FEATURES, "y", 3), *COLUMNS) == _rows(want[0], *COLUMNS)
    few = [c for c in COLUMNS if c not in ("threshold", "cut")]
    assert _rows(fit_id3(df, LI_FEATURES, "y", 3), *few) == _rows(want[1], *few)


def test_only_smaller_children_are_counted(spark):
    df = li_bins(spark, SF001).withColumn("node", F.lit(""))
    tree = fit_id3(df.drop("node"), LI_FEATURES, "y", 2)
    root = tree.where("depth = 0").first()
    sizes = {r["node"]: r["n"] for r in tree.where("depth = 1").collect()}
    big = max(sizes, key=lambda v: (sizes[v], v))
    split = spark.createDataFrame([("", root["split_feature"], root["split_index"], big)],
                                  "node string, split_feature string, split_index int, _big string")
    routed = grow.route_rows(df, split, split.collect(), [], LI_FEATURES, "int")
    assert routed.count() == root["n"] and routed.where("_counted").count() == root["n"] - sizes[big]


def test_fold_models_by_difference_equal_models_of_the_other_folds(spark):
    df = li_bins(spark, SF001).withColumn("fold", (F.col("k") % 3).cast("int"))
    trees = fit_binary(df, LI_FEATURES, "y", 3, fold="fold", k=3)
    for model in range(3):
        alone = fit_binary(df.where(F.col("fold") != model), LI_FEATURES, "y", 3)
        assert _rows(trees.where(F.col("model") == model), *COLUMNS) == _rows(alone, *COLUMNS)


def test_merging_rows_or_not_gives_the_same_trees(spark):
    df = li_bins(spark, SF001)
    trees = [_rows(fit_binary(df, LI_FEATURES, "y", 2, compact=c), *COLUMNS) for c in (True, False, "auto")]
    assert trees[0] == trees[1] == trees[2]
    folds = [sorted(cross_validate(df, LI_FEATURES, "y", "k", k=2, max_depth=1, compact=c, holdout=False)["fold_metrics"]
                    .collect()) for c in (True, "auto")]
    assert folds[0] == folds[1]
    from entrotree.operators.counts import worth_merging
    assert worth_merging(df.select(F.lit(1).alias("a")), ["a"]) and not worth_merging(df, ["k"])


def test_input_columns_keep_their_values(spark):
    rows = [(i % 3, i % 2, i, -i, "x", None, i, i) for i in range(12)]
    df = spark.createDataFrame(rows, "f int, y int, _id long, _pred long, row string, leaf string, _row long, node long")
    for fit in (fit_id3, fit_binary):
        tree = fit(df, ["f"], "y", 2)
        for compiled in (512, 0):
            got = predict(df, tree, ["f"], compiled_nodes=compiled)
            assert sorted(map(str, got.drop("prediction").collect())) == sorted(map(str, df.collect()))


def test_compiled_scores_of_keyed_trees(spark):
    df = li_bins(spark, SF001).withColumn("part", F.concat(F.lit("p'\\"), (F.col("k") % 2).cast("string")))
    for tree in (fit_id3(df, LI_FEATURES, "y", 2, by=["part"]), fit_binary(df, LI_FEATURES, "y", 2, by=["part"])):
        one, two = (predict(df, tree, LI_FEATURES, by=["part"], node_out="at", compiled_nodes=c).select("k", "at", "prediction")
                    for c in (512, 0))
        assert sorted(one.collect()) == sorted(two.collect())
        assert predict(df.withColumn("part", F.lit("?")), tree, LI_FEATURES, by=["part"]).where(
            "prediction is not null").count() == 0


def test_no_task_gets_all_rows_of_a_node(spark, monkeypatch):
    """The counts of a node stay spread: joins with one row a node or label are broadcast."""
    monkeypatch.setattr(binary, "RANGE_ROWS", 100)
    monkeypatch.setattr(binary, "materialize", lambda df: plans.append(df) or materialize(df))
    monkeypatch.setattr(grow, "materialize", lambda df: plans.append(df) or materialize(df))
    for broadcast in ("-1", "10MB"):
        plans = []
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            df = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"),
                                          F.when(F.col("id") % 3 > 0, F.col("id") % 2).otherwise(F.lit(0)).alias("y"))
            binary.fit_binary(df, ["a", "b"], "y", 3).collect()
            grow.fit_id3(df, ["a", "b"], "y", 3, value_type="bigint").collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        joins = [line for df in plans for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
                 if "SortMergeJoin [node" in line or "SortMergeJoin [feature" in line]
        # Between ranges only: a key with the number of the range, or a table of one row a node on both sides.
        assert not [line for line in joins if "_range" not in line and "LeftOuter" not in line], joins
