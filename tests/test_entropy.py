"""Counting and entropy operators on hand-made tables, plus properties."""

from __future__ import annotations

import math

import pytest
from conftest import GOLDEN_FEATURES, SF001

from entrotree.operators.counts import class_histogram, contingency, unpivot_features
from entrotree.operators.entropy import (best_feature, dataset_entropy, feature_scores,
                                         value_stats)
from entrotree.sources.fixtures import LI_FEATURES, li_bins


def H(*counts):
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts if c)


def test_pure_group_is_zero_and_single_row(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 1)], "f0 int, y int")
    vs = {(r["feature"], r["value"]): r for r in value_stats(contingency(df, ["f0"], "y")).collect()}
    assert vs[("f0", 0)]["entropy"] == 0.0 and vs[("f0", 0)]["n"] == 2
    assert vs[("f0", 1)]["entropy"] == 0.0 and vs[("f0", 1)]["n"] == 1


def test_majority_tie_goes_to_highest_label(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "f0 int, y int")
    r = value_stats(contingency(df, ["f0"], "y")).first()
    assert r["majority"] == 1
    assert r["entropy"] == pytest.approx(1.0)
    low = value_stats(contingency(df, ["f0"], "y"), tie="low").first()
    assert low["majority"] == 0


def test_null_value_is_its_own_group(spark):
    df = spark.createDataFrame([(None, 0), (1, 1), (1, 1)], "f0 int, y int")
    vs = value_stats(contingency(df, ["f0"], "y")).collect()
    assert {(r["value"], r["n"]) for r in vs} == {(None, 1), (1, 2)}


def test_unpivot_shape(spark):
    df = spark.createDataFrame([(1, 2, 0)], "a int, b int, y int")
    rows = sorted(tuple(r) for r in unpivot_features(df, ["a", "b"], "y").collect())
    assert rows == [(0, "a", 1), (0, "b", 2)]


def test_weighted_entropy_and_gain(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 1), (1, 0), (1, 1)]
    df = spark.createDataFrame(rows, "f0 int, y int")
    fs = feature_scores(contingency(df, ["f0"], "y"), ["f0"]).first()
    wh = 3 / 7 * H(2, 1) + 4 / 7 * H(1, 3)
    assert fs["weighted_entropy"] == pytest.approx(wh)
    assert fs["node_entropy"] == pytest.approx(H(3, 4))
    assert fs["gain"] == pytest.approx(H(3, 4) - wh)


def test_golden_root_ranking(spark, golden):
    fs = {r["feature"]: r["weighted_entropy"]
          for r in feature_scores(contingency(golden, GOLDEN_FEATURES, "y"), GOLDEN_FEATURES).collect()}
    expected = {"f7": 0.343092, "f2": 0.347121, "f0": 0.355972, "f3": 0.389110, "f6": 0.502041,
                "f5": 0.652949, "f1": 0.770957, "f4": 0.821394, "f8": 0.830852, "f9": 0.864866}
    for f, v in expected.items():
        assert fs[f] == pytest.approx(v, abs=1e-6)
    ent = dataset_entropy(golden, "y").first()["entropy"]
    assert ent == pytest.approx(0.952635, abs=1e-6)


def test_tie_goes_to_lowest_feature(spark):
    df = spark.createDataFrame([(0, 0, 1), (1, 1, 1)], "a int, b int, y int")
    fs = feature_scores(contingency(df, ["b", "a"], "y"), ["b", "a"])
    assert best_feature(fs).first()["feature"] == "b"


def test_properties_on_lineitem(spark):
    df = li_bins(spark, SF001)
    n = df.count()
    cont = contingency(df, LI_FEATURES, "y")
    per_feature = {r["feature"]: r["s"] for r in cont.groupBy("feature").agg({"n": "sum"})
                   .withColumnRenamed("sum(n)", "s").collect()}
    assert set(per_feature.values()) == {n}
    for r in feature_scores(cont, LI_FEATURES).collect():
        assert -1e-12 <= r["weighted_entropy"] <= r["node_entropy"] + 1e-12
        assert r["gain"] >= -1e-12
    hist = class_histogram(df, "y").collect()
    assert sum(r["n"] for r in hist) == n


def test_invariant_under_repartition(spark):
    df = li_bins(spark, SF001)
    a = sorted((r["feature"], round(r["weighted_entropy"], 12)) for r in
               feature_scores(contingency(df, LI_FEATURES, "y"), LI_FEATURES).collect())
    b = sorted((r["feature"], round(r["weighted_entropy"], 12)) for r in
               feature_scores(contingency(df.repartition(5, "k").sortWithinPartitions("f3"),
                                          LI_FEATURES, "y"), LI_FEATURES).collect())
    assert a == b
