"""Metrics, keyed splits, folds and cross-validation."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from conftest import GOLDEN_FEATURES, SF01

from entrotree.operators.metrics import confusion_counts, confusion_matrix, label_metrics, summary
from entrotree.operators.validate import (assign_folds, cross_validate, feature_group_error,
                                          keyed_split, split_frames)
from entrotree.sources.fixtures import LI_FEATURES, li_bins


def test_metrics_by_hand(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 1 + [(2, 1)] * 1
    scored = spark.createDataFrame(rows, "a int, p int")
    conf = confusion_counts(scored, "a", "p")
    s = summary(conf).first()
    assert s["accuracy"] == pytest.approx(8 / 12)
    assert s["error_rate"] == pytest.approx(4 / 12)
    assert s["precision"] == pytest.approx(3 / 6)
    assert s["recall"] == pytest.approx(3 / 4)
    # label 2 is never predicted: its precision is 0 and counts in the macro mean
    assert s["precision_macro"] == pytest.approx((5 / 6 + 3 / 6 + 0) / 3)
    assert s["recall_macro"] == pytest.approx((5 / 7 + 3 / 4 + 0) / 3)
    per = {r["label"]: r for r in label_metrics(conf).collect()}
    assert per[2]["precision"] == 0.0 and per[2]["n_predicted"] == 0
    grid = confusion_matrix(conf).collect()
    assert len(grid) == 9 and sum(r["n"] for r in grid) == 12
    assert {(r["actual"], r["predicted"]) for r in grid if r["n"] == 0} == {(0, 2), (1, 2), (2, 0), (2, 2)}


def test_keyed_split_and_folds_lineitem(spark):
    df = li_bins(spark, SF01)
    n_train = keyed_split(df, "k", seed=200, train_percent=80).where("is_train").count()
    assert n_train == 48088
    sizes = {r["fold"]: r["count"] for r in assign_folds(df, "k", k=5, seed=200)
             .groupBy("fold").count().collect()}
    assert sizes == {0: 12064, 1: 12063, 2: 11959, 3: 11974, 4: 11940}


def test_cross_validation_shapes(spark, golden):
    df = golden.withColumn("k", F.xxhash64(*golden.columns))
    cv = cross_validate(df, GOLDEN_FEATURES, "y", "k", k=5, seed=200, holdout_percent=30)
    fm = cv["fold_metrics"].collect()
    assert sorted(r["model"] for r in fm) == [0, 1, 2, 3, 4]
    train_n = keyed_split(df, "k", seed=200, train_percent=70).where("is_train").count()
    assert sum(r["n"] for r in fm) == train_n
    assert all(0.8 < r["accuracy"] <= 1.0 for r in fm)
    best = cv["best"].first()
    assert best["accuracy"] == max(r["accuracy"] for r in fm)
    h = cv["holdout_summary"].first()
    assert h["n"] == df.count() - train_n


def test_feature_groups(spark):
    groups = {"g01": ["f0", "f1"], "g23": ["f2", "f3"], "g456": ["f4", "f5", "f6"]}
    e = {r["group"]: r["error_rate"] for r in
         feature_group_error(li_bins(spark, SF01), groups, "y", "k").collect()}
    assert set(e) == set(groups)
    assert e["g456"] > e["g01"]  # the planted label depends on f0, f1, f2
    assert all(0 <= v <= 1 for v in e.values())


def test_features_used(spark):
    assert LI_FEATURES == ["f0", "f1", "f2", "f3", "f4", "f5", "f6"]


def test_cross_validation_with_multiway_trees(spark):
    from conftest import SF001
    df = li_bins(spark, SF001)
    cv = cross_validate(df, LI_FEATURES, "y", "k", k=3, seed=7, kind="id3")
    fm = cv["fold_metrics"].collect()
    assert sorted(r["model"] for r in fm) == [0, 1, 2]
    assert all(0.5 < r["accuracy"] <= 1.0 for r in fm)
    h = cv["holdout_summary"].first()
    assert h["n"] == keyed_split(df, "k", seed=7, train_percent=70).where("not is_train").count()


def test_feature_groups_with_binary_trees(spark):
    from conftest import SF001
    groups = {"g01": ["f0", "f1"], "g2": ["f2"]}
    e = {r["group"]: r for r in feature_group_error(li_bins(spark, SF001), groups, "y", "k",
                                                      kind="binary").collect()}
    assert set(e) == {"g01", "g2"}
    assert all(0 <= r["error_rate"] <= 1 for r in e.values())
    assert e["g01"]["n"] == e["g2"]["n"]


def test_null_keys_and_null_labels_lose_no_row(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (5, 1, "a"), (6, 2, None)], "k long, f int, y string")
    train, test = split_frames(df, "k", seed=200, train_percent=80)
    assert train.count() + test.count() == 4
    folds = assign_folds(df, "k", k=2).collect()
    assert all(r["fold"] is not None for r in folds)
    scored = spark.createDataFrame([("a", "a"), (None, "a"), ("b", None), (None, None), ("c", "a")], "y string, prediction string")
    conf = confusion_counts(scored, "y")
    grid = confusion_matrix(conf).collect()
    assert sum(r["n"] for r in grid) == 5 and len(grid) == 16
    assert summary(conf, positive="a").first()["n"] == 5


def test_string_labels_and_nominal_features(spark):
    rows = [(i, "xyz"[i % 3], "pq"[i % 2], "no" if i % 3 else "yes") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, a string, b string, y string")
    cv = cross_validate(df, ["a", "b"], "y", "k", k=3, kind="id3", positive="yes")
    h = cv["holdout_summary"].first()
    assert h["accuracy"] == 1.0 and h["precision"] == 1.0 and h["recall"] == 1.0
    raw = cross_validate(df, ["a", "b"], "y", "k", k=3, kind="id3", positive="yes", compact=False)
    assert sorted(raw["fold_metrics"].collect()) == sorted(cv["fold_metrics"].collect())
    e = feature_group_error(df, {"a": ["a"], "b": ["b"]}, "y", "k").collect()
    assert {r["group"]: r["error_rate"] == 0 for r in e} == {"a": True, "b": False}
