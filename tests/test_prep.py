"""P1/P2: equal-width bins, training bounds on new data, occupancy."""

from __future__ import annotations

from entrotree.operators.prep import (bin_occupancy, column_bounds, equal_width_bins,
                                      select_features)


def test_equal_width_bins_and_bounds(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (3.5,), (6.999,), (7.0,), (None,)], "x double")
    assert column_bounds(df, ["x"]) == {"x": (0.0, 7.0)}
    got = [r["x"] for r in equal_width_bins(df, ["x"], bins=7).collect()]
    assert got == [0, 1, 3, 6, 6, None]  # the maximum falls in the last bin


def test_training_bounds_clamp_new_values(spark):
    new = spark.createDataFrame([(-5.0,), (2.0,), (50.0,)], "x double")
    got = [r["x_bin"] for r in equal_width_bins(new, ["x"], bins=7, bounds={"x": (0.0, 7.0)},
                                                  suffix="_bin").collect()]
    assert got == [0, 2, 6]


def test_constant_column_is_one_bin(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x"] for r in equal_width_bins(df, ["x"]).collect()] == [0, 0]


def test_occupancy_and_subset(spark):
    df = spark.createDataFrame([(0, 1, 0), (0, 2, 1), (1, 2, 1)], "a int, b int, y int")
    occ = {(r["column"], r["bin"]): r["n"] for r in bin_occupancy(df, ["a", "b"]).collect()}
    assert occ == {("a", 0): 2, ("a", 1): 1, ("b", 1): 1, ("b", 2): 2}
    assert select_features(df, ["b"], "y").columns == ["b", "y"]


def test_bins_of_nan_infinities_and_wide_integers(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0.0, 10**18), (7.0, 10**18 + 7 * 10**15), (nan, None), (inf, 10**18 + 10**15),
                                (-inf, 10**18), (3.5, -(10**18))], "x double, n long")
    rows = equal_width_bins(df, ["x", "n"], bins=7).collect()
    assert [r["x"] for r in rows] == [0, 6, None, 6, 0, 3]
    assert [r["n"] for r in rows] == [6, 6, None, 6, 6, 0]
