"""Exact folds and hold-outs, inferred types, the confusion grid."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from entrotree.operators import validate
from entrotree.operators.metrics import confusion_matrix
from entrotree.operators.validate import assign_equal_folds, exact_split
from entrotree.sources.delimited import infer_kinds, read_binned_csv, typed_fields


def order(key, seed=200):
    return hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()


def test_equal_folds_under_any_partitioning(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    got = assign_equal_folds(df, "k", k=5).collect()
    ranked = sorted(range(1003), key=order)
    assert {r["k"]: r["fold"] for r in got} == {k: i % 5 for i, k in enumerate(ranked)}
    again = assign_equal_folds(df.repartition(7).orderBy(F.rand(1)), "k", k=5).collect()
    assert sorted(got) == sorted(again)


def test_equal_folds_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(40)] + [(7, 1)] * 33, "k long, _rank int")
    sizes = [r["count"] for r in assign_equal_folds(df, "k", k=4).groupBy("fold").count().collect()]
    assert sorted(sizes) == [18, 18, 18, 19]
    one = assign_equal_folds(df.where("k is null"), "k", k=4).collect()
    two = assign_equal_folds(df.where("k is null").repartition(5), "k", k=4).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert assign_equal_folds(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("percent", [70, 1, 100, 0, 99])
def test_exact_split_has_the_smallest_digests(spark, percent):
    df = spark.range(997).withColumnRenamed("id", "k")
    need = -(-997 * (100 - percent) // 100)
    got = exact_split(df.repartition(3), "k", train_percent=percent).where("not is_train").collect()
    assert sorted(r["k"] for r in got) == sorted(sorted(range(997), key=order)[:need])


def test_exact_split_among_rows_of_one_key(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [(i, 0) for i in range(7)], "k long, v int")
    for percent in (70, 50, 3):
        one, two = (exact_split(d, "k", train_percent=percent).collect() for d in (df, df.repartition(6)))
        assert sum(not r["is_train"] for r in one) == -(-57 * (100 - percent) // 100)
        assert sorted(map(str, one)) == sorted(map(str, two))
    assert exact_split(df.limit(0), "k").count() == 0


def test_split_point_is_found_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(validate, "SPLIT_DIGITS", 1)
    df = spark.range(200).withColumnRenamed("id", "k")
    got = exact_split(df, "k", train_percent=70).where("not is_train").collect()
    assert sorted(r["k"] for r in got) == sorted(sorted(range(200), key=order)[:60])


def test_types_of_columns(spark):
    rows = [("1", "1", "1", "x", "", " 7 ", "1e3", "99999999999999999999", "-0", "1d"),
            ("-2", "3000000000", ".5", "1", None, None, "NaN", "1", "+5", "2"),
            ("", None, "2.", "2", "", "8", "-inf", "", "2147483648", "3")]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(10)))
    kinds = infer_kinds(df)
    assert list(kinds.values()) == ["int", "bigint", "double", "string", "string", "int", "double", "double", "bigint", "string"]
    got = typed_fields(df).collect()
    assert [r["c0"] for r in got] == [1, -2, None] and [r["c5"] for r in got] == [7, None, 8]
    assert [r["c9"] for r in got] == ["1d", "2", "3"] and got[2]["c6"] == float("-inf")
    assert infer_kinds(df.limit(0)) == dict.fromkeys(df.columns, "string")


def test_csv_with_nominal_and_decimal_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf0,1,2,class\r\n1,red,0.5,1\r\n2,\"a,b\",,0\r\n,blue,2,1\r\n")
    df = read_binned_csv(spark, str(tmp_path))
    assert dict(df.dtypes) == {"f0": "int", "f1": "string", "f2": "double", "y": "int"}
    assert [tuple(r) for r in df.collect()] == [(1, "red", 0.5, 1), (2, "a,b", None, 0), (None, "blue", 2.0, 1)]
    known = read_binned_csv(spark, str(tmp_path), kinds={"f0": "bigint", "f1": "string", "f2": "string", "y": "int"})
    assert dict(known.dtypes) == {"f0": "bigint", "f1": "string", "f2": "string", "y": "int"}


def test_grid_of_many_labels_and_few_cells(spark):
    cells = spark.range(2000).select(F.col("id").cast("string").alias("actual"),
                                     ((F.col("id") * 7) % 2000).cast("string").alias("predicted"), F.lit(3).cast("long").alias("n"))
    grid = confusion_matrix(cells)
    assert grid.agg(F.count("*"), F.sum("n")).first() == (2000 * 2000, 6000)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and not any(p in plan for p in ("CartesianProduct", "NestedLoop"))


def test_grid_of_keys_and_null_labels(spark):
    cells = spark.createDataFrame([(None, "a", None, 2), (None, "b", "a", 1), (1, None, None, 5)],
                                  "m int, actual string, predicted string, n long")
    got = sorted(map(str, map(tuple, confusion_matrix(cells, by=["m"]).collect())))
    labels = ["a", "b", None]
    have = {("a", None): 2, ("b", "a"): 1}
    want = [(None, x, y, have.get((x, y), 0)) for x in labels for y in labels] + [(1, None, None, 5)]
    assert got == sorted(map(str, want))
