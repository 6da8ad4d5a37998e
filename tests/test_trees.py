"""Tree growth (multiway and binary) and scoring against the goldens."""

from __future__ import annotations

import pytest
from conftest import GOLDEN_FEATURES, SF01

from entrotree.operators.binary import fit_binary
from entrotree.operators.grow import fit_id3
from entrotree.operators.metrics import confusion_counts
from entrotree.operators.score import leaf_labels, predict, tree_listing
from entrotree.sources.fixtures import LI_FEATURES, li_bins


def test_golden_root_and_level2(golden_tree):
    rows = {r["node"]: r for r in golden_tree.collect()}
    assert rows[""]["split_feature"] == "f7"
    level2 = {r["node"]: r["split_feature"] for r in rows.values() if r["depth"] == 1}
    assert level2 == {"/f7=0": "f4", "/f7=1": "f2", "/f7=2": "f0", "/f7=3": "f0",
                      "/f7=4": "f0", "/f7=5": "f0", "/f7=6": "f0"}
    assert rows["/f7=2"]["weighted_entropy"] == pytest.approx(0.363421, abs=1e-6)


def test_golden_level3_and_leaves(golden_tree):
    leaves = leaf_labels(golden_tree).collect()
    assert len(leaves) == 34
    f1_nodes = {r["node"] for r in golden_tree.where("depth = 2 and split_feature = 'f1'").collect()}
    assert f1_nodes == {"/f7=0/f4=0", "/f7=1/f2=1", "/f7=1/f2=2", "/f7=2/f0=1", "/f7=2/f0=2",
                        "/f7=3/f0=1", "/f7=3/f0=2"}
    others = golden_tree.where("depth = 2 and split_feature <> 'f1'").select("split_feature").distinct()
    assert [r[0] for r in others.collect()] == ["f0"]
    # the branch the listing forgot: f7=0, f4=4 -> one row, label 0
    r = golden_tree.where("node = '/f7=0/f4=4'").first()
    assert (r["n"], r["majority"]) == (1, 0)


def test_golden_confusion(golden, golden_tree):
    scored = predict(golden, golden_tree, GOLDEN_FEATURES)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion_counts(scored, "y").collect()}
    assert cells == {(0, 0): 347, (0, 1): 10, (1, 0): 28, (1, 1): 184}


def test_listing_depth_first(golden_tree):
    lines = [r["line"] for r in tree_listing(golden_tree, numeric=True).orderBy("line_no").collect()]
    assert lines[0] == "split on f7"
    assert lines[1] == "  f7=0: split on f4"
    assert lines[2] == "    f4=0: best f1, predict 0"


def test_unseen_branch_falls_back_to_parent_majority(spark):
    train = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 1), (1, 0)], "f int, y int")
    tree = fit_id3(train, ["f"], "y", 2)
    test = spark.createDataFrame([(5, 9), (0, 9), (1, 9)], "f int, y int")
    pred = {r["f"]: r["prediction"] for r in predict(test, tree, ["f"]).collect()}
    # root majority: 3 x 0 vs 2 x 1 -> 0; f=1 node majority 1
    assert pred == {5: 0, 0: 0, 1: 1}


def test_pure_table_single_leaf_options(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 0, 1), (1, 1, 1)], "a int, b int, y int")
    t = fit_id3(df, ["a", "b"], "y", 3, split_pure_nodes=False)
    rows = t.collect()
    assert len(rows) == 1 and rows[0]["is_leaf"] and rows[0]["majority"] == 1
    assert rows[0]["split_feature"] == "a"  # tie at 0 -> lowest index


def test_no_reuse_of_features(spark, golden):
    t = fit_id3(golden, GOLDEN_FEATURES, "y", 3, reuse_features=False)
    for r in t.where("depth = 2").collect():
        used = {seg.split("=")[0] for seg in r["node"].strip("/").split("/")}
        assert r["split_feature"] not in used


def test_binary_golden_matches_pyspark_ml(spark, golden):
    tree = fit_binary(golden, GOLDEN_FEATURES, "y", 3)
    root = tree.where("depth = 0").first()
    assert (root["split_feature"], root["threshold"]) == ("f2", 1.5)
    scored = predict(golden, tree, GOLDEN_FEATURES)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion_counts(scored, "y").collect()}
    assert cells == {(0, 0): 352, (0, 1): 5, (1, 0): 25, (1, 1): 187}

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    vec = VectorAssembler(inputCols=GOLDEN_FEATURES, outputCol="x").transform(golden)
    model = DecisionTreeClassifier(featuresCol="x", labelCol="y", impurity="entropy",
                                   maxDepth=3).fit(vec.withColumn("y", vec["y"].cast("double")))
    ml = model.transform(vec).select("prediction").collect()
    ours = predict(golden, tree, GOLDEN_FEATURES).select("prediction").collect()
    agree = sum(int(a[0] == b[0]) for a, b in zip(ml, ours))
    assert agree == golden.count()


def test_binary_lineitem_root(spark):
    tree = fit_binary(li_bins(spark, SF01), LI_FEATURES, "y", 1)
    root = tree.where("depth = 0").first()
    assert (root["split_feature"], root["threshold"]) == ("f2", 4.5)
    assert root["weighted_entropy"] == pytest.approx(0.821776, abs=1e-6)


def test_multiway_lineitem_level2(spark):
    tree = fit_id3(li_bins(spark, SF01), LI_FEATURES, "y", 2)
    got = {r["node"]: (r["split_feature"], round(r["weighted_entropy"], 6))
           for r in tree.where("depth = 1").collect()}
    assert got["/f2=0"] == ("f0", 0.682662)
    assert got["/f2=5"][0] == "f1" and got["/f2=6"][0] == "f1"


def test_binary_takes_a_feature_of_any_width(spark):
    df = spark.range(5000).selectExpr("cast(id as double) as a", "cast(id >= 3210 as int) as y")
    root = fit_binary(df, ["a"], "y", 2).where("depth = 0").first()
    assert (root["threshold"], root["weighted_entropy"]) == (3209.5, pytest.approx(0, abs=1e-9))


def test_binary_keeps_rows_with_null_and_nan(spark):
    rows = [(1.0, None, 0), (2.0, None, 0), (None, 1.0, 1), (float("nan"), 2.0, 1), (3.0, None, 1)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    tree = fit_binary(df, ["a", "b"], "y", 3)
    root = tree.where("depth = 0").first()
    assert (root["n"], root["split_feature"], root["threshold"]) == (5, "a", 2.5)
    assert [r["prediction"] for r in predict(df, tree, ["a", "b"]).orderBy("y").collect()] == [0, 0, 1, 1, 1]


PATH_VALUES = ["x", "x/b=y", "x%2Fb=y", "<null>", "%3Cnull%3E", "", "null", None, "a<=1", "a>1"]


def test_node_keys_tell_all_values_apart(spark):
    import random
    rnd = random.Random(4)
    rows = [(rnd.choice(PATH_VALUES), rnd.choice(PATH_VALUES), rnd.choice(PATH_VALUES), rnd.randint(0, 2))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, `c=/` string, y int")
    features = ["a", "b", "c=/"]
    tree = fit_id3(df, features, "y", 3)
    assert tree.count() == tree.select("node").distinct().count()
    scored = predict(df, tree, features, node_out="node").collect()
    assert len(scored) == len(rows)
    # rows of one node share the split values on its path: a leaf holds n rows
    sizes = {}
    for r in scored:
        sizes[r["node"]] = sizes.get(r["node"], 0) + 1
    assert sizes == {r["node"]: r["n"] for r in tree.where("is_leaf").collect()}


def test_big_tree_scores_without_broadcast(spark):
    from conftest import SF001
    df = li_bins(spark, SF001)
    tree = fit_id3(df, LI_FEATURES, "y", 3)
    a = predict(df, tree, LI_FEATURES).select("k", "prediction").collect()
    b = predict(df, tree, LI_FEATURES, broadcast_bytes=0).select("k", "prediction").collect()
    assert sorted(a) == sorted(b)


def test_listing_numbers_siblings_by_value(spark):
    df = spark.createDataFrame([(v, v % 2) for v in (10, 2, 9, 100)] * 2, "f int, y int")
    tree = fit_id3(df, ["f"], "y", 2)
    lines = [r["line"] for r in tree_listing(tree, numeric=True).orderBy("line_no").collect()]
    assert [x.split(":")[0] for x in lines] == ["split on f", "  f=2", "  f=9", "  f=10", "  f=100"]


def test_tree_invariant_under_repartition(spark):
    from conftest import SF001
    df = li_bins(spark, SF001)
    a = fit_id3(df, LI_FEATURES, "y", 3)
    b = fit_id3(df.repartition(7, "f5").sortWithinPartitions("k"), LI_FEATURES, "y", 3)
    cols = ["node", "split_feature", "n", "majority", "is_leaf"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_null_feature_is_a_branch_in_fit_and_scoring(spark):
    rows = [(None, 1), (None, 1), (0, 0), (0, 0), (1, 1), (1, 0)]
    df = spark.createDataFrame(rows, "f int, y int")
    tree = fit_id3(df, ["f"], "y", 2)
    nodes = {r["node"]: (r["n"], r["majority"]) for r in tree.where("depth = 1").collect()}
    assert nodes == {"/f=<null>": (2, 1), "/f=0": (2, 0), "/f=1": (2, 1)}
    pred = {r["f"]: r["prediction"] for r in predict(df, tree, ["f"]).collect()}
    assert pred == {None: 1, 0: 0, 1: 1}


def test_constant_features_give_a_root_leaf(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 1)], "a int, y int")
    rows = fit_binary(df, ["a"], "y", 3).collect()
    assert len(rows) == 1 and rows[0]["is_leaf"] and rows[0]["split_feature"] is None
    assert rows[0]["majority"] == 1


def test_empty_input_gives_empty_tree(spark):
    df = spark.createDataFrame([], "a int, y int")
    assert fit_id3(df, ["a"], "y", 3).count() == 0
