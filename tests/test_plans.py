"""Physical-plan properties: JVM-only expressions, pruned scans, partial aggregation."""

from __future__ import annotations

from conftest import SF001

from entrotree.operators.counts import contingency
from entrotree.operators.grow import fit_id3
from entrotree.operators.score import predict
from entrotree.sources.fixtures import LI_FEATURES, li_bins

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_contingency_plan_is_codegen_with_partial_agg(spark):
    cont = contingency(li_bins(spark, SF001), LI_FEATURES, "y")
    cont.collect()
    plan = _plan(cont)
    assert "Expand" in plan and "partial_count" in plan
    assert not any(p in plan for p in PY_NODES)
    # only needed lineitem columns reach the parquet scan
    assert "l_partkey" not in plan and "l_comment" not in plan


def test_scoring_is_map_only(spark):
    df = li_bins(spark, SF001)
    tree = fit_id3(df, LI_FEATURES, "y", 3)
    scored = predict(df, tree, LI_FEATURES)
    scored.collect()
    plan = _plan(scored)  # a small tree is one expression
    assert not any(p in plan for p in (*PY_NODES, "Join", "Exchange"))
    joined = predict(df, tree, LI_FEATURES, compiled_nodes=0)
    joined.collect()
    plan = _plan(joined)
    assert "BroadcastHashJoin" in plan
    assert not any(p in plan for p in (*PY_NODES, "SortMergeJoin"))


def _final_plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("== Initial Plan ==")[0].split("\n\n(1)")[0]


def test_each_source_table_is_read_once(spark):
    import __spark_entry__ as se
    expected = {"info_gain": 0, "weighted_entropy_docs": 0, "metrics_summary": 1,
                "score_rows": 1, "min_weighted_entropy": 0}  # 0: from a table made in one pass
    for name, scans in expected.items():
        df = se.queries()[name](spark, SF001)
        df.write.format("noop").mode("overwrite").save()
        plan = _final_plan(df)
        assert plan.count("Scan parquet") == scans, name
        assert not any(p in plan for p in PY_NODES + ("NestedLoopJoin", "CartesianProduct")), name


def test_no_exchange_by_node_or_feature_before_a_partial_aggregate(spark):
    """One key never gathers raw counts: exchanges are fed by partial aggregates, or keyed by value."""
    from entrotree.operators.entropy import feature_scores
    df = li_bins(spark, SF001)
    scores = feature_scores(contingency(df, LI_FEATURES, "y"), LI_FEATURES)
    scores.collect()
    plan = _final_plan(scores)
    assert "Window" not in plan and "SinglePartition" not in plan
