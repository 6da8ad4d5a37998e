"""Registered queries against their DuckDB SQL on the smallest tables.

The full set at sf0.01 is run by ``scripts/check_oracle.py``; here a
representative slice of every operator family runs at sf0.001.
"""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as se
from entrotree.plans.catalog import QUERIES
from entrotree.plans.oracle import ORACLE

TABLES = ["lineitem", "events", "documents", "labels", "pages"]
SLICE = ["scan_count", "peek", "bin_occupancy", "dataset_entropy_events", "unpivot_counts",
         "value_entropy_docs", "majority_label_events", "info_gain", "min_weighted_entropy",
         "root_profile", "branch_counts", "id3_tree", "tree_listing", "score_unseen",
         "id3_tree_paths", "score_paths", "id3_tree_no_reuse", "confusion_events", "text_fields",
         "random_split_partition", "weighted_entropy_wide", "binary_tree_wide", "binary_tree_nulls",
         "cv_fold_metrics_docs", "cv_holdout_events",
         "confusion", "metrics_summary", "precision_per_label", "fold_sizes", "binary_tree",
         "binary_tree_events", "id3_tree_events",
         "cv_fold_metrics", "cv_holdout_labels", "feature_group_error", "binary_tree_cuts", "typed_fields",
         "csv_scan", "fold_sizes_equal", "holdout_exact_70", "score_rows_compiled", "score_rows_joined"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", SLICE)
def test_query_matches_sql(spark, con, name):
    df = se.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert {"node", "split_feature", "majority", "is_leaf"} <= set(df.columns)
