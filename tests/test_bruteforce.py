"""Spark trees against a brute-force Python grower on random small tables."""

from __future__ import annotations

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from entrotree.operators.binary import fit_binary
from entrotree.operators.grow import fit_id3
from entrotree.operators.score import predict

FEATS = ["a", "b", "c"]

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 4), st.integers(0, 2)),
    min_size=1, max_size=40)


def _entropy(labels):
    n = len(labels)
    return -sum(c / n * math.log2(c / n) for c in Counter(labels).values())


def _majority(labels, tie):
    c = Counter(labels)
    key = (lambda v: (c[v], v)) if tie == "high" else (lambda v: (c[v], -v))
    return max(c, key=key)


def brute_id3(rows, depth):
    out = {}

    def grow(path, sub, d):
        ys = [r[-1] for r in sub]
        scores = []
        for i, f in enumerate(FEATS):
            groups = Counter(r[i] for r in sub)
            wh = sum(n / len(sub) * _entropy([r[-1] for r in sub if r[i] == v])
                     for v, n in groups.items())
            scores.append((round(wh, 12), i))
        _, bi = min(scores)
        out[path] = (FEATS[bi], len(sub), _majority(ys, "high"), round(_entropy(ys), 9))
        if d < depth - 1:
            for v in sorted({r[bi] for r in sub}):
                grow(f"{path}/{FEATS[bi]}={v}", [r for r in sub if r[bi] == v], d + 1)

    grow("", rows, 0)
    return out


def brute_binary(rows, depth):
    out = {}

    def grow(path, sub, d):
        ys = [r[-1] for r in sub]
        ent = _entropy(ys)
        best = None
        if d < depth and ent > 0:
            for i, f in enumerate(FEATS):
                vals = sorted({r[i] for r in sub})
                for lo, hi in zip(vals, vals[1:]):
                    t = (lo + hi) / 2
                    left = [r[-1] for r in sub if r[i] <= t]
                    right = [r[-1] for r in sub if r[i] > t]
                    wh = (len(left) * _entropy(left) + len(right) * _entropy(right)) / len(sub)
                    cand = (round(wh, 12), i, t)
                    best = cand if best is None or cand < best else best
        out[path] = (FEATS[best[1]] if best else None, best[2] if best else None,
                     len(sub), _majority(ys, "low"), round(ent, 9))
        if best:
            _, i, t = best
            grow(f"{path}/{FEATS[i]}<={t}", [r for r in sub if r[i] <= t], d + 1)
            grow(f"{path}/{FEATS[i]}>{t}", [r for r in sub if r[i] > t], d + 1)

    grow("", rows, 0)
    return out


def brute_predict(tree_nodes, row, binary):
    path = ""
    while True:
        node = tree_nodes[path]
        f = node[0]
        if f is None:
            break
        i = FEATS.index(f)
        if binary:
            t = node[1]
            nxt = f"{path}/{f}<={t}" if row[i] <= t else f"{path}/{f}>{t}"
        else:
            nxt = f"{path}/{f}={row[i]}"
        if nxt not in tree_nodes:
            break
        path = nxt
    return tree_nodes[path][3 if binary else 2]


SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=rows_strategy)
def test_id3_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, c int, y int")
    tree = fit_id3(df, FEATS, "y", 3)
    got = {r["node"]: (r["split_feature"], r["n"], r["majority"], round(r["entropy"], 9))
           for r in tree.collect()}
    want = brute_id3(rows, 3)
    # the last level names a feature but is not expanded; leaves are the same set
    assert got == want
    probe = rows + [(9, 9, 9, 0)]  # an unseen value at the root falls back to the root
    scored = predict(spark.createDataFrame(probe, "a int, b int, c int, y int"), tree, FEATS)
    full = {**want}
    preds = sorted((tuple(r[:4]), r["prediction"]) for r in
                   scored.select("a", "b", "c", "y", "prediction").collect())
    expect = sorted((tuple(r), brute_predict(full, r, False)) for r in probe)
    assert preds == expect


@SETTINGS
@given(rows=rows_strategy)
def test_binary_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, c int, y int")
    tree = fit_binary(df, FEATS, "y", 3)
    got = {r["node"]: (r["split_feature"], r["threshold"], r["n"], r["majority"],
                       round(r["entropy"], 9)) for r in tree.collect()}
    want = brute_binary(rows, 3)
    assert got == want
    scored = predict(df, tree, FEATS)
    preds = sorted((tuple(r[:4]), r["prediction"]) for r in
                   scored.select("a", "b", "c", "y", "prediction").collect())
    expect = sorted((tuple(r), brute_predict(want, r, True)) for r in rows)
    assert preds == expect


def _random_rows(seed: int, n: int = 60):
    import random
    rnd = random.Random(seed)
    return [(rnd.randint(0, 3), rnd.randint(0, 2), rnd.randint(0, 4), rnd.randint(0, 2))
            for _ in range(n)]


def test_other_depths_equal_brute_force(spark):
    rows = _random_rows(7)
    df = spark.createDataFrame(rows, "a int, b int, c int, y int")
    for depth in (1, 4):
        got = {r["node"]: (r["split_feature"], r["n"], r["majority"], round(r["entropy"], 9))
               for r in fit_id3(df, FEATS, "y", depth).collect()}
        assert got == brute_id3(rows, depth), depth
        got_b = {r["node"]: (r["split_feature"], r["threshold"], r["n"], r["majority"],
                             round(r["entropy"], 9))
                 for r in fit_binary(df, FEATS, "y", depth).collect()}
        assert got_b == brute_binary(rows, depth), depth


def test_weighted_rows_equal_replicated_rows(spark):
    from collections import Counter
    rows = _random_rows(11, 40)
    counted = Counter(rows)
    weighted = spark.createDataFrame([(*r, w) for r, w in counted.items()],
                                     "a int, b int, c int, y int, w long")
    plain = spark.createDataFrame(rows, "a int, b int, c int, y int")
    cols = ["node", "split_feature", "n", "majority", "is_leaf"]
    for fit in (fit_id3, fit_binary):
        a = fit(plain, FEATS, "y", 3).select(*cols).collect()
        b = fit(weighted, FEATS, "y", 3, weight="w").select(*cols).collect()
        c = fit(weighted, FEATS, "y", 3, weight="w", compact=False).select(*cols).collect()
        assert sorted(a) == sorted(b) == sorted(c)
