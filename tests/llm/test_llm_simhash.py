from __future__ import annotations

import random

import pytest
import xxhash

from entrotree.llm import graph, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text) if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_groups(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    root = plain_components(range(len(rows)), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = root[i]
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return [(d, f"{f:016x}", low[root[i]]) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))], root


def odd_rows():
    r = random.Random(1)
    base = [f"w{r.randint(0, 99)}" for _ in range(90)]
    rows = [(5, None), (9, ""), (2, " \n"), (11, "One"), (12, "one"), (13, "a B"), (14, "\x85 a"), (15, "é\x1cÀ b c"),
            (None, "one"), (None, "only here"), (None, "only here"), (None, "another null"), (13, "a B"),
            (13, " ".join(base)), (40, "x " * 20_000)]
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = "z"
        rows.append((100 + i, " ".join(w)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], DOCS)


def test_groups_equal_brute_force(spark):
    rows = odd_rows()
    want, _ = plain_groups(rows)
    got = simhash.near_duplicates(frame(spark, rows).withColumnRenamed("n_chars", "component_id")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want, _ = plain_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == sorted(want)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_row_of_each_group(spark):
    rows = odd_rows()
    want, root = plain_groups(rows)
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = kept.collect()
    assert len(kept) == len(set(root.values()))
    of = {}
    for i, (d, t) in enumerate(rows):
        of.setdefault((d, t), root[i])
    assert len({of[r.doc_id, r.text] for r in kept}) == len(kept)
    plain = [(d, t) for d, t in rows if d is not None and d >= 100]
    got = simhash.keep_one(frame(spark, plain)).collect()
    assert sorted(r.doc_id for r in got) == sorted({c for _, _, c in plain_groups(plain)[0]})


def test_crowded_blocks_lose_no_pair(spark):
    r = random.Random(2)
    fps = set()
    centre = r.getrandbits(64)
    while len(fps) < 300:
        x = centre
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    want = {tuple(sorted((a, b))) for a in fps for b in fps if a != b and bin(a ^ b).count("1") <= 3}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    for limit in (1000, 20):
        got = {tuple(sorted((a % (1 << 64), b % (1 << 64)))) for a, b in
               simhash.close_pairs(df, full_block=limit).collect()}
        assert got == want


@pytest.mark.parametrize("edges_a_task", [graph.EDGES, 7])
def test_components_on_chains_and_hubs(spark, monkeypatch, edges_a_task):
    monkeypatch.setattr(graph, "EDGES", edges_a_task)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (200, 201)]
    want = plain_components({x for e in edges if e[0] != e[1] for x in e}, edges)
    got = graph.components(spark.createDataFrame(edges, "u long, v long"))
    assert dict(map(tuple, got.collect())) == want


def test_hubs_meet_their_minimum_by_plain_exchanges(spark):
    """Both sides of the join come from an exchange of the join, so that the planner can split a hub."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph._star(spark.createDataFrame([(i, 0) for i in range(1, 50)], "u long, v long"), True)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text[text.index("SortMergeJoin"):]
    assert join.count("Exchange hashpartitioning(u#") >= 2 and join.count("_h#") >= 4
