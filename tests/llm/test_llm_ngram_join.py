from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from entrotree.llm import ngram_join, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, k=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_classes(rows, k=5, percent=80):
    """Every pair compared."""
    found = [plain_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    where = {}
    for i, s in enumerate(found):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(found):
        for j in {j for x in s for j in where[x] if j < i}:
            both = len(s & found[j])
            if 100 * both >= percent * (len(s) + len(found[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return [(d, len(found[i]), low[find(i)]) for i, (d, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def same(got, want):
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def odd_rows(seed=1, many=400):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(400)]
    passage = [r.choice(word) for _ in range(40)]
    rows = [(5, None), (9, ""), (2, " \n"), (11, "One"), (12, "one"), (13, "a B c d"), (14, "a b c d e"), (15, "A b c d E"),
            (None, "one"), (None, "only here"), (None, "only here"), (None, ""), (13, "a B"), (16, "\x85 a \x1c b"),
            (17, "x " * 20_000), (18, "x x x x x"), (19, "a\x00b c d e f")]
    bases = [[r.choice(word) for _ in range(r.choice([6, 12, 30, 90, 300]))] for _ in range(30)]
    for i in range(many):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 1, 1, 2, 3, 8])):
            w[r.randrange(len(w))] = r.choice(word)
        if r.random() < 0.4:
            w = w + passage
        w = w[:len(w) - r.choice([0, 0, 1, 3])]
        rows.append((100 + i, r.choice([" ", "\n", "\t "]).join(w)))
    return rows


@pytest.mark.parametrize("full, few", [(2048, 8), (5, 1)])
def test_classes_equal_brute_force(spark, monkeypatch, full, few):
    monkeypatch.setattr(ngram_join, "FULL", full)
    monkeypatch.setattr(ngram_join, "FEW", few)
    rows = odd_rows()
    docs = frame(spark, rows).repartition(3).selectExpr("*", "1 AS id", "'x' AS component_id", "2 AS _row", "3 AS n")
    want = plain_classes(rows)
    assert len({c for _, _, c in want}) < 0.9 * len(rows)
    same(ngram_join.near_duplicates(docs), want)


def test_other_shingles_and_similarities(spark):
    rows = odd_rows(2, 150)
    for k, percent in ((1, 60), (3, 95)):
        same(ngram_join.near_duplicates(frame(spark, rows), k, percent), plain_classes(rows, k, percent))


def test_query_equals_brute_force_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_ngram_jaccard(spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 3
    same(got, plain_classes(rows))
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    same(ngram_join.near_duplicates(frame(spark, [(1, None), (None, " ")])), [(1, 0, 1), (None, 0, None)])


def test_links_without_a_common_pivot_are_found(spark, monkeypatch):
    """The tiles alone, and tiles cut into blocks, find every class."""
    monkeypatch.setattr(ngram_join, "PIVOTS", 0)
    rows = odd_rows(4, 200)
    for full in (2048, 7):
        monkeypatch.setattr(ngram_join, "FULL", full)
        same(ngram_join.near_duplicates(frame(spark, rows)), plain_classes(rows))


def test_bitmaps_bound_the_overlap_from_above():
    r = np.random.default_rng(5)
    for _ in range(200):
        x, y = (np.unique(r.integers(0, 300, r.integers(1, 200)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                for _ in range(2))
        a, b = (ngram_join._folded([ngram_join._bitmap(s, 256)], 64)[0] for s in (x, y))
        shared = len(np.intersect1d(x, y))
        assert shared <= len(x) - np.bitwise_count(a & ~b).sum() and shared <= len(y) - np.bitwise_count(b & ~a).sum()
        assert np.array_equal(a, ngram_join._folded([ngram_join._bitmap(x, 64)], 64)[0])


def test_slices_give_the_same_set(monkeypatch):
    text = ("Ab c,d é " * 50 + "z\ty").encode()
    whole = ngram_join.shingle_set(text)
    monkeypatch.setattr(ngram_join, "SLICE", 7)
    monkeypatch.setattr(ngram_join, "KNOWN", 2)
    assert np.array_equal(ngram_join.shingle_set(text), whole) and len(whole) == len(plain_set(text.decode()))


def test_shingles_of_the_same_sets_are_one_key(spark):
    """Sets that share many prefix shingles meet once, and all that shared one still meet."""
    r = random.Random(6)
    rows = []
    for i in range(40):
        w = [f"w{r.randint(0, 5000)}" for _ in range(120)]
        rows += [(10 * i + k, " ".join(w[:100] + [f"own{i}x{k}x{j}" for j in range(8)])) for k in range(2)]
    rule, docs = ngram_join.Rule(), frame(spark, rows)
    unique = ngram_join.sets(docs, ngram_join.crowding(docs), rule).withColumn("id", F.col("doc_id"))
    labels = spark.createDataFrame([], "id long, label long")
    meets = ngram_join._meetings(unique, labels, rule).collect()
    keys = {u.id: set(u["keys"]) for u in unique.select("id", "keys").collect()}
    want = {(a, b) for a in keys for b in keys if a < b and keys[a] & keys[b]}
    by_key = {}
    for m in meets:
        by_key.setdefault(m.key, []).append(m.id)
    assert {(a, b) for ids in by_key.values() for a in ids for b in ids if a < b} == want and len(want) >= 40
    assert len(meets) <= 3 * len(want) < sum(len(keys[a] & keys[b]) for a, b in want)
    # Short for a set where one of the shingles is in its short prefix.
    low = {a: max(m.short for m in meets if m.id == a) for a in keys if any(m.id == a for m in meets)}
    assert any(low.values())
