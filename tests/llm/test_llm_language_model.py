from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from entrotree.llm import language_model as lm


def plain_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def plain_base(rows):
    counts, ends = Counter(), 0
    for d, t in rows:
        if not held(d):
            counts.update(plain_tokens(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for d, t in rows:
        c = [counts[w] for w in plain_tokens(t)] + [ends]
        out.append((d, held(d), len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c)))
    return out


def table():
    r = random.Random(9)
    en, fr = [f"w{i}ing" for i in range(60)], [f"é{i}eux" for i in range(60)]
    rows = []
    for i in range(250):
        vocab = r.choice([en, fr])
        w = [r.choice(vocab[: r.choice([5, 60])]) for _ in range(r.randint(0, 80))]
        if r.random() < 0.2:
            w.append(f"Rare{r.randint(0, 30)}")
        rows.append((i, " ".join(w) + r.choice(["", "\n"])))
    return rows + [(None, "W1ing a"), (3, "again"), (400, None), (401, ""), (402, "\x1c\x85 𝒳\x0b"),
                   (403, "w1ing " * 30_000)]


@pytest.mark.parametrize("head", [20, lm.HEAD])
def test_base_scores_equal_brute_force(spark, head):
    rows = table()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "text AS word")
    got = lm.score(df, rounds=2, head=head).collect()
    key = lambda x: (str(x[0]), x[2], round(x[5], 6))
    want = sorted(plain_base(rows), key=key)
    got = sorted([tuple(g) for g in got], key=key)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * (1 + abs(w[5]))
    gain = [(g[6] - g[5], g[2]) for g in got if g[1]]
    assert sum(x for x, _ in gain) / sum(n for _, n in gain) > 0.05  # the context helps on held-out rows


def test_probabilities_sum_to_one(spark):
    rows = table()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, vocab = lm.fit(df, rounds=1, head=30)
    counts = {bytes(r["word"]): r["n"] for r in vocab.collect()}
    start = np.array([0])
    for context in ([b"w1ing"], [b"w2ing", "é3eux".encode()], []):
        ids, _, _, _ = model.encode([b" ".join(context)])
        rows_ = model.features(ids, start)[:, -1:]
        p = model.probabilities(rows_)[0]
        total = p[0]
        for w, n in counts.items():
            i = model.index.get(w)
            k = int(model.classes[i]) if i else lm.ending_class(w)
            total += p[k] * (1 if 0 < k <= lm.SINGLES else (n + 1) / model.class_mass[k])
        unknown = sum(p[k] / model.class_mass[k] for k in range(1 + lm.SINGLES, lm.CLASSES))
        empty = sum(p[k] for k in range(1, 1 + lm.SINGLES) if k >= len(model.counts))
        assert abs(total + unknown + empty - 1) < 1e-4


def plain_step(weights, seen, rows, slopes):
    for k in rows:
        slope = np.zeros_like(weights)
        np.add.at(slope, k, slopes)
        seen += (slope * slope).sum(axis=1)
        weights -= lm.RATE / np.sqrt(seen)[:, None] * slope


def test_all_classes_and_steps_equal_plain_descent():
    assert (lm.SINGLES, lm.ENDINGS, lm.CLASSES) == (39, 88, 128) and lm.GROUPS * lm.WIDTH == lm.CLASSES
    r = np.random.default_rng(4)
    n = 3000
    model = lm.Model(outer=r.normal(0, 0.1, (lm.ROWS, lm.GROUPS)).astype(np.float32),
                     inner=r.normal(0, 0.1, (lm.ROWS * lm.GROUPS, lm.WIDTH)).astype(np.float32),
                     outer_bias=np.zeros(lm.GROUPS, np.float32), inner_bias=np.zeros((lm.GROUPS, lm.WIDTH), np.float32))
    rows, classes = r.integers(0, lm.ROWS, (3, n)) // 7, r.integers(0, lm.CLASSES, n)
    local = lm._Descent(model)
    local.step(rows, classes)
    group, within = classes // lm.WIDTH, classes % lm.WIDTH
    want = np.zeros(n)
    for mine, weights, k, target, width in ((local.model.outer, model.outer, rows, group, lm.GROUPS),
                                            (local.model.inner, model.inner, rows * lm.GROUPS + group, within, lm.WIDTH)):
        z = np.exp(sum(weights[i].astype(float) for i in k))
        p = z / z.sum(axis=1, keepdims=True)
        want += np.log10(p[np.arange(n), target])
        p[np.arange(n), target] -= 1
        moved = weights.astype(float)
        plain_step(moved, np.ones(len(weights)), k, p)
        assert np.abs(mine - moved).max() < 1e-4
        if width == lm.GROUPS:
            bias = -lm.RATE / 10 / n * p.sum(axis=0)
            assert np.abs(local.model.outer_bias - bias).max() < 1e-6
        else:
            bias = np.zeros((lm.GROUPS, lm.WIDTH))
            np.add.at(bias, group, -lm.RATE / 10 / n * p)
            assert np.abs(local.model.inner_bias - bias).max() < 1e-6
    model.features = lambda ids, firsts: rows
    assert np.abs(model.class_scores(np.zeros(n), classes, None) - want).max() < 1e-4
    assert np.abs(np.log10(model.probabilities(rows)[np.arange(n), classes]) - want).max() < 1e-4


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lm.score(df.limit(0)).count() == 0
    only_held = [i for i in range(60) if held(i)][:3]
    got = lm.score(spark.createDataFrame([(i, "a") for i in only_held], "doc_id long, text string")).collect()
    assert [(g.n_tokens, g.n_known, g.train_tokens, g.base_score) for g in got] == [(2, 0, 0, 0.0)] * 3
