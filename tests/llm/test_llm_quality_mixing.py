from __future__ import annotations

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from entrotree.llm import mixing, quality  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd_texts():
    r = random.Random(3)
    vocab = ["a", "b", "the", "of", "x|y", "é", "日本", "𝒳z", "#1"]
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h",
             "x " * 60, "l 1\nl 1\n\n \nl 1", "\x1ca\x85b\xa0c d", "w\n" * 9]
    for n in (9, 30, 80, 400):
        texts += [" ".join(r.choice(vocab[: r.randint(1, 9)]) for _ in range(n)) + r.choice(["", "\n", " "])
                  for _ in range(8)]
    long = " ".join(f"w{r.randint(0, 900)}" for _ in range(20_000))
    return texts + [long, long + "\n" + long[:3000]]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_rule_counts_equal_brute_force(spark, odd_texts):
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(odd_texts)])
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality.rule_counts(docs).collect()}
    assert got == {i: brute.rule_counts(t) for i, t in enumerate(odd_texts)}


def test_quality_on_table_keeps_trusted_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs, labels).select("doc_id", "text", "base_failed", "kept").collect()
    good = {r.doc_id: r.quality for r in labels.collect()}
    for r in rows:
        assert r.base_failed == brute.rule_counts(r.text)[-1]
        assert not (r.base_failed and r.kept)
        if good.get(r.doc_id) == 1 and not r.base_failed:
            assert r.kept
    junk = [r.kept for r in rows if good.get(r.doc_id) == 0]
    assert sum(junk) < 0.4 * len(junk)


@pytest.mark.parametrize("sf, most", [("sf0.01", 0), ("sf0.1", 0)])
def test_junk_that_passes_the_base_rules_goes_at_every_size(spark, sf, most):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    rows = (quality.judge(docs, labels).join(labels, "doc_id")
            .select("base_failed", "kept", "quality").where("quality is not null").collect())
    junk = [r.kept for r in rows if r.quality == 0 and not r.base_failed]
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(junk) <= most and len(junk) >= 28
    assert sum(good) >= 0.995 * len(good)


def test_threshold_without_held_out_documents(spark):
    docs = docs_of(spark, [(i, f"a{i} b c d " * 6, "s") for i in range(4)])
    assert quality.fit_threshold(docs, labels_of(spark), quality.fit_ratio(docs, labels_of(spark))) == float("-inf")


def test_every_trusted_document_fits_the_model_and_sets_the_threshold(spark, monkeypatch):
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randint(0, 40 + i % 90)}" for _ in range(40)), "s") for i in range(400)]
    docs = docs_of(spark, rows).withColumn("text", F.concat_ws(" ", "text", F.concat(F.lit("own"), "doc_id")))
    labels = labels_of(spark, [(i, 1, 0) for i in range(0, 400, 2)])
    ratio = quality.fit_ratio(docs, labels)
    # The word that only one document has: above what is expected for each trusted one.
    own = docs.select("doc_id", F.pmod(F.xxhash64(F.concat(F.lit("own"), "doc_id")), F.lit(quality.BUCKETS)).alias("b"))
    for doc_id, b in own.where("doc_id % 2 = 0").collect():
        assert ratio[-1][b] > 0, doc_id
    # The threshold equals that of all trusted documents, each scored without its own fold.
    fold = {i: k for i, k in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(quality.FOLDS))).collect()}
    scores = []
    for k in range(quality.FOLDS):
        alone = ratio.copy()
        alone[-1] = ratio[k]
        mine = quality._scored(docs, alone).select("doc_id", "score", "base_failed").collect()
        scores += [x.score for x in mine if fold[x.doc_id] == k and x.doc_id % 2 == 0 and not x.base_failed]
    assert len(scores) == 200
    middle, low = np.percentile(scores, [50, 5])
    want = middle - quality.SPREAD * (middle - low)
    assert quality.fit_threshold(docs, labels, ratio) == pytest.approx(want, abs=1e-9)
    # As with a plain join, where the ids are too many to broadcast.
    monkeypatch.setattr(quality, "fits_broadcast", lambda ids: False)
    assert (quality.fit_ratio(docs, labels) == ratio).all()
    assert quality.fit_threshold(docs, labels, ratio) == pytest.approx(want, abs=1e-9)


def test_fold_models_score_without_python_on_the_executors(spark, monkeypatch):
    docs = docs_of(spark, [(i, " ".join(f"w{(i * 7 + j) % 31}" for j in range(30)), "s") for i in range(20)] + [
        (3, None, "s"), (4, "few words", "s"), (5, "a b c d e " * 30, "s"), (None, "x y z " * 9, "s")])
    labels = labels_of(spark, [(i, 1, 0) for i in range(10)])
    ratio, plans, checkpoint = quality.fit_ratio(docs, labels), [], type(docs).checkpoint

    def kept(df, *a, **b):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpoint(df, *a, **b)
    monkeypatch.setattr(type(docs), "checkpoint", kept)
    quality.fit_threshold(docs, labels, ratio)
    assert plans and not [p for p in plans if "Python" in p or "Pandas" in p or "Arrow" in p]
    # A score for every trusted row, copies of an id too; null where the base rules fail.
    trusted = docs.select("doc_id", "text").join(quality._trusted(labels), "doc_id")
    scores = [r.score for r in quality._scores_by_others(trusted, ratio).collect()]
    assert len(scores) == 13 and scores.count(None) == 3


def test_models_are_neither_printed_with_plans_nor_joined(spark):
    r = random.Random(5)
    docs = docs_of(spark, [(i, " ".join(f"w{r.randint(0, 60)}" for _ in range(30)), "s") for i in range(60)])
    labels = labels_of(spark, [(i, 1, 0) for i in range(0, 60, 2)])
    ratio = quality.fit_ratio(docs, labels)
    trusted = docs.select("doc_id", "text").join(quality._trusted(labels), "doc_id")
    scored, others = quality._scored(docs, ratio), quality._scores_by_others(trusted, ratio)
    for df, joins in ((scored, 0), (others, 1)):  # one join finds the trusted documents
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(plan) < 100_000 and plan.count("Join") == joins
        assert "Subquery" in plan and "_ratio" not in plan  # no row holds the numbers
    # Both equal the mean of the model's numbers.
    counted = quality.rule_counts(trusted).select("doc_id", "_fold", quality._grams(F.col("_h"), F.col("_h2"))).collect()
    whole = {x.doc_id: x.score for x in scored.collect()}
    want = [ratio[k][b].sum() / (1000.0 * len(b)) for _, k, b in counted]
    assert sorted(x.score for x in others.collect()) == pytest.approx(sorted(want), abs=1e-12)
    assert all(whole[i] == pytest.approx(ratio[-1][b].sum() / (1000.0 * len(b)), abs=1e-12) for i, _, b in counted)


def test_quality_odd_inputs(spark):
    docs = docs_of(spark, [(None, None, None), (None, "x y " * 30, None), (1, "a", "s"), (1, "a", "s")])
    out = quality.judge(docs.withColumn("score_", docs.n_chars), labels_of(spark, [(None, 1, 0), (None, None, None)]))
    assert out.count() == 4 and set(docs.columns) < set(out.columns)
    assert quality.judge(docs.limit(0), labels_of(spark)).count() == 0


def test_mix_equals_brute_force(spark):
    r = random.Random(5)
    rows = [(i, "w " * r.randint(0, 40), r.choice(["a", "a", "a", "b", "é", None])) for i in range(300)]
    rows += [(None, "x y", "a"), (7, "x y z", "tiny"), (7, "x y z", "tiny"), (400, None, "empty")]
    out = mixing.mix(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = brute.water_fill(sizes)
    by_target = {}
    for x in out:
        assert 0 <= x.taken <= 3 * x["size"]
        by_target.setdefault((x.source_size, x.target), []).append(x.taken)
    for s, n in sizes.items():
        mine = [v for (size, t), v in by_target.items() if size == n and abs(t - want[s]) < 1e-6]
        assert mine and abs(sum(mine[0]) - want[s]) <= 1
    again = mixing.mix(docs_of(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_schedule_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    served = mixing.schedule(docs).collect()
    total = {}
    for r in served:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.words
    assert total == {k: v for k, v in mixed.items() if v}
    assert [r.finish for r in served] == sorted(r.finish for r in served)
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = mixing.mix(docs_of(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0), (0.0, 0)]
