from __future__ import annotations

import random
import zlib

from entrotree.llm import toxicity as tx


def test_folding_and_exceptions():
    assert tx.folded_words("Ｌ0ser, 1D10T! мóron p​ath3tic") == ["loser", "idiot", "moron", "pathetic"]
    m = tx.Matcher({"scum": 2.0, "trash": 1.0, "tras": 0.5}, ["trash bin", "scumble"])
    assert m.weigh("Scum and TR4SHY trash") == (4.0, 4)
    assert m.weigh("a trash bin, the scumble; trash") == (1.0, 6)
    assert m.weigh(None) == m.weigh("") == (0, 0)
    assert tx.Matcher({}).weigh("scum") == (0, 1)


def training(spark):
    r = random.Random(3)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("nel", "rem", "tis", "lop")]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(vocab) for _ in range(r.randint(5, 120))]
        bad = i % 8 == 0
        if bad:
            for _ in range(r.randint(1, 5)):
                w.insert(r.randrange(len(w)), r.choice(["w0rthless", "SCUM", "morоn"]))
        elif i % 8 == 1:
            w.insert(r.randrange(len(w)), "moronic study")
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(None, "scum"), (900, None), (901, ""), (902, "x " * 30_000 + "scum"), (0, rows[0][1])]
    labels += [(None, 1, 1), (1, None, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0.0 AS score_", "text AS toxic"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(rows))


def test_learns_the_planted_lexicon_and_scores_every_row(spark):
    docs, labels, texts = training(spark)
    model = tx.fit(docs, labels)
    assert {"worthles", "scum"} <= set(model.lexicon)
    out = tx.judge(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_edges(spark):
    docs, labels, _ = training(spark)
    assert tx.judge(docs.limit(0), labels).count() == 0
    none = tx.judge(docs, labels.limit(0)).collect()
    assert all(r.predicted == 0 and r.score < 1e-6 for r in none)


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = tx.judge(docs, labels).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right >= 0.95 * len(rows)
    wrong = sum(r.predicted and not r.toxic for r in rows)
    assert wrong <= 0.01 * len(rows)


def test_the_sample_keeps_its_bound_with_repeated_ids(spark):
    ids = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.range(50_000).selectExpr(f"{ids[0]}L AS doc_id", "concat('text ', id) AS text").union(
        spark.createDataFrame([(i, f"other {i}") for i in ids[1:]] + [(ids[1], f"other {ids[1]}")], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    got = {r["toxic"]: r["count"] for r in tx.training_sample(docs, labels, 100).groupBy("toxic").count().collect()}
    assert got == {0: 100, 1: 100}
    few = tx.training_sample(docs.where(f"doc_id = {ids[1]}"), labels, 100).collect()
    assert len(few) == 1  # equal rows count once
