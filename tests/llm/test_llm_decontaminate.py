from __future__ import annotations

import random

import numpy as np

from entrotree.llm import decontaminate as dc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_alignment(item, passage):
    best, above = 0.0, [0.0] * (len(passage) + 1)
    for x in item:
        row = [0.0]
        for j, y in enumerate(passage):
            row.append(max(0.0, above[j] + (dc.MATCH if x == y else dc.MISMATCH), above[j + 1] + dc.GAP,
                           row[j] + dc.GAP))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_brute_force():
    r = random.Random(1)
    items = [np.array([r.randint(0, 6) for _ in range(r.randint(1, 12))]) for _ in range(60)]
    passages = [np.array([r.randint(-1, 6) for _ in range(r.randint(1, 20))]) for _ in range(60)]
    got, ends = dc.align(items, passages)
    for x, y, score, end in zip(items, passages, got, ends, strict=True):  # nothing before the end scores as much
        assert score == plain_alignment(x.tolist(), y[:end].tolist())
        assert not score or plain_alignment(x.tolist(), y[:end].tolist()) > 0
    assert np.allclose(got, [plain_alignment(a.tolist(), b.tolist()) for a, b in zip(items, passages, strict=True)])


def copies_by_brute_force(docs, items):
    out = set()
    for d, text in docs:
        w = dc.tokens(text)
        for i, t in items:
            x = dc.tokens(t)
            n = min(3, len(x))
            grams = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)} if x else set()
            if (any(tuple(w[k:k + n]) in grams for k in range(len(w) - n + 1))
                    and plain_alignment(x, w) >= dc.MIN_SIMILARITY * len(x)):
                out.add((d, i))
    return out


def test_exact_edited_and_hot_copies_are_found(spark):
    r = random.Random(2)
    vocab = [f"v{i}" for i in range(400)] + ["the", "of"] * 60
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(12, 50)))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "two words"), (None, " ".join(f"n{i}" for i in range(20))), (3, items[3][1]),
              (93, "Kumquat!"), (94, "答案是北京"), (95, "今天天气很好，我们一起去公园散步吧"), (96, "สวัสดีครับผม")]
    docs = []
    for i in range(120):
        w = [r.choice(vocab) for _ in range(r.randint(20, 150))]
        if i % 2:
            x = items[0 if i % 6 == 1 else r.randrange(30)][1].split()
            for _ in range(r.choice([0, 0, 1, len(x) // 8, len(x) // 3])):
                x[r.randrange(len(x))] = "edited"
            at = r.randrange(len(w))
            w[at:at] = x
        docs.append((i, " ".join(w).capitalize() + "."))
    docs += [(None, items[5][1].upper()), (200, None), (201, ""), (202, "a b"), (203, items[33][1] * 2),
             (204, "of the " * 20_000 + items[7][1]), (205, "there are two words here"), (206, "two more words"),
             (207, "a kumquat."), (208, "他说答案是北京。"), (209, "因为今天天气真好，我们一起去公园散步吧。"),
             (210, "北京的公园很好"), (211, "เขาพูดว่าสวัสดีครับผมแล้วไป")]
    df = spark.createDataFrame([(d, t, "en", "s", None) for d, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("x", "doc_id")
    for block in (1_000_000, 100):
        got = dc.contamination(df, bench, block_words=block).collect()
        assert {(g.doc_id, g.item_id) for g in got} == copies_by_brute_force(docs, items)
    dirty = {d for d, _ in copies_by_brute_force(docs, items)}
    kept = dc.drop_contaminated(df, bench, block_words=300)
    assert kept.columns == df.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(str(d) for d, _ in docs if d not in dirty)
    assert dc.contamination(df.limit(0), bench).count() == 0
    assert dc.contamination(df, bench.limit(0)).count() == 0
    assert dc.drop_contaminated(df, bench.limit(0)).count() == len(docs)


def test_every_copy_has_a_row_and_passages_stay_short(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"{item} {item}"), (2, f"{item} {'x ' * 200}{item}"), (3, f"{item} x")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([("a", item)], "item_id string, text string")
    got = sorted((g.doc_id, g.item_id, g.end_word, g.similarity) for g in dc.contamination(docs, bench).collect())
    assert got == [(1, "a", 20, 1.0), (1, "a", 40, 1.0), (2, "a", 20, 1.0), (2, "a", 240, 1.0), (3, "a", 20, 1.0)]
    assert dc.contamination(docs, bench, min_words=21).count() == 0
    words = dc.tokens(item)
    block = dc.Block([("a", words)])
    long = f"{item} " * 10_000
    assert max(end - at for _, at, end in block.passages(block.numbers(dc.tokens(long)))) <= 3 * len(words)
    assert [c["end_word"] for c in dc._score(block, [long], 0.6)[0]] == list(range(20, 200_001, 20))


def test_clashing_columns_keep_their_values(spark):
    docs = spark.createDataFrame([(1, "plain words here", 4, 5), (2, "a b c d e f", 6, 7)],
                                 "doc_id long, text string, _copies long, _doc long")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    out = dc.drop_contaminated(docs, bench)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(1, "plain words here", 4, 5)]
