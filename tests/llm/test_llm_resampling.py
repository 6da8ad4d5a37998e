from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

from entrotree.llm import queries, resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return len(w), [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain_draw(docs, target, n=1, buckets=10_000, percent=10, min_words=20, seed="2024"):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in plain_features(t, n)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out
    s, t = counts(x for _, x in docs), counts(target)
    s_all, t_all = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]
    rows = []
    for d, text in docs:
        words, found = plain_features(text, n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, words, len(found), weight,
                     weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = i + 1
    return [tuple(r) for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def odd_rows():
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["Alpha", "beta", "γάμμα", "d4-e", "z_z", "ÄÖ", "x" * 700]) + r.choice(["", ".", "\t"])
                         for _ in range(r.randint(0, 60)))) for i in range(200)]
    rows += [(None, None), (900, ""), (901, "\x00 - !"), (902, "one" * 5000), (7, rows[7][1]), (None, "a b " * 15),
             (903, "word " * 60_000)]
    return rows


def test_equals_brute_force(spark):
    rows, target = odd_rows(), ["beta beta gamma", None, "", "Alpha d4 e " * 9]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for n, percent in ((1, 10), (3, 50)):
        docs = frame(spark, rows).repartition(5).selectExpr("*", "1 AS score", "'x' AS rank", "2 AS _row")
        got = resampling.resample(docs, goal, n=n, buckets=97, percent=percent).collect()
        want = plain_draw(rows, target, n, 97, percent)
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
        assert sum(r.rank is not None for r in got) > 5


def test_query_equals_brute_force_on_whole_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op13_importance_resampling(spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 5
    want = [(d, n, w, s, r) for d, _, n, w, s, r in plain_draw(docs, target)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_empty_tables_and_nothing_drawn(spark):
    none = frame(spark, [])
    assert resampling.resample(none, none.select("text")).count() == 0
    few = frame(spark, [(1, "a b c"), (2, None)])
    got = resampling.resample(few, none.select("text")).collect()
    assert {(r.doc_id, r.n_features, r["rank"]) for r in got} == {(1, 3, None), (2, 0, None)}


def test_equal_scores_rank_by_id(spark):
    weighed = spark.createDataFrame([(None, 30, 1, 5), (None, 30, 1, 5)] + [(i, 30, 1, 5) for i in range(20)],
                                    "doc_id long, n_words long, n_features long, weight long")
    got = resampling.draw(weighed, percent=100).collect()
    order = [r.doc_id for r in sorted(got, key=lambda r: r["rank"])]
    want = sorted(got, key=lambda r: (-r.score, r.doc_id is None, r.doc_id))
    assert order == [r.doc_id for r in want] and sorted(r["rank"] for r in got) == list(range(1, 23))


def test_crcs_of_all_lengths():
    r = random.Random(4)
    some = [bytes(r.randrange(256) for _ in range(n)) for n in [0, 1, 1, 2, 5, 5, 31, 512, 513, 4000]]
    assert resampling.crc32_all(some).tolist() == [zlib.crc32(x) for x in some]
    assert len(resampling.crc32_all([])) == 0


def test_slices_give_the_same_features():
    text = ("Ab c,d é" * 50).encode()
    for n in (1, 2, 4):
        whole = [f for _, x in resampling.feature_runs(text, n) for f in x]
        cut = [f for _, x in resampling.feature_runs(text, n, size=7) for f in x]
        assert sorted(whole) == sorted(cut)
        assert sorted(whole) == sorted(f.encode() for f in plain_features(text.decode(), n)[1])
