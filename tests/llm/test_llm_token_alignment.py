from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from entrotree.llm import queries
from entrotree.llm import token_alignment as ta

SF = "/root/testdata/sf0.001"
A = f"{queries.TOKENIZERS}/byte_bpe_50k.json"
B = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Whole-text encoders of the two libraries, and the bytes of their tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    of = ta.byte_of_character()
    a_bytes = [bytes(of[c] for c in t.id_to_token(i)) for i in range(50256)] + [b""]
    b_bytes = [bytes([int(s.id_to_piece(i)[3:-1], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode()
               for i in range(len(s))]

    def encode(text):
        if not text:
            return [], []
        a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
        want = (" " + text).encode()
        same = b"".join(a_bytes[i] for i in a) == want == b"".join(b_bytes[i] for i in b)
        return ([(i, a_bytes[i]) for i in a], [(i, b_bytes[i]) for i in b]) if same else ([], [])
    return encode


def ranges(tokens):
    at, out = 0, []
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def plain_align(rows, encode):
    per, total = [], Counter()
    for d, text in rows:
        a, b = map(ranges, encode(text))
        common = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, before = [], 0
        for c in common:
            groups.append(",".join(str(i) for i, _, e in a if before < e <= c) + "|"
                          + ",".join(str(i) for i, _, e in b if before < e <= c))
            before = c
        links, j0 = [], 0
        for i, s, e in a:
            while b[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        total.update(links)
        per.append((d, a, b, groups, links))
    best = {}
    for (_, y), n in total.items():
        best[y] = max(best.get(y, 0), n)
    return [(d, len(a), len(b), len(g), len(k), sum(total[x] == best[x[1]] for x in k), sum(total[x] for x in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, g, k in per]


def odd_texts():
    r = random.Random(8)
    pieces = ["word", "naïve", "漢字かな", "🙂", "\n", "\t", "  ", " ", "don't", "<|endoftext|>", "</s>", "<0x0A>", "x" * 90,
              "\u0085", "\xa0", "12345", "ﬁ", "a\x1c", "\r\n\r\n", "Żółć!?", "é"]
    rows = [(i, "".join(r.choice(pieces) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 30)))) for i in range(300)]
    return rows + [(None, None), (500, ""), (501, " "), (502, "   "), (503, "a ▁ b"), (504, "\x00"), (505, "end "),
                   (506, "end  "), (507, " start"), (7, rows[7][1]), (508, "long text of words " * 4000)]


def test_equals_brute_force(spark, plain):
    rows = odd_texts()
    want = plain_align(rows, plain)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_a", "2 AS rest", "3 AS _row")
    for head in (0, 60, ta.HEAD):
        got = ta.align(docs.repartition(4), A, B, head=head)
        assert got.columns == COLUMNS
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(w[1] == 0 for w in want) >= 3 and max(w[1] for w in want) > 10_000


def test_query_equals_brute_force_on_the_whole_table(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_token_alignment(spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_align(rows, plain)))


def test_groups_are_returned(spark, plain):
    docs = spark.createDataFrame([(1, "two tokenizers"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in ta.align(docs, A, B, groups=True).collect()}
    assert hashlib.sha256(got[1].groups.encode()).hexdigest() == got[1].groups_sha256
    assert got[1].groups.count("|") == got[1].n_groups and got[2].groups == ""
    assert ta.align(docs.limit(0), A, B).count() == 0


def test_pairs_are_packed_and_unpacked():
    codes, many = np.array([0, 5, 5 + 2**31 - 10]), np.array([1, 70_000, 3])
    for got, want in zip(ta._unpacked(ta._packed(codes, many)), (codes, many), strict=True):
        assert np.array_equal(got, want)
    assert all(len(x) == 0 for x in ta._unpacked(ta._packed(codes[:0], many[:0])))


def test_gallop_equals_bisection():
    r = np.random.default_rng(1)
    for n in (1, 2, 7, 1000):
        values = np.unique(r.integers(0, 3 * n, n))
        keys = r.integers(-2, 3 * n + 2, 500)
        for start in (np.zeros(500, int), r.integers(-5, n + 5, 500)):
            assert np.array_equal(ta.gallop(keys, values, start), np.searchsorted(values, keys, "right"))
