from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from entrotree.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


def rows_of():
    r = random.Random(11)
    bits = ["hi", "<s>", "</s>", "[INST]", "[/INST]", "\\", "<|end|>", "<|turn|>", "é𝒳", "\n", "<\\s>", "<", "|end|>", ""]
    said = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 6)))
    rows, common = [], [("user", "same start"), ("assistant", "same answer</s>"), ("user", "third")]
    for c in range(80):
        turns = common[:r.randint(0, 3)] if c % 2 else []
        turns = turns + [(r.choice(["user", "assistant", "system", "[INST]x"]), said()) for _ in range(r.randint(1, 5))]
        rows += [(c, k, a, b) for k, (a, b) in enumerate(turns)]
    rows += [(200, k, a, b) for k, (a, b) in enumerate(common)] + [(201, k, a, b) for k, (a, b) in enumerate(common[:2])]
    rows += [(300, 5, "user", "x"), (300, 5, "user", "x"), (300, None, None, None), (300, 5, "assistant", None),
             (None, 0, "assistant", "n"), (None, 1, "user", "m"), (400, 0, "assistant", "long " * 60_000)]
    rows += [(500, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(300)]
    r.shuffle(rows)
    return rows


def in_order(rows):
    convs = {}
    low = lambda x: (x is not None, x if x is not None else 0)
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((low(t), role or "", text or ""))
    return {c: [(a, b) for _, a, b in sorted(t)] for c, t in convs.items()}


def test_round_trip_equals_brute_force(spark):
    rows = rows_of() + chat.EXTRA
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "text AS segment", "1 AS node")
    packed, index = chat.pack(df)
    got = {g.conv_id: tuple(g)[1:] for g in chat.read_back(packed, index).collect()}
    want = in_order(rows)
    assert set(got) == set(want)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in want.items():
        loss = "".join(b for a, b in turns if a == "assistant")
        assert got[c][:4] == (len(turns), digest("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), digest(loss))
    kept = packed.orderBy("start").collect()
    distinct = {tuple(t[: k + 1]) for t in want.values() for k in range(len(t))}
    assert len(kept) == len(distinct)  # shared turns once
    assert all(a.end == b.start for a, b in zip(kept, kept[1:], strict=False)) and kept[0].start == 0
    tape = "".join(k.segment for k in kept)
    for k in kept:  # what a node attends to is its conversation so far
        seen = "".join(tape[i.start:i.end] for i in k.attends)
        assert seen.endswith(k.segment) and len(seen) == k.position + len(k.segment)
        turns = tuple(chat.parse(s + chat.END) for s in seen.split(chat.END)[:-1])
        assert turns in distinct
        body = k.segment[len(chat.TURN):-len(chat.END)].replace(chat.TEXT, "", 1)
        assert not any(c in body for c in chat.CONTROL)


@pytest.mark.parametrize("text", ["", "\\", "a\\<s>", "<\\s>", "</s>[INST] ok [/INST]", "\\\\<|end|>\\n"])
def test_escape_is_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e")).first()
    assert chat.unescape(row.e) == text and not any(c in row.e for c in chat.CONTROL)


def test_empty_table(spark):
    assert chat.read_back(*chat.pack(spark.createDataFrame([], ROWS))).count() == 0


def test_reading_back_checks_positions_and_follows_intervals(spark):
    rows = [(c, t, "user", f"{c % 2 if t else 0} {t}") for c in range(4) for t in range(3)]
    packed, index = chat.pack(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert chat.read_back(packed, index).count() == 4
    shifted = packed.withColumn("position", F.col("position") + F.when(F.col("position") > 0, 1).otherwise(0))
    with pytest.raises(Exception, match="position"):
        chat.read_back(shifted, index).collect()
    alone = packed.withColumn("attends", F.slice("attends", -1, 1))  # without the ancestors' intervals
    with pytest.raises(Exception, match="position"):
        chat.read_back(alone, index).collect()
