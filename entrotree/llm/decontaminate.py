"""Operator 1: benchmark decontamination by rare seeds and Smith-Waterman alignment.

Three-word seeds of the test items are counted over all documents.  Those that
are rare for their item join documents to items; where a seed hits, the item is
aligned with the passage around it by local alignment over words, so edited and
paraphrased copies score too.  An item of fewer words is its own seed.  Scripts
without blanks are cut into characters, each a word.  A pair counts when the alignment score is at
least ``MIN_SIMILARITY`` of the item's own length.

Scale: texts are read twice in Arrow batches and never shuffled.  Seeds are
looked up in the tasks: the benchmark is broadcast in blocks of at most
``BLOCK_WORDS`` words, however large it is, and every document is held against
every block.  Seed counts are merged in the tasks before their shuffle.  A
passage that stands in a third of all documents is an ordinary hit, for an item
whose seeds are all frequent keeps them all.  A passage is at most about three
times as long as its item, also where a document repeats it, and at most
``CELLS`` words of passages are aligned at once (one passage at least).

Defined cases: null and empty texts and items match nothing; an item of one or
two words matches every document that says it (``min_words`` leaves such items
out); very long texts are searched whole; of equally good ends of a passage the
first counts; repeated documents are judged one by one, repeated items each;
null ids are carried; empty tables give no rows (or drop none); extra columns,
whatever their names, stay in ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

SEED_WORDS = 3
#: A seed is rare if it stands in at most this share of the documents, or in at
#: most ``RARE_TIMES`` as many as the item's median seed.
RARE_SHARE = 0.001
RARE_TIMES = 4
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
MIN_SIMILARITY = 0.6
BLOCK_WORDS = 1_000_000
SLACK = 0.4  # of the item's length, on either side of a seed's diagonal
CELLS = 1 << 19

#: Scripts written without blanks: Thai to Myanmar, Khmer, kana, Han (fixed ranges).
UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\uf900-\ufaff\U00020000-\U0003ffff")
_WORD = re.compile(r"\w+")
_WORD_OR_CHARACTER = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")


def tokens(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (_WORD if text.isascii() else _WORD_OR_CHARACTER).findall(text)


class Block:
    """Some test items: their words as numbers, and where each seed stands."""

    def __init__(self, items: list[tuple[int | None, list[str]]]) -> None:
        self.ids = [i for i, _ in items]
        self.vocab: dict[str, int] = {}
        self.words = [np.array([self.vocab.setdefault(w, len(self.vocab)) for w in ws], np.int64)
                      for _, ws in items]
        self.lengths = sorted({min(len(ws), SEED_WORDS) for ws in self.words})
        where = [(int(g), k, at) for k, ws in enumerate(self.words)
                 for at, g in enumerate(self.grams(ws, min(len(ws), SEED_WORDS)))]
        self.seeds, inverse = np.unique(np.array([g for g, _, _ in where], np.int64), return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        self.first = np.searchsorted(inverse[order], np.arange(len(self.seeds) + 1))
        self.item = np.array([k for _, k, _ in where], np.int64)[order]
        self.at = np.array([a for _, _, a in where], np.int64)[order]
        self.rare = np.ones(len(order), bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words))

    def grams(self, ids: np.ndarray, words: int) -> np.ndarray:
        """Code of the seed of so many words at each position, -1 where a word is in no item."""
        n, size = len(ids) - words + 1, len(self.vocab)
        if n < 1:
            return np.empty(0, np.int64)
        parts = [ids[k:k + n] for k in range(words)]
        code = np.full(n, sum(size ** k for k in range(words + 1, SEED_WORDS + 1)), np.int64)
        for k, part in enumerate(parts):
            code += part * size ** (words - 1 - k)
        return np.where(np.minimum.reduce(parts) < 0, -1, code)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, seed number) of all seeds in a document."""
        places, seeds = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for words in self.lengths:
            code = self.grams(ids, words)
            at = np.flatnonzero(code >= 0)
            found = np.minimum(np.searchsorted(self.seeds, code[at]), len(self.seeds) - 1)
            same = self.seeds[found] == code[at]
            places.append(at[same])
            seeds.append(found[same])
        return np.concatenate(places), np.concatenate(seeds)

    def keep_rare(self, counts: dict[int, int], n_docs: int) -> None:
        """Mark the seeds that join: rare in the corpus, or for their item."""
        df = np.array([counts.get(s, 0) for s in range(len(self.seeds))], float)
        each = np.repeat(df, np.diff(self.first))
        by_item = np.argsort(self.item, kind="stable")
        starts = np.searchsorted(self.item[by_item], np.arange(len(self.ids) + 1))
        for k in range(len(self.ids)):
            mine = by_item[starts[k]:starts[k + 1]]
            if len(mine):
                most = max(RARE_SHARE * n_docs, RARE_TIMES * np.median(each[mine]))
                self.rare[mine] = each[mine] <= most

    def passages(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item number, start, end) of the stretches that rare seeds point at."""
        at, seed = self.hits(ids)
        spots: dict[int, set[int]] = {}
        for p, s in zip(at.tolist(), seed.tolist(), strict=True):
            for o in range(self.first[s], self.first[s + 1]):
                if self.rare[o]:
                    spots.setdefault(int(self.item[o]), set()).add(p - int(self.at[o]))
        for k, diagonals in spots.items():
            m = len(self.words[k])
            slack = int(SLACK * m) + 1
            first = last = None
            for d in sorted(diagonals):
                if first is not None and (d - last > slack or d - first > m):
                    yield k, max(first - slack, 0), min(last + m + slack, len(ids))
                    first = None
                first, last = d if first is None else first, d
            yield k, max(first - slack, 0), min(last + m + slack, len(ids))


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores (linear gaps) of item/passage pairs and where they end, in one sweep.

    A row is a running maximum: a gap of k words costs k * GAP, so the best
    score that ends in a gap is the maximum of (score + gap-free offset).
    """
    rows, width = max(map(len, items)), max(map(len, passages))
    a = np.full((len(items), rows), -2, np.int64)
    b = np.full((len(items), width), -1, np.int64)
    for i, (x, y) in enumerate(zip(items, passages, strict=True)):
        a[i, :len(x)] = x
        b[i, :len(y)] = y
    ramp = (np.arange(width + 1) * GAP).astype(np.float32)
    score = np.zeros((len(items), width + 1), np.float32)
    best, ends, each = np.zeros(len(items), np.float32), np.zeros(len(items), np.int64), np.arange(len(items))
    for r in range(rows):
        nxt = np.maximum(score + np.float32(GAP), 0)
        step = np.where(b == a[:, r:r + 1], np.float32(MATCH), np.float32(MISMATCH))
        nxt[:, 1:] = np.maximum(nxt[:, 1:], score[:, :-1] + step)
        score = np.maximum.accumulate(nxt - ramp, axis=1) + ramp
        top = score.argmax(axis=1)
        higher = score[each, top] > best
        best = np.where(higher, score[each, top], best)
        ends = np.where(higher, top, ends)
    return best, ends


def _score(block: Block, texts: Iterable[str | None], least: float) -> list[list[dict]]:
    """Per text, the copies of items that it holds."""
    texts = list(texts)
    found: list[dict[tuple[int, int], tuple[float, int]]] = [{} for _ in texts]
    waiting: list[tuple[int, int, int, np.ndarray]] = []

    def flush() -> None:
        waiting.sort(key=lambda w: (len(w[3]), len(block.words[w[1]])))
        while waiting:  # the longest passages first, as many as fit
            some = waiting[-max(1, CELLS // max(1, len(waiting[-1][3]))):]
            del waiting[-len(some):]
            scores, ends = align([block.words[k] for _, k, _, _ in some], [p for *_, p in some])
            for (d, k, start, _), s, end in zip(some, scores.tolist(), ends.tolist(), strict=True):
                s /= len(block.words[k])
                # Neighbouring passages may both reach a copy: it is told by its end.
                if s >= least and s > found[d].get((k, start + end), (0.0, 0))[0]:
                    found[d][k, start + end] = (s, start)

    held = 0
    for d, text in enumerate(texts):
        ids = block.numbers(tokens(text))
        for k, start, end in block.passages(ids):
            waiting.append((d, k, start, ids[start:end].copy()))
            held += end - start
            if held >= CELLS:
                flush()
                held = 0
    flush()
    return [[{"item_id": block.ids[k], "similarity": s, "start_word": at, "end_word": end}
             for (k, end), (s, at) in sorted(f.items())] for f in found]


def _blocks(benchmark: DataFrame, block_words: int, min_words: int) -> Iterator[Block]:
    """The items in blocks; the driver holds one at a time."""
    some, n = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = tokens(row["text"])
        if len(words) < max(min_words, 1):
            continue
        some.append((row["item_id"], words))
        n += len(words)
        if n >= block_words:
            yield Block(some)
            some, n = [], 0
    if some:
        yield Block(some)


def _matcher(docs: DataFrame, block: Block, least: float, item_id: T.DataType) -> Column:
    """Column of the copies of the block's items in a document's text, from counted seeds."""
    context = docs.sparkSession.sparkContext
    counted = context.broadcast(block)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def seeds_in(texts: pd.Series) -> pd.Series:
        b = counted.value
        return pd.Series([np.unique(b.hits(b.numbers(tokens(t)))[1]).tolist() for t in texts])

    seen = docs.select(F.explode_outer(seeds_in("text")).alias("seed"))
    counts = dict(seen.groupBy("seed").count().where("seed is not null").collect())  # seeds of one block
    block.keep_rare(counts, docs.count())
    chosen = context.broadcast(block)
    kind = T.ArrayType(T.StructType([T.StructField("item_id", item_id),
                                     T.StructField("similarity", T.DoubleType()),
                                     T.StructField("start_word", T.LongType()),
                                     T.StructField("end_word", T.LongType())]))

    @F.pandas_udf(kind)
    def copies(texts: pd.Series) -> pd.Series:
        return pd.Series(_score(chosen.value, texts, least))

    return copies("text")


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SIMILARITY,
                  block_words: int = BLOCK_WORDS, min_words: int = 1) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, end_word): the copies of test items in documents.

    A document that holds an item several times has a row for each passage:
    start_word is where the searched passage begins, end_word where the copy ends.
    """
    texts, item_id = docs.select("doc_id", "text"), benchmark.schema["item_id"].dataType
    out = None
    for block in _blocks(benchmark, block_words, min_words):
        hits = (texts.select("doc_id", F.explode_outer(_matcher(texts, block, least, item_id)).alias("hit"))
                .where("hit is not null").select("doc_id", "hit.*"))
        out = hits if out is None else materialize(out.unionAll(hits))
    if out is None:
        return texts.limit(0).select("doc_id", F.lit(None).cast(item_id).alias("item_id"), F.lit(0.0).alias("similarity"),
                                     F.lit(0).cast("long").alias("start_word"), F.lit(0).cast("long").alias("end_word"))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SIMILARITY,
                      block_words: int = BLOCK_WORDS, min_words: int = 1) -> DataFrame:
    """``docs`` without the documents that hold a copy of a test item."""
    clean = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    for block in _blocks(benchmark, block_words, min_words):
        copies = _matcher(docs.select("text"), block, least, benchmark.schema["item_id"].dataType)
        clean = clean.withColumn("_copies", copies).where(F.size("_copies") == 0).select("_doc", "text")
    return clean.select("_doc.*")
