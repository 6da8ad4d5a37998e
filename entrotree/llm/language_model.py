"""Operator 6: a hashed maximum-entropy language model with class-factored softmax.

P(word | context) = P(class | context) * P(word | class).  The class softmax is
factored once more, P(group | context) * P(class | group, context) with 16 groups
of 8 classes, so that a token costs 24 sums of weights and not 128; both have
hashed features of the context: the last word, the last two, and the one before
the last (a skip).  The most frequent words are classes of their own, all others
are classed by the bytes they end in; within a class the only feature is the
word itself, whose maximum-entropy solution is its relative frequency (add-one).
Weights are trained by synchronous rounds: every task descends on its part of
the round's documents from the common weights, the changes are summed with the
number of tokens as weight, and the mean moves the common weights.

Scale: the vocabulary is a Spark table and never broadcast as a whole.  The
``HEAD`` most frequent words go to the tasks; other words leave them as
(document, word, count) and get their counts by a join.  The weights are
``ROWS`` x ``CLASSES`` numbers whatever the input.  Changes are summed in two
steps by streaming sums, so neither a task nor the driver holds more than a few
copies of the weights.

Defined cases: a null or empty text is the end token alone; a null doc_id counts
as the empty text (not held out); repeated rows each train and score; without
training documents the base score is 0 and the class model uniform; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

FOLDS, HELD_OUT = 7, 2
HEAD = 1 << 17
SINGLES = 39  # most frequent words, each its own class; class 0 is the end
ENDINGS = 88
CLASSES = 1 + SINGLES + ENDINGS
WIDTH = 8  # classes of a group
GROUPS = CLASSES // WIDTH
ROW_BITS = 12
ROWS = 1 << ROW_BITS
ROUNDS = 3
RATE = 0.7
BATCH = 4096  # tokens per local step
BLOCK = 1 << 15  # numbers per record of a change
SALTS = 8
FLUSH = 200_000  # tokens or distinct words held by a task
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lowered, parted at the six ASCII blanks."""
    return (text or b"").lower().split()


def ending_class(word: bytes) -> int:
    return 1 + SINGLES + zlib.crc32(word[-2:]) % ENDINGS


@dataclass
class Model:
    index: dict[bytes, int] = field(default_factory=dict)
    counts: np.ndarray = None
    classes: np.ndarray = None
    ends: int = 0  # training documents
    total: int = 0  # N
    types: int = 0  # V
    class_mass: np.ndarray = None  # per class, N_k + V_k + 1
    outer: np.ndarray = None  # weights of the groups: rows x groups
    inner: np.ndarray = None  # weights of the classes within a group: (rows x groups) x width
    outer_bias: np.ndarray = None
    inner_bias: np.ndarray = None  # groups x width

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """(ids, classes, first token of each text, other words of each text).

        The end is id 0, head words follow; a word outside the head has the id
        -class.
        """
        ids, firsts, others, at = [], [], [], 0
        for text in texts:
            words = tokens(text)
            mine = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
            rest = {}
            for i in np.flatnonzero(mine < 0).tolist():
                w = words[i]
                rest[w] = rest.get(w, 0) + 1
                mine[i] = -ending_class(w)
            firsts.append(at)
            at += len(words) + 1
            ids += [mine, np.zeros(1, np.int64)]
            others.append(rest)
        ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
        classes = np.where(ids >= 0, self.classes[np.maximum(ids, 0)], -ids)
        return ids, classes, np.array(firsts, np.int64), others

    def features(self, ids: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Weight rows of each token: last word, last two, the one before the last."""
        start = np.zeros(len(ids), bool)
        start[firsts] = True
        begin = np.int64(len(self.counts) + 1)  # stands before every text
        one = np.concatenate([[begin], ids[:-1]])
        one[start] = begin
        two = np.concatenate([[begin], one[:-1]])
        two[start] = begin
        a, b = one.astype(np.uint64) & 0xFFFFFFFF, two.astype(np.uint64) & 0xFFFFFFFF
        mixed = (a * _MIX[0], a * _MIX[0] + b * _MIX[1] + 77, b * _MIX[2] + 191)
        rows = []
        for m in mixed:
            m = m & 0xFFFFFFFF
            rows.append((((m ^ (m >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> (32 - ROW_BITS)).astype(np.int64))
        return np.stack(rows)

    @staticmethod
    def exponentials(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray,
                     space: np.ndarray | None = None) -> np.ndarray:
        """exp of the summed weights of each token, over the largest; in ``space`` (2, tokens, width) if given."""
        if space is None:
            space = np.empty((2, rows.shape[1], weights.shape[1]), weights.dtype)
        z, more = space[0, :rows.shape[1]], space[1, :rows.shape[1]]
        np.take(weights, rows[0], axis=0, out=z, mode="clip")  # other modes copy once more
        for r in rows[1:]:
            z += np.take(weights, r, axis=0, out=more, mode="clip")
        z += bias
        z -= z.max(axis=1, keepdims=True)
        return np.exp(z, out=z)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """P(class | context) of all classes."""
        out = self.exponentials(rows, self.outer, self.outer_bias)
        out = np.repeat(out / out.sum(axis=1, keepdims=True), WIDTH, axis=1)
        for g in range(GROUPS):
            z = self.exponentials(rows * GROUPS + g, self.inner, self.inner_bias[g])
            out[:, g * WIDTH:(g + 1) * WIDTH] *= z / z.sum(axis=1, keepdims=True)
        return out

    def class_scores(self, ids: np.ndarray, classes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """log10 P(class | context) of each token."""
        rows, out = self.features(ids, firsts), np.empty(len(ids))
        group, within = np.divmod(classes, WIDTH)
        for i in range(0, len(ids), BATCH):
            r, g, at = rows[:, i:i + BATCH], group[i:i + BATCH], np.arange(len(ids[i:i + BATCH]))
            z = self.exponentials(r, self.outer, self.outer_bias)
            p = z[at, g] / z.sum(axis=1)
            z = self.exponentials(r * GROUPS + g, self.inner, self.inner_bias[g])
            out[i:i + BATCH] = np.log10(np.maximum(p * (z[at, within[i:i + BATCH]] / z.sum(axis=1)), 1e-30))
        return out

    def flat(self) -> np.ndarray:
        """All weights as one row of numbers."""
        return np.concatenate([x.ravel() for x in (self.outer, self.inner, self.outer_bias, self.inner_bias)])

    def moved(self, change: np.ndarray) -> None:
        """Add a change of all weights."""
        at = 0
        for name in ("outer", "inner", "outer_bias", "inner_bias"):
            x = getattr(self, name)
            setattr(self, name, (x + change[at:at + x.size].reshape(x.shape)).astype(np.float32))
            at += x.size


class _Descent:
    """Local AdaGrad steps from the common weights."""

    def __init__(self, model: Model) -> None:
        self.model, self.n = replace(model, outer=model.outer.copy(), inner=model.inner.copy(),
                                     outer_bias=model.outer_bias.copy(), inner_bias=model.inner_bias.copy()), 0
        self.seen = np.ones(ROWS, np.float32), np.ones(ROWS * GROUPS, np.float32)
        # Kept, so that no step asks for new memory.
        self.space = np.empty((2, BATCH, GROUPS), np.float32), np.empty((2, BATCH, WIDTH), np.float32)

    def _move(self, rows: np.ndarray, target: np.ndarray, weights: np.ndarray, bias: np.ndarray,
              seen: np.ndarray, space: np.ndarray) -> np.ndarray:
        """One step of the weights; the first of ``rows`` ascends.  Gives the slope of each token."""
        p = Model.exponentials(rows, weights, bias, space)
        p /= p.sum(axis=1, keepdims=True)
        spare = space[1, :len(p)]
        p[np.arange(len(p)), target] -= 1
        for k, r in enumerate(rows):
            ordered, slopes = r, p
            if k:
                order = np.argsort(r.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
                ordered, slopes = r[order], np.take(p, order, axis=0, out=spare, mode="clip")
            first = np.flatnonzero(np.diff(ordered, prepend=-1))
            which = ordered[first]
            slope = np.add.reduceat(slopes, first, axis=0)
            seen[which] += np.einsum("ij,ij->i", slope, slope)
            weights[which] -= RATE / np.sqrt(seen[which])[:, None] * slope
        return p

    def step(self, rows: np.ndarray, classes: np.ndarray) -> None:
        m, rate = self.model, np.float32(RATE / 10 / len(classes))
        # In this order the first sums of both tables need no reordering.
        by_last = np.argsort((rows[0] * GROUPS + classes // WIDTH).astype(np.uint16), kind="stable")
        rows, (group, within) = rows[:, by_last], np.divmod(classes[by_last], WIDTH)
        slopes = self._move(rows, group, m.outer, m.outer_bias, self.seen[0], self.space[0])
        m.outer_bias -= rate * slopes.sum(axis=0)
        slopes = self._move(rows * GROUPS + group, within, m.inner, m.inner_bias[group], self.seen[1], self.space[1])
        by_group = np.argsort(group.astype(np.uint16), kind="stable")
        first = np.flatnonzero(np.diff(group[by_group], prepend=-1))
        m.inner_bias[group[by_group][first]] -= rate * np.add.reduceat(slopes[by_group], first, axis=0)
        self.n += len(classes)

    def learn(self, texts: list[bytes | None]) -> None:
        ids, classes, firsts, _ = self.model.encode(texts)
        rows = self.model.features(ids, firsts)
        for i in range(0, len(ids), BATCH):
            self.step(rows[:, i:i + BATCH], classes[i:i + BATCH])


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches of texts, cut so that a group holds about ``FLUSH`` tokens."""
    for batch in batches:
        sizes = np.cumsum([len(t) if (t := x.as_py()) else 0 for x in batch.column(column)])
        cuts = np.searchsorted(sizes, np.arange(0, sizes[-1] if len(sizes) else 0, 6 * FLUSH))
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            if part.num_rows:
                yield part, part.column(column).to_pylist()


def _training(docs: DataFrame) -> tuple[DataFrame, Column]:
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    held_out = hashed % FOLDS == HELD_OUT
    return docs.select("doc_id", F.encode("text", "UTF-8").alias("text"), held_out.alias("held_out"),
                       (hashed % 1_000_003).alias("hash")), held_out


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n) over a binary text column; counted in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def drain() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                              pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out
        for _, group in _grouped(batches, 0):
            for text in group:
                counts.update(tokens(text))
            if len(counts) >= FLUSH:
                yield drain()
        yield drain()
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _head(vocab: DataFrame, size: int) -> list:
    """The most frequent words, at most ``size``, most frequent first."""
    levels = vocab.groupBy("n").count().orderBy(F.desc("n"))
    least, held = None, 0
    for n, many in levels.toLocalIterator():
        if held + many > size:
            break
        least, held = n, held + many
    if least is None:
        return []
    return sorted(vocab.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], bytes(r["word"])))


def _summed(changes: DataFrame, *keys: str) -> DataFrame:
    """Sum the binary float arrays of equal keys, streaming."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["block"], row["salt"])
                change = np.frombuffer(row["change"], np.float32)
                have = sums.setdefault(key, [0, np.zeros(len(change))])
                have[0] += row["n"]
                have[1] += change
        rows = [{"block": k[0], "salt": k[1], "n": n, "change": c.astype(np.float32).tobytes()} for k, (n, c) in sums.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("block", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()), ("change", pa.binary())]))
    return changes.repartition(*keys).mapInArrow(run, changes.schema)


def _round(texts: DataFrame, model: Model) -> None:
    """One synchronous round: move the model's weights by the mean of the tasks' changes."""
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        local = _Descent(sent.value)
        for _, group in _grouped(batches, 0):
            local.learn(group)
        if not local.n:
            return
        change = ((local.model.flat() - sent.value.flat()) * local.n).astype(np.float32)
        salt = TaskContext.get().partitionId() % SALTS
        parts = [change[i:i + BLOCK] for i in range(0, len(change), BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([salt] * len(parts), pa.int32()),
             pa.array([local.n] * len(parts), pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["block", "salt", "n", "change"])

    changes = texts.mapInArrow(run, "block int, salt int, n long, change binary")
    total = _summed(_summed(changes, "block", "salt").withColumn("salt", F.lit(0)), "block")
    got = sorted(total.collect())  # the weights' number of numbers
    sent.unpersist()
    if got:
        model.moved(np.concatenate([np.frombuffer(r["change"], np.float32) / r["n"] for r in got]))


def fit(docs: DataFrame, rounds: int = ROUNDS, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The trained model, and the vocabulary table (word, n) of the training documents."""
    rows, _ = _training(docs)
    train = rows.where("not held_out")
    vocab = materialize(vocabulary(train.select("text")))
    ends = train.count()
    top = _head(vocab, head)
    singles = [bytes(r["word"]) for r in top[:SINGLES]]
    model = Model({bytes(r["word"]): i + 1 for i, r in enumerate(top)},
                  np.array([ends, *(r["n"] for r in top)], np.int64),
                  np.array([0, *(i + 1 if i < SINGLES else ending_class(bytes(r["word"]))
                                 for i, r in enumerate(top))], np.int64), ends)
    ending = F.crc32(F.expr("substring(word, -2, 2)")) % ENDINGS
    per = (vocab.where(~F.col("word").isin(singles) if singles else F.lit(True))
           .groupBy(ending.cast("int").alias("k")).agg(F.sum("n"), F.count("*")).collect())
    sums = vocab.agg(F.sum("n"), F.count("*")).first()
    model.total, model.types = (sums[0] or 0) + ends, sums[1] + (ends > 0)
    mass, freq = np.ones(CLASSES), np.ones(CLASSES)
    freq[0] += ends
    freq[1:1 + len(singles)] += model.counts[1:1 + len(singles)]
    for k, n, v in per:
        mass[1 + SINGLES + k], freq[1 + SINGLES + k] = n + v + 1, 1 + n
    model.class_mass = mass
    freq = freq.reshape(GROUPS, WIDTH)
    model.outer = np.zeros((ROWS, GROUPS), np.float32)
    model.inner = np.zeros((ROWS * GROUPS, WIDTH), np.float32)
    model.outer_bias = np.log(freq.sum(axis=1) / freq.sum()).astype(np.float32)
    model.inner_bias = np.log(freq / freq.sum(axis=1, keepdims=True)).astype(np.float32)
    for r in range(rounds):
        _round(train.where(F.col("hash") % rounds == r).select("text"), model)
    return model, vocab


def score(docs: DataFrame, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    model, vocab = fit(docs, rounds, head)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        inner = np.log10((m.counts + 1) / m.class_mass[m.classes])
        inner[m.classes <= SINGLES] = 0  # alone in its class
        base = np.log10(m.counts + 1)
        for part, group in _grouped(batches, 2):
            ids, classes, firsts, others = m.encode(group)
            known = np.maximum(ids, 0)
            per_token = m.class_scores(ids, classes, firsts) + np.where(
                ids >= 0, inner[known], -np.log10(m.class_mass[classes]))
            sizes = np.diff(np.append(firsts, len(ids)))

            def total(x: np.ndarray, firsts: np.ndarray = firsts) -> pa.Array:
                return pa.array(np.add.reduceat(x, firsts))
            words = [list(o) for o in others]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sizes, pa.int64()),
                 total(np.where(ids >= 0, m.counts[known] > 0, False).astype(np.int64)),
                 total(np.where(ids >= 0, base[known], 0.0)), total(per_token),
                 pa.array(words, pa.list_(pa.binary())),
                 pa.array([list(o.values()) for o in others], pa.list_(pa.int64()))],
                ["doc_id", "held_out", "n_tokens", "known", "base", "inner", "words", "many"])

    rows, _ = _training(docs)
    schema = (f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, known long, base double, "
              "inner double, words array<binary>, many array<long>")
    part = materialize(rows.select("doc_id", "held_out", "text").mapInArrow(run, schema)
                       .withColumn("row", F.monotonically_increasing_id()))
    other = part.select("row", F.explode_outer(F.arrays_zip("words", "many")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.many").alias("many")).where("word is not null")
    found = other.join(vocab, "word", "left")
    gain = F.col("many") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)
    rest = found.groupBy("row").agg(F.sum(gain).alias("gain"),
                                    F.sum(F.when(F.col("n") > 0, F.col("many")).otherwise(0)).alias("known2"))
    norm = math.log10(model.total + model.types + 1)
    gain = F.coalesce("gain", F.lit(0.0))
    return part.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("known2", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + gain - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("inner") + gain).alias("score"))
