"""Operator 10: toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded (case, accents, homoglyphs, digits that stand for letters) and
cut into words.  The lexicon holds word beginnings, each with a weight; a match
inside an exception phrase does not count.  The summed weights, as such and per
word, are mapped to a score between 0 and 1 by a logistic curve.

Lexicon, exceptions and curve are learned from labels, on at most
``TRAIN_ROWS`` documents of each label (smallest id hash); every document is
scored, whole.  Labels, lang, source and doc_id never enter a score.

Scale: one Arrow pass over the texts, no shuffle; the model is
short strings found in the bounded sample, which learning reads alone.

Defined cases: null and empty texts score as texts without a match; repeated
documents are scored one by one; null ids and labels are never trained on;
without labels of both kinds every score is 0; empty tables give no rows; extra
columns pass through ``score``.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_ROWS = 4_000
HELD_OUT_OF, HELD_OUT = 5, 0
STEM = range(4, 9)  # letters of a word beginning that may become an entry
MIN_SUPPORT = 5  # toxic training documents, and different words before it, that an entry needs
MIN_SPREAD = 0.4  # different words before an entry, per toxic document that holds it
FREQUENT = 0.01  # share of the toxic documents from which a term counts as frequent
CLEAN_COST = 3  # toxic texts an entry must add for each clean one that holds it
MIN_LOG_ODDS = 2.5
RIDGE = 1e-3

#: Characters that look like Latin letters, and digits or signs used for them (fixed values).
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ё": "e", "ї": "i",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}


def _fold_table() -> dict[int, str]:
    table = {}
    for code in (*range(0xA0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *range(0xFF00, 0xFF60)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)).lower() if not unicodedata.combining(c))
        base = "".join(HOMOGLYPHS.get(c, c) for c in base)
        if base != chr(code):
            table[code] = base
    return table | {ord(k): v for k, v in HOMOGLYPHS.items()} | dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D), "")


_FOLD = _fold_table()
_WORD = re.compile(r"[^\W_]+")


def folded_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower().translate(_FOLD))


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, ...] = (-50.0, 0.0, 0.0)


class Matcher:
    """The automaton of a lexicon; words are parted and enclosed by blanks."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str] = ()) -> None:
        self.lexicon, self.tree = lexicon, ahocorasick.Automaton()
        for stem in lexicon:
            self.tree.add_word(f" {stem}", (len(stem), stem))
        for phrase in exceptions:
            self.tree.add_word(f" {phrase} ", (len(phrase) + 1, None))
        if len(self.tree):
            self.tree.make_automaton()

    def hits(self, line: str) -> list[tuple[int, str]]:
        """(start, stem) of matches outside exception phrases; the longest stem at a start."""
        if not len(self.tree):
            return []
        best, covered = {}, []
        for end, (n, stem) in self.tree.iter(line):
            start = end - n + 1
            if stem is None:
                covered.append((start, end))
            elif len(stem) > len(best.get(start, "")):
                best[start] = stem
        return [(s, x) for s, x in best.items() if not any(a <= s < b for a, b in covered)]

    def weigh(self, text: str | None) -> tuple[float, int]:
        """(sum of weights, words)."""
        words = folded_words(text)
        return sum(self.lexicon[x] for _, x in self.hits(f" {' '.join(words)} ")), len(words)


def _features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), np.log1p(weight), 100 * weight / np.maximum(words, 1) / 10], axis=1)


def _probability(x: np.ndarray, curve: tuple[float, ...]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ np.array(curve), -50, 50)))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic): at most ``rows`` documents of each label, none that is held out.

    A label names an id, which several rows may have: equal rows count once, and
    the bound is taken over the rows, by hash.
    """
    known = (labels.where("toxic in (0, 1) and doc_id is not null")
             .where(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_OF != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = [known.where(f"toxic = {k}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    chosen = chosen[0].union(chosen[1])  # at most 2 x rows
    found = (docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_h")).join(F.broadcast(chosen), "doc_id")
             .groupBy("toxic", "doc_id", "_h").agg(F.first("text").alias("text")))
    parts = [found.where(f"toxic = {k}").orderBy("_h", "doc_id").limit(rows) for k in (0, 1)]
    return parts[0].union(parts[1]).select("text", "toxic")


def _terms(sample: DataFrame, lister) -> DataFrame:
    """Per term that ``lister`` finds in a text: toxic and other documents that hold it."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(lister(t)) for t in texts])
    return (sample.select("toxic", F.explode_outer(run("text")).alias("term")).where("term is not null")
            .groupBy("term").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")))


def _stems(text: str | None) -> set[str]:
    return {w[:n] for w in set(folded_words(text)) for n in STEM if n <= len(w)}


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn lexicon, exceptions and curve from the bounded sample."""
    sample = training_sample(docs, labels, rows).persist()
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(size) < 2:
        sample.unpersist()
        return Model()
    odds = (F.log((F.col("pos") + 0.5) / (size[1] + 1.0)) - F.log((F.col("neg") + 0.5) / (size[0] + 1.0)))
    found = (_terms(sample, _stems).withColumn("w", odds)
             .where((F.col("pos") >= MIN_SUPPORT) & (F.col("w") >= MIN_LOG_ODDS))
             .orderBy(F.desc("pos"), F.length("term"), "term").collect())  # of the bounded sample
    weight = {r["term"]: r["w"] for r in found}
    clean_docs = {r["term"]: r["neg"] for r in found}

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def held(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            words = folded_words(t)
            out.append(sorted({(w[:n], before) for before, w in zip(["", *words], words, strict=False)
                               for n in STEM if n <= len(w) and w[:n] in weight}))
        return pd.Series(out)

    pairs = [r[0] for r in sample.where("toxic = 1").select(held("text")).collect()]  # at most ``rows``
    # Copies of one text repeat a word with the same neighbour; a term must stand in many contexts.
    contexts: dict[str, set[str]] = {}
    for got in pairs:
        for stem, before in got:
            contexts.setdefault(stem, set()).add(before)
    docs_of = {r["term"]: r["pos"] for r in found}
    spread = {t for t, c in contexts.items() if len(c) >= max(MIN_SUPPORT, MIN_SPREAD * docs_of[t])}
    lexicon, left = {}, [{stem for stem, _ in got} & spread for got in pairs]
    while True:  # the entry that explains most texts not yet explained, clean ones held against it
        gain: dict[str, int] = {}
        for terms in left:
            for t in terms:
                gain[t] = gain.get(t, 0) + 1
        best = max(gain, key=lambda t: (gain[t] - CLEAN_COST * clean_docs[t], len(t), t), default=None)
        if best is None or gain[best] < 2 or gain[best] <= CLEAN_COST * clean_docs[best]:
            break
        lexicon[best] = weight[best]
        left = [terms for terms in left if best not in terms]
    # Frequent entries that no clean text holds come along, for texts that hold them alone.
    enough = max(MIN_SUPPORT, FREQUENT * size[1])
    for t in sorted(spread, key=lambda t: (-docs_of[t], -len(t), t)):
        if not clean_docs[t] and docs_of[t] >= enough and not any(
                t.startswith(x) or x.startswith(t) for x in lexicon):
            lexicon[t] = weight[t]
    matcher = Matcher(lexicon)

    def phrases(text: str | None) -> set[str]:
        words = folded_words(text)
        out, at, starts = set(), 1, {}  # the line begins with a blank
        for i, w in enumerate(words):
            starts[at] = i
            at += len(w) + 1
        for start, _ in matcher.hits(f" {' '.join(words)} "):
            i = starts[start]
            out |= {words[i], " ".join(words[max(i - 1, 0):i + 1]), " ".join(words[i:i + 2])}
        return out

    clean = (_terms(sample, phrases).withColumn("w", odds).where("neg >= 2 and w <= 0")
             .orderBy(F.desc("neg"), "term").collect())  # of the bounded sample
    exceptions = [r["term"] for r in clean]
    judged = Matcher(lexicon, exceptions)

    @F.pandas_udf("weight double, words long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judged.weigh(t) for t in texts], columns=["weight", "words"])

    rows_ = sample.select("toxic", weigh("text").alias("x")).select("toxic", "x.*").collect()  # at most 2 x rows
    sample.unpersist()
    y = np.array([r["toxic"] for r in rows_], float)
    x = _features(np.array([r["weight"] for r in rows_]), np.array([r["words"] for r in rows_]))
    beta = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = _probability(x, beta)
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + RIDGE * np.eye(len(beta))
        beta -= np.linalg.solve(hess, x.T @ (p - y) / len(y) + RIDGE * beta)
    return Model(lexicon, exceptions, tuple(beta))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        m = sent.value
        matcher = Matcher(m.lexicon, m.exceptions)
        got = np.array([matcher.weigh(t) for t in texts], float).reshape(-1, 2)
        return pd.Series(_probability(_features(got[:, 0], got[:, 1]), m.curve))

    return docs.withColumn("score", run("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def judge(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, rows))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % HELD_OUT_OF == HELD_OUT
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
