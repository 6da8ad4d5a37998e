"""Operator 3: quality rules; documents are judged by built-in expressions only.

Counted rules per document, and a hashed n-gram log-likelihood ratio between
two multinomials: one of trusted documents, one of the whole raw corpus, the
trusted counts smoothed by what the raw counts let expect, so that the ratio of
a rare n-gram is near 0 whatever the number of buckets.  The mean ratio per
n-gram is compared with one threshold for all documents.  Every trusted document
is fitted on, and every one sets the threshold: it is scored by the model of the
trusted documents outside its own fold, and the threshold lies ``SPREAD`` times as
far below the median of these scores as their 5th percentile, so it follows the
scores when buckets fill up.

Scale: the model is ``FOLDS`` + 1 arrays of ``BUCKETS`` numbers (fixed by
parameters, not by the data); counting them is one partially aggregated pass,
scoring one narrow pass that looks the numbers up, and the threshold takes one
more such pass over the trusted documents and ranks the scores over ranges.  Documents are shuffled only to find the trusted ones, and only if their ids are
more than a broadcast may hold.  Repeated windows are found by sorting 64-bit
hashes inside the row.

Defined cases: a null text has no words (base_failed, not kept); rows are
judged one by one, so repeats and null ids are ordinary rows; without trusted
documents the ratio of every document is 0 and only the base rules decide, as
they do when no trusted document passes them to set the threshold; an empty table
gives no rows; extra columns pass through ``judge``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import fits_broadcast
from .common import BLANKS, global_rank, let, materialize, text_of, words

BUCKETS = 1 << 18
SMOOTHING = 1.0
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Parts of the trusted documents; each is scored by a model of the others.
FOLDS = 5
#: Distance of the threshold from the median, in distances of the 5th percentile.
SPREAD = 1.5
SYMBOLS = "#*$%&|<>"  # fixed by the contract


def _shifted(h: Column, by: int) -> Column:
    """``h`` without its first ``by`` elements (one copy per row, none per element)."""
    return F.slice(h, by + 1, F.greatest(F.size(h) - by, F.lit(0)))


def _joined(h: Column, by: int) -> Column:
    """Hash of each element with the one ``by`` later; as many as have one."""
    return F.slice(F.zip_with(h, _shifted(h, by), lambda a, b: F.xxhash64(a, b)),
                   1, F.greatest(F.size(h) - by, F.lit(0)))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _grams(h1: Column, h2: Column) -> Column:
    """Buckets of all words (``h1``) and all adjacent pairs (``h2``)."""
    return F.transform(F.concat(h1, h2), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def _covered(windows: Column) -> Column:
    """Words covered by windows (hashes in text order) that occur twice or more."""
    def starts(s: Column) -> Column:
        def same(j: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
        again = F.filter(s, lambda x, k: same(k, k + 1)
                         | F.when(k > 0, same(k - 1, k)).otherwise(F.lit(False)))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def cover(p: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(p, zero, lambda acc, x: F.struct(
            (acc["n"] + x + WINDOW - F.greatest(x, acc["end"])).alias("n"),
            (x + WINDOW).alias("end")), lambda acc: acc["n"])

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(ordered, starts), cover)


def rule_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, _h, _h2."""
    t = F.col("_t")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    # Each step is a column of its own, so that none is evaluated twice.
    counted = (docs.withColumn("_t", text_of()).withColumn("_w", words(t))
               .withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
               .withColumn("_h2", _joined(F.col("_h"), 1))
               .withColumn("_h4", _joined(F.col("_h2"), 2))
               .withColumn("_h8", _joined(F.col("_h4"), 4)))
    repeats = F.when(F.size(F.array_distinct("_h8")) < F.size("_h8"), _covered(F.col("_h8")))
    counted = counted.select(
        "*",
        F.size("_h").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return counted.withColumn("base_failed", failed).drop("_t", "_w", "_h4", "_h8")


def _trusted(labels: DataFrame) -> DataFrame:
    """(doc_id, _fold) of every document of label quality 1, marked to be broadcast if they are few."""
    ids = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    fold = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(FOLDS)).cast("int")
    return (F.broadcast(ids) if fits_broadcast(ids) else ids).withColumn("_fold", fold)


def fit_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Per bucket, log of trusted over expected count, in thousandths (``FOLDS`` + 1 rows of ``BUCKETS`` integers).

    Raw counts cover every document; the expected count is the raw count's share
    of the trusted n-grams.  Row k leaves the trusted documents of fold k out, the
    last row none.
    """
    grams = (docs.select("doc_id", let(_word_hashes(text_of()), lambda h: _grams(h, _joined(h, 1))).alias("b"))
             .join(_trusted(labels), "doc_id", "left")
             # explode() would add a filter on the array that computes it a second time.
             .select("_fold", F.explode_outer("b").alias("bucket")))
    held = [F.count(F.when(F.col("_fold") == k, 1)).alias(f"t{k}") for k in range(FOLDS)]
    counts = grams.groupBy("bucket").agg(F.count("*").alias("r"), *held)
    # At most BUCKETS rows, whatever the input.
    bucket, r, *held = (c.to_numpy() for c in counts.where("bucket is not null").toArrow().columns)
    ratio, whole = np.zeros((FOLDS + 1, BUCKETS), np.int64), sum(held)
    for row, t in zip(ratio, [*(whole - h for h in held), whole], strict=True):
        if t.sum():
            expected = r * (t.sum() / r.sum())
            row[bucket] = np.rint(1000 * np.log((t + SMOOTHING) / (expected + SMOOTHING)))
    return ratio


def _with_score(counted: DataFrame, ratio: np.ndarray, model: Column) -> DataFrame:
    """``counted`` with ``score``: mean log ratio by the row ``model`` of ``ratio``, 0 without n-grams.

    The numbers are the one value of a scalar subquery, which every task gets with its
    plan.  As a literal they are printed with each plan, and as a table to join they are
    held by the driver several times over, as rows and as a hash table.  The subquery is a
    column of its own because lambdas may hold none; the planner moves it to its only use.
    """
    numbers = pa.array([ratio.astype(np.int32).ravel()], pa.list_(pa.int32()))
    table = counted.sparkSession.createDataFrame(pa.table({"numbers": numbers}))
    total = let(_grams(F.col("_h"), F.col("_h2")), lambda b: F.aggregate(
        b, F.lit(0).cast("long"), lambda acc, x: acc + F.get(F.col("_ratio"), model * BUCKETS + x),
        lambda acc: F.when(F.size(b) > 0, acc / (1000.0 * F.size(b))).otherwise(F.lit(0.0))))
    return counted.withColumn("_ratio", table.scalar()).withColumn("score", total).drop("_ratio", "_h", "_h2")


def _scored(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with the rule counts and ``score`` (mean log ratio) by the model of all trusted documents."""
    return _with_score(rule_counts(docs), ratio[FOLDS:], F.lit(0))


def _scores_by_others(trusted: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``score`` of each row of ``trusted`` by the model without the row's ``_fold``, null where the base rules fail."""
    scored = _with_score(rule_counts(trusted), ratio[:FOLDS], F.col("_fold"))
    return scored.select(F.when(~F.col("base_failed"), F.col("score")).alias("score"))


def _percentiles(scores: DataFrame, *shares: float) -> list[float]:
    """Exact percentiles of the column ``score``, between two neighbours by their distance; no rows, none."""
    n = scores.count()
    if not n:
        return []
    at = [(n - 1) * share for share in shares]
    wanted = {int(p) + up for p in at for up in (1, 2)}
    found = global_rank(scores, F.col("score")).where(F.col("rank").isin(sorted(wanted))).collect()
    score = {r["rank"]: r["score"] for r in found}
    return [score[int(p) + 1] + (p % 1 and (p % 1) * (score[int(p) + 2] - score[int(p) + 1])) for p in at]


def fit_threshold(docs: DataFrame, labels: DataFrame, ratio: np.ndarray) -> float:
    """The score below which a document goes, from all trusted documents that pass the base rules."""
    trusted = docs.select("doc_id", "text").join(_trusted(labels), "doc_id")
    scores = materialize(_scores_by_others(trusted, ratio))
    found = _percentiles(scores.where("score is not null"), 0.5, 0.05)
    if not found:
        return float("-inf")
    middle, low = found
    return middle - SPREAD * (middle - low)


def judge(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """``docs`` with the rule counts, ``score`` (mean log ratio), ``base_failed`` and ``kept``.

    Without a ``threshold`` the trusted documents set it.
    """
    ratio = fit_ratio(docs, labels)
    if threshold is None:
        threshold = fit_threshold(docs, labels, ratio)
    return _scored(docs, ratio).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps.

    A filter on a computed column is moved below the columns it comes from, and
    each of them is then written out again wherever it occurs.  A row number
    beside the verdict holds the filter above it.
    """
    judged = judge(docs, labels, threshold).withColumn("_row", F.monotonically_increasing_id())
    return judged.where("kept and _row >= 0").select(docs.columns)
