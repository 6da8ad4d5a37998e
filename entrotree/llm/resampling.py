"""Operator 13: importance resampling towards a target distribution.

Every run of 1 to ``n`` consecutive words is a feature, counted in the bucket of
its CRC-32.  A bucket's gain is the log-ratio of its add-one share of the target
to that of the corpus, in thousandths; a document's weight is the floored mean
gain of its features.  A keyed Gumbel number is added, and the documents of the
highest sums are drawn: a sample without replacement by importance weight.

CRCs are taken of distinct features only, and of many at once: features of equal
length are the rows of a matrix of bytes, whose CRCs advance together, one
column at a time; the results are scattered back to the features' places.

Scale: two passes over the texts, in record batches; a task keeps one count per
bucket, and a bounded number of features with their buckets.  Texts are read in
slices, whatever their length, and never shuffled.  The gains, one number per
bucket, are all that is broadcast.  Scores are whole numbers within a range that
does not depend on the data, so their histogram gives the lowest score drawn,
and only documents from there on are sorted, in ranges.

Defined cases: a null, empty or wordless text has no feature, weight 0, and is
never drawn (too few words); a null doc_id is hashed as the empty text and ranks
last among equals; repeated rows all count, and each may be drawn; documents of
equal score rank by id, rows alike in both in a fixed but arbitrary order; with
an empty target or corpus the add-one shares remain; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, materialize

N = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
SLICE = 1 << 20  # bytes of a text that are cut into words at once
KNOWN = 300_000  # features whose buckets a worker remembers
HELD = 50_000  # features whose buckets are looked up at once
LONG = 512  # longer features are hashed one by one: matrices of few rows gain nothing

# Bytes of words are digits, a-z and all of other scripts; A-Z is lowered, the rest parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def _crc_table() -> np.ndarray:
    """The change of a CRC-32 by each byte (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc32_all(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by matrices of features of equal length."""
    out = np.empty(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    firsts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for places in np.split(order, firsts[1:]):
        if not len(places):
            continue
        size = int(lengths[places[0]])
        if size > LONG:
            out[places] = [zlib.crc32(features[i]) for i in places]
            continue
        matrix = np.frombuffer(b"".join([features[i] for i in places]), np.uint8).reshape(len(places), size)
        crc = np.full(len(places), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
        out[places] = ~crc
    return out


def feature_runs(text: bytes | None, n: int = N, size: int = SLICE) -> Iterator[tuple[int, list[bytes]]]:
    """(words, features) of each slice of a text; runs of words reach across slices."""
    clean, at, before = (text or b"").translate(_FOLD), 0, []
    while at < len(clean):
        end = clean.find(b" ", at + size)
        end = len(clean) if end < 0 else end
        fresh = clean[at:end].split()
        found = list(fresh)
        words = before + fresh
        for k in range(2, n + 1):
            found += [b" ".join(words[i:i + k]) for i in range(max(0, len(before) - k + 1), len(words) - k + 1)]
        yield len(fresh), found
        before = words[len(words) - n + 1:] if n > 1 and len(words) >= n else words if n > 1 else []
        at = end


class _Buckets:
    """Buckets of features; distinct ones are hashed together and remembered."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.known = buckets, {}

    def __call__(self, features: list[bytes]) -> np.ndarray:
        fresh = [f for f in set(features) if f not in self.known]
        if fresh:
            if len(self.known) + len(fresh) > KNOWN:
                self.known.clear()
                fresh = list(set(features))
            self.known.update(zip(fresh, (crc32_all(fresh) % self.buckets).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(column).cast(pa.binary()))


def bucket_counts(docs: DataFrame, n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of the ``text`` column; at most ``buckets`` rows a task are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            held = []
            for text in _texts(batch, 0):
                for _, found in feature_runs(text, n):
                    held += found
                    if len(held) >= HELD:
                        counts += np.bincount(place(held), minlength=buckets)
                        held = []
            counts += np.bincount(place(held), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def fit_gains(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: floored thousandths of the log-ratio of target to corpus shares."""
    def read(table: DataFrame) -> tuple[list[int], int]:
        counts = [0] * buckets
        for r in bucket_counts(table, n, buckets).collect():  # at most one row per bucket
            counts[r["bucket"]] = r["n"]
        return counts, sum(counts)

    (s, s_all), (t, t_all) = read(docs), read(target)
    return np.array([math.floor(1000 * math.log(float(t[b] + 1) * float(s_all + buckets)
                                                / (float(s[b] + 1) * float(t_all + buckets))))
                     for b in range(buckets)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, n: int = N) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        place = _Buckets(len(gain))
        for batch in batches:
            rows = []
            for text in _texts(batch, 1):
                n_words = n_features = total = 0
                for words, found in feature_runs(text, n):
                    n_words, n_features = n_words + words, n_features + len(found)
                    total += int(gain[place(found)].sum())
                rows.append((n_words, n_features, total // n_features if n_features else 0))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def draw(weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """Add ``score`` and ``rank`` (1, 2, ... of the drawn, else null) to the rows of ``weigh``.

    The scores' histogram has at most some 130,000 rows: weight and Gumbel
    number are whole and bounded by the logarithms of 64-bit and 32-bit counts.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = materialize(weighed.withColumn("score", (F.col("weight") + gumbel).cast("long"))
                         .withColumn("_row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= min_words
    levels = sorted(((r["score"], r["count"]) for r in scored.where(able).groupBy("score").count().collect()),
                    reverse=True)
    many = percent * sum(c for _, c in levels) // 100
    lowest, held = None, 0
    for score, count in levels:
        if held >= many:
            break
        lowest, held = score, held + count
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop("_row")
    chosen = able & (F.col("score") >= lowest)
    ranked = global_rank(scored.where(chosen), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                         F.col("_row"), name="rank")
    return (ranked.withColumn("rank", F.when(F.col("rank") <= many, F.col("rank")))
            .unionByName(scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))).drop("_row"))


def resample(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``, drawn towards ``target``."""
    return draw(weigh(docs, fit_gains(docs, target, n, buckets), n), percent, min_words, seed)
