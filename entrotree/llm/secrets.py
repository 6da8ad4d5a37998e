"""Operator 2: secret scans, built-in expressions only.

Three fixed patterns give the base findings.  The method adds high-entropy
tokens: two first-order character Markov models, of random strings and of
ordinary identifiers, are trained from labelled samples; a token whose mean
log-likelihood ratio per transition is above a threshold is a finding.

Labelled samples come from the documents themselves: the values that the base
patterns catch are random strings, the other tokens of a sample of the texts identifiers.

Scale: every text is read whole, in place; nothing but the training sample and
a table of ``CODES`` squared numbers leaves the scan, so there is no
shuffle of documents.  Time grows with the length of a text: positions are
running sums in blocks, and texts are rebuilt from chunks.

Defined cases: a null text is empty; very long texts are scanned whole; equal
starts are ordered by kind; rows are scanned one by one, so repeats and null
ids are ordinary rows; without any labelled sample the method adds nothing; an
empty table gives no rows; extra columns pass through ``scan``, where ``base``
and ``found`` replace columns of those names, and all stay in ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of

#: The base patterns (fixed values); keyword letters in either case.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # maximal runs: the length test can stand in the pattern
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")  # order at equal starts
MIN_ASSIGN = 6

#: Characters a scored token is made of; anything else ends it.
TOKEN_CLASS = "A-Za-z0-9+/_=-"
FIRST, CODES, LETTERS = 43, 80, 67  # code of "+", span of codes up to "z", characters in the class
MIN_TOKEN = 16
#: Documents whose other tokens train the identifier model at most (smallest id hash),
#: and caught values that train the random model at most (smallest hash).
SAMPLE_DOCS = 2_000
SAMPLE_VALUES = 20_000
SMOOTHING = 0.5
BACKOFF = 5.0  # weight of the single-character frequencies in a transition
BLOCK, CHUNK = 512, 1024  # values and code points handled at once in one text
#: Mean log-likelihood ratio (nats per transition) from which a token is a finding.
THRESHOLD = 1.5


def _running(values: Column, combine) -> Column:
    """Running ``combine`` (sum or maximum, from 0) of an array of counts.

    An accumulator that grows is copied at every step, so blocks of ``BLOCK``
    values are run one by one and then moved by what the blocks before give.
    """
    def within(part: Column) -> Column:
        return F.aggregate(part, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(
            combine(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)), x))))

    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / BLOCK).cast("int")),
                           lambda i: within(F.slice(v, i * BLOCK + 1, BLOCK)))

    def moved(done: Column) -> Column:
        return let(within(F.transform(done, lambda d: F.get(d, F.size(d) - 1))), lambda before: F.flatten(F.transform(
            done, lambda d, i: let(F.coalesce(F.get(before, i - 1), F.lit(0)), lambda at: F.transform(
                d, lambda x: combine(at, x))))))
    return let(values, lambda v: let(blocks(v), moved))


def _found(text: Column, pattern: str, kind: int, keep) -> Column:
    """Array of (start, kind, end) of leftmost non-overlapping matches that ``keep`` accepts.

    ``split`` gives the texts between the matches, so ends are running sums of
    lengths in code points.
    """
    def spans(m: Column, gaps: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, 1, F.size(m)), m, lambda g, x: F.length(g) + F.length(x))
        pairs = F.zip_with(m, _running(sizes, lambda a, b: a + b), lambda x, end: F.struct(
            (end - F.length(x)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), keep(x).alias("ok")))
        return F.transform(F.filter(pairs, lambda s: s["ok"]), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.rlike(text, F.lit(pattern)), let(hit, lambda m: let(
        F.split(text, pattern), lambda g: spans(m, g)))).otherwise(none)


def _rebuilt(text: Column, spans: Column, fill) -> Column:
    """The text with sorted spans replaced: ``fill(span, at)``, ``at`` being where the spans before end.

    The text is taken in chunks, for ``substring`` walks from the start of what it is given.
    """
    def cut(chunks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        some = F.floor(F.greatest(end - 1, start) / CHUNK).cast("int") - first + 1
        return F.substring(F.array_join(F.slice(chunks, first + 1, some), ""), start - first * CHUNK + 1, end - start)

    def joined(chunks: Column, tops: Column) -> Column:
        parts = F.transform(spans, lambda s, i: let(F.coalesce(F.get(tops, i - 1), F.lit(0)), lambda at: F.concat(
            cut(chunks, at, F.greatest(s["start"], at)), fill(s, at))))
        return F.concat(F.array_join(parts, ""), cut(chunks, F.get(tops, F.size(tops) - 1), F.length(text)))

    ends = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(let(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)),
        lambda chunks: let(ends, lambda tops: joined(chunks, tops))))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) of the three fixed patterns, sorted."""
    def any_match(_: Column) -> Column:
        return F.lit(True)
    return F.sort_array(F.concat(
        _found(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_ASSIGN),
        _found(text, ACCESS, 1, any_match), _found(text, HEX, 2, any_match)))


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS,
                     sample_values: int = SAMPLE_VALUES) -> DataFrame:
    """(sample, random): values the base patterns catch, and plain words of a bounded sample."""
    t = text_of()
    values = F.concat(F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)),
                               lambda v: F.length(v) >= MIN_TOKEN),
                      F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)),
                      F.regexp_extract_all(t, F.lit(HEX), F.lit(0)))
    hit = F.rlike(t, F.lit(ASSIGN)) | F.rlike(t, F.lit(f"{ACCESS}|{HEX}"))
    random = (docs.where(hit).select(F.explode(values).alias("sample")).distinct()
              .orderBy(F.xxhash64("sample"), "sample").limit(sample_values))
    chosen = (docs.where("doc_id is not null").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    plain = (docs.join(F.broadcast(chosen), "doc_id", "left_semi")  # at most sample_docs ids
             .select(F.explode_outer(F.regexp_extract_all(t, F.lit(f"[{TOKEN_CLASS}]{{4,}}"), F.lit(0))).alias("sample"))
             .where(F.col("sample").isNotNull() & ~F.rlike("sample", F.lit(f"{ACCESS}|{HEX}"))))
    return random.select("sample", F.lit(True).alias("random")).union(
        plain.select("sample", F.lit(False).alias("random")))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition (random over identifier), row-major by code."""
    codes = F.transform(F.split(F.regexp_replace("sample", f"[^{TOKEN_CLASS}]+", ""), ""), F.ascii)
    pairs = let(codes, lambda c: F.zip_with(c, F.slice(c, 2, F.size(c)), lambda a, b: F.struct(
        a.alias("a"), b.alias("b"))))
    counts = (samples.select("random", F.explode_outer(pairs).alias("p"))
              .where("p.a >= 43 and p.b >= 43").groupBy("random", "p.a", "p.b").count()
              .collect())  # at most 2 x LETTERS x LETTERS rows
    seen = {(r["random"], r["a"] - FIRST, r["b"] - FIRST): r["count"] for r in counts}
    kinds, codes = (True, False), range(CODES)
    after = {(k, a): sum(seen.get((k, a, b), 0) for b in codes) for k in kinds for a in codes}
    onto = {(k, b): sum(seen.get((k, a, b), 0) for a in codes) for k in kinds for b in codes}
    total = {k: sum(after[k, a] for a in codes) for k in kinds}
    if not all(total.values()):
        return [0.0] * CODES * CODES

    def log_p(kind: bool, a: int, b: int) -> float:
        alone = (onto[kind, b] + SMOOTHING) / (total[kind] + SMOOTHING * LETTERS)
        return math.log((seen.get((kind, a, b), 0) + BACKOFF * alone) / (after[kind, a] + BACKOFF))
    return [round(log_p(True, a, b) - log_p(False, a, b), 4) for a in range(CODES) for b in range(CODES)]


def token_ratio(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio per transition of a token of the class."""
    def total(c: Column) -> Column:
        steps = F.zip_with(c, F.slice(c, 2, F.size(c)),
                           lambda a, b: F.get(table, (a - FIRST) * CODES + b - FIRST))
        return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0))) / (F.size(c) - 1)
    return let(F.transform(F.split(token, ""), F.ascii), total)


def _row(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def scan(docs: DataFrame, samples: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (start, kind, end), sorted by start and kind.

    ``found`` holds the base findings and what the models add outside them: a
    token that a base finding overlaps is scored without the overlapped part.
    ``samples`` (sample, random) train the models; by default they come from ``docs``.
    """
    ratios = train(labelled_samples(docs) if samples is None else samples)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    based = docs.select(_row(docs).alias("_row"), text_of().alias("_t")).withColumn("_base", base_spans(F.col("_t")))
    masked = based.withColumn("_t", _rebuilt(F.col("_t"), F.col("_base"), lambda s, at: F.repeat(
        F.lit(" "), F.greatest(s["end"], at) - F.greatest(s["start"], at))))
    tokens = _found(F.col("_t"), f"[{TOKEN_CLASS}]{{{MIN_TOKEN},}}", 3, lambda m: token_ratio(m, table) >= threshold)
    return masked.withColumn("_found", F.sort_array(F.concat("_base", tokens))).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in ("base", "found")],
        F.col("_base").alias("base"), F.col("_found").alias("found"))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """doc_id, counts of base findings by kind, their digest, and all spans."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select("doc_id", "text"), samples).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("found")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding replaced by ``mark``; n_chars follows a changed text."""
    def marked(text: Column) -> Column:
        return _rebuilt(text, F.col("found"), lambda s, at: F.when(s["start"] >= at, F.lit(mark)).otherwise(F.lit("")))

    hit = F.size("found") > 0
    clean = scan(docs.select(_row(docs).alias("_doc"), "doc_id", "text")).withColumn(
        "text", F.when(hit, let(F.col("text"), marked)).otherwise(F.col("text")))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("_doc.n_chars"))
    return clean.select(*[new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
