"""Operator 11: align the tokens of two tokenizers and count which ids meet.

A text is encoded by a byte-level BPE (A) and a piece BPE (B).  Where a token of
each ends at the same byte, the two sequences are cut into groups; two tokens
whose byte ranges overlap are linked.  Both come from one galloping
intersection of the two sorted lists of ends: every end of the shorter list is
looked up in the longer one, by steps that double from its expected place and
a binary search between the last two.  A hit is a common end; the difference of
the ranks found for a token's two ends is its range of overlapping tokens.

Scale: texts are read and encoded once, in record batches, and never shuffled.  A
document keeps its different id pairs, packed; these are counted over all
documents in a table with as many rows as there are pairs, which says of each
pair whether its count is its B id's highest.  A document's sums come from the
``HEAD`` most frequent pairs, broadcast, and from a join for all others.

Defined cases: a null or empty text, or one whose bytes a tokenizer does not
give back, has no tokens and zeros; special tokens in a text are plain text;
repeated rows each count; ties for the highest count all are highest; a null
doc_id is an ordinary row; an empty table gives no rows; extra columns are
ignored.  One text is aligned in one piece: a task needs memory for some hundred
bytes per token of its longest text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Split pattern of byte-level BPE (a fixed value of the format).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANK = "▁"  # stands for a blank in pieces
HEAD = 1 << 18
LEVELS = 8  # levels of counts per doubling, to find the head
FLUSH = 1 << 21  # bytes of text that are aligned at once
PAIRS = 1 << 21  # pairs a task holds before it counts them


def byte_of_character() -> dict[str, int]:
    """The byte behind each character of byte-level tokens: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """A byte-level BPE file of the tokenizers library: ids of a blank and a text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        of = byte_of_character()
        plain = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.token_bytes = [b""] * (1 + max([*plain.values(), *(t["id"] for t in spec["added_tokens"])]))
        for b, i in plain.items():
            self.token_bytes[i] = b
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        made = [plain[bytes(of[c] for c in m.replace(" ", ""))] for m in merges]
        before = spec["pre_tokenizer"]
        usual = (before["type"], before["add_prefix_space"], before["use_regex"], spec["normalizer"]) == (
            "ByteLevel", False, True, None)
        if usual and made == sorted(made) and not spec["model"]["ignore_merges"]:
            import tiktoken  # the same vocabulary, whose ids ascend with the merges; several times as fast

            self._run = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=plain, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self._run = lambda text: whole.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        return self._run(" " + text)


class PieceEncoder:
    """A BPE file of the sentencepiece library, which itself sets a blank before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._run = run = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [run.id_to_piece(i) for i in range(len(run))]
        self.token_bytes = [bytes([int(p[3:-1], 16)]) if run.is_byte(i) else p.replace(BLANK, " ").encode()
                            for i, p in enumerate(pieces)]

    def __call__(self, text: str) -> list[int]:
        return self._run.encode(text, num_threads=1)


class Pair:
    """Both tokenizers; ids of a text as two arrays, or nothing if its bytes do not come back."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.encoders = ByteEncoder(path_a), PieceEncoder(path_b)
        self.token_bytes = [e.token_bytes for e in self.encoders]
        self.sizes = [np.array([len(t) for t in b], np.int64) for b in self.token_bytes]
        self.n_b = len(self.sizes[1])
        # Ids as text, followed by what can follow: within a side, at a side's or a group's end.
        self.words = [[f"{i}{end}" for i in range(len(b)) for end in ends]
                      for b, ends in zip(self.token_bytes, (",|", ",;"), strict=True)]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B for a blank and the text; None without tokens."""
        if not text:
            return None
        want, out = (" " + text).encode(), []
        for encode, parts in zip(self.encoders, self.token_bytes, strict=True):
            ids = encode(text)
            if b"".join(map(parts.__getitem__, ids)) != want:
                return None
            out.append(np.array(ids, np.int32))
        return tuple(out)


@lru_cache(maxsize=2)
def _pair(path_a: str, path_b: str) -> Pair:
    """Loaded once per Python worker."""
    return Pair(path_a, path_b)


def gallop(keys: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For every key the number of ascending ``values`` up to it, searched from ``start`` on.

    All keys search at once: steps of 1, 2, 4, ... away from the start until the
    key is passed, then a binary search between the last two places.
    """
    n = len(values)
    at = np.clip(start, 0, n - 1)
    up = values[at] <= keys
    low, high = np.where(up, at + 1, 0), np.where(up, n, at)  # the result lies between
    going, step = np.arange(len(keys)), 1
    while len(going):
        g_up = up[going]
        probe = np.where(g_up, low[going] - 1 + step, high[going] - step)
        inside = (probe >= 0) & (probe < n)
        passed = np.where(inside, values[np.clip(probe, 0, n - 1)] <= keys[going], ~g_up)
        # Upwards a value beyond the key ends it, downwards one that is not.
        on = inside & (passed == g_up)
        moved = going[on]
        low[moved] = np.where(g_up[on], probe[on] + 1, low[moved])
        high[moved] = np.where(g_up[on], high[moved], probe[on])
        ended, side = going[~on & inside], g_up[~on & inside]
        low[ended] = np.where(side, low[ended], probe[~on & inside] + 1)
        high[ended] = np.where(side, probe[~on & inside], high[ended])
        going, step = moved, step * 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        below = values[middle] <= keys[going]
        low[going] = np.where(below, middle + 1, low[going])
        high[going] = np.where(below, high[going], middle)
        going = going[low[going] < high[going]]
    return low


class Aligned:
    """Groups and links of some texts; every text has as many bytes in both sequences."""

    def __init__(self, short: list[np.ndarray], long: list[np.ndarray], sizes: tuple[np.ndarray, np.ndarray]) -> None:
        self.n_short = np.array([len(x) for x in short], np.int64)
        self.n_long = np.array([len(x) for x in long], np.int64)
        self.short, self.long = np.concatenate(short).astype(np.int64), np.concatenate(long).astype(np.int64)
        ends, other = np.cumsum(sizes[0][self.short]), np.cumsum(sizes[1][self.long])
        # Texts follow each other, so that the lists of all ascend, and share the texts' ends.
        self.first = np.concatenate([[0], np.cumsum(self.n_short)])
        base_long = np.concatenate([[0], np.cumsum(self.n_long)])
        text = np.repeat(np.arange(len(short)), self.n_short)
        text_ends = ends[self.first[1:] - 1]
        begin = np.concatenate([[0], text_ends[:-1]])
        start = base_long[text] + (ends - begin[text]) * self.n_long[text] // (text_ends - begin)[text] - 1
        self.rank = gallop(ends, other, start)
        self.common = other[self.rank - 1] == ends
        self.common &= self.rank > 0
        before = np.concatenate([[0], self.rank[:-1]])
        self.overlaps = self.rank - self.common - before + 1
        self.before = before

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(short id, long id) of every link, in order of the short tokens."""
        first = np.concatenate([[0], np.cumsum(self.overlaps)[:-1]])
        many = int(self.overlaps.sum())
        place = np.arange(many) - np.repeat(first, self.overlaps) + np.repeat(self.before, self.overlaps)
        return np.repeat(self.short, self.overlaps), self.long[place]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a number of each short token by text."""
        return np.add.reduceat(values, self.first[:-1])

    def group_texts(self, a_is_short: bool, words: list[list[str]]) -> list[str]:
        """``a,a|b;a|b,b`` of each text."""
        hits = np.flatnonzero(self.common)
        ends_short, ends_long = hits, self.rank[hits] - 1  # last token of each group
        a, b = (self.short, self.long) if a_is_short else (self.long, self.short)
        ends_a, ends_b = (ends_short, ends_long) if a_is_short else (ends_long, ends_short)
        code_a, code_b = 2 * a, 2 * b + len(words[0])
        code_a[ends_a] += 1
        code_b[ends_b] += 1
        # A group's A tokens stand behind all B tokens of earlier groups, its B tokens behind its A tokens.
        size_a, size_b = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1)
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.repeat(ends_b - size_b + 1, size_a)] = code_a
        out[np.arange(len(b)) + np.repeat(ends_a + 1, size_b)] = code_b
        all_words, out = words[0] + words[1], out.tolist()
        cuts = np.concatenate([[0], np.cumsum(self.n_short + self.n_long)]).tolist()
        return ["".join(map(all_words.__getitem__, out[x:y]))[:-1] for x, y in pairwise(cuts)]


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches of texts, cut so that a group holds about ``FLUSH`` bytes."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        at, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t or "")
            if held >= FLUSH or i + 1 == len(texts):
                yield batch.slice(at, i + 1 - at), texts[at:i + 1]
                at, held = i + 1, 0


def _aligned(pair: Pair, texts: list[str | None]) -> Iterator[tuple[list[int], bool, Aligned]]:
    """(places of the texts, whether A has the shorter list, their alignment); texts without tokens are left out."""
    found = [(i, *ids) for i, ids in enumerate(map(pair.encode, texts)) if ids]
    for a_is_short in (True, False):
        mine = [f for f in found if (len(f[1]) <= len(f[2])) == a_is_short]
        if mine:
            places, a, b = (list(x) for x in zip(*mine, strict=True))
            sides = (a, b, tuple(pair.sizes)) if a_is_short else (b, a, tuple(pair.sizes[::-1]))
            yield places, a_is_short, Aligned(*sides)


def _pairs_of_texts(pair: Pair, a_is_short: bool, found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its different linked id pairs, ascending, and the number of links of each."""
    x, y = found.links()
    codes = x * pair.n_b + y if a_is_short else y * pair.n_b + x
    n_links = found.per_text(found.overlaps)
    span = np.int64(len(pair.sizes[0])) * pair.n_b
    keys, many = np.unique(np.repeat(np.arange(len(n_links)), n_links) * span + codes, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(len(n_links) + 1) * span)
    codes = keys % span
    for i, j in pairwise(cuts.tolist()):
        yield codes[i:j], many[i:j]


def _packed(codes: np.ndarray, many: np.ndarray) -> bytes:
    """Ascending pairs by their steps, and counts, compressed."""
    both = np.concatenate([np.diff(codes, prepend=0), many]).astype(np.uint32)
    return pa.compress(both.tobytes(), codec="zstd", asbytes=True) + len(both).to_bytes(4, "little")


def _unpacked(packed: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    if not packed:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = int.from_bytes(packed[-4:], "little")
    both = np.frombuffer(pa.decompress(packed[:-4], decompressed_size=4 * size, codec="zstd", asbytes=True), np.uint32)
    steps, many = both[:size // 2].astype(np.int64), both[size // 2:].astype(np.int64)
    return np.cumsum(steps), many


def aligned_rows(docs: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its id pairs (``pairs``, packed).

    A pair is the number A id x B ids + B id.  With ``groups`` the groups are a column more.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
              + (", groups string" if groups else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for part, texts in _groups(batches, 1):
            numbers = np.zeros((4, len(texts)), np.int64)
            digests, pairs, written = [""] * len(texts), [b""] * len(texts), [""] * len(texts)
            for places, a_is_short, found in _aligned(pair, texts):
                sides = (found.n_short, found.n_long) if a_is_short else (found.n_long, found.n_short)
                numbers[:, places] = [*sides, found.per_text(found.common.astype(np.int64)),
                                      found.per_text(found.overlaps)]
                for i, both, text in zip(places, _pairs_of_texts(pair, a_is_short, found),
                                         found.group_texts(a_is_short, pair.words), strict=True):
                    digests[i], pairs[i] = hashlib.sha256(text.encode()).hexdigest(), _packed(*both)
                    written[i] = text if groups else ""
            columns = [part.column(0), *[pa.array(x) for x in numbers], pa.array(digests, pa.string()),
                       pa.array(pairs, pa.binary())]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
            if groups:
                columns, names = [*columns, pa.array(written, pa.string())], [*names, "groups"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): links of each id pair in the packed column ``pairs``; summed in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            codes, many = (np.concatenate(x) for x in zip(*held, strict=True)) if held else _unpacked(None)
            held.clear()
            codes, at = np.unique(codes, return_inverse=True)
            n = np.bincount(at, weights=many, minlength=len(codes)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

        for batch in batches:
            for x in batch.column(0):
                held.append(_unpacked(x.as_py()))
                size += len(held[-1][0])
                if size >= PAIRS:
                    yield counted()
                    size = 0
        yield counted()

    return rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _best_pairs(counts: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): best pairs have their B id's highest count."""
    highest = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("highest"))  # at most one row a B id
    return (counts.join(F.broadcast(highest), F.col("pair") % n_b == F.col("b"))
            .select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))


def _head(pairs: DataFrame, size: int) -> list:
    """The most frequent pairs, at most ``size``, found by levels of their counts."""
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    held, least = 0, None
    for r in sorted(pairs.groupBy(level.alias("level")).count().collect(), reverse=True):  # some hundred levels
        held += r["count"]
        if held > size:
            break
        least = r["level"]
    return [] if least is None else pairs.where(level >= least).collect()


def align(docs: DataFrame, path_a: str, path_b: str, head: int = HEAD, groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    With ``groups`` the groups themselves are a column more (``a,a|b;a|b,b``).
    """
    rows = materialize(aligned_rows(docs, path_a, path_b, groups).withColumn("_row", F.monotonically_increasing_id()))
    pairs = materialize(_best_pairs(materialize(pair_counts(rows)), _pair(path_a, path_b).n_b))
    top = sorted((r["pair"], r["n"], r["best"]) for r in _head(pairs, head))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(np.array([t[i] for t in top], np.int64) for i in range(3)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = sent.value
        for batch in batches:
            sums, bests, rest, many_rest = [], [], [], []
            for x in batch.column(1):
                mine, many = _unpacked(x.as_py())
                at = np.minimum(np.searchsorted(codes, mine), max(len(codes) - 1, 0))
                hit = codes[at] == mine if len(codes) else np.zeros(len(mine), bool)
                at, n = at[hit], many[hit]
                sums.append(int((counts[at] * n).sum()))
                bests.append(int((best[at] * n).sum()))
                rest.append(mine[~hit])
                many_rest.append(many[~hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.int64()), pa.array(bests, pa.int64()),
                 pa.array(rest, pa.list_(pa.int64())), pa.array(many_rest, pa.list_(pa.int64()))],
                ["_row", "_sum", "_best", "rest", "many"])

    summed = materialize(rows.select("_row", "pairs").mapInArrow(
        run, "_row long, _sum long, _best long, rest array<long>, many array<long>"))
    # Pairs outside the head: joined to the table of pairs.
    others = (summed.select("_row", F.explode(F.arrays_zip("rest", "many")).alias("r"))
              .select("_row", F.col("r.rest").alias("pair"), F.col("r.many").alias("many")).join(pairs, "pair")
              .select("_row", (F.col("many") * F.col("n")).alias("_sum"),
                      F.when(F.col("best"), F.col("many")).otherwise(0).alias("_best")))
    per_row = (summed.select("_row", "_sum", "_best").union(others).groupBy("_row")
               .agg(F.sum("_best").alias("n_best"), F.sum("_sum").alias("count_sum")))
    return rows.join(per_row, "_row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                             "groups_sha256", *(["groups"] if groups else []))
