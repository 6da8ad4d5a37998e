"""Operator 12: join documents whose sets of word n-grams have a high Jaccard similarity.

A document's set holds the 64-bit hashes of its distinct word shingles.  Two sets
can only be similar if they share one of their first shingles in any common
order (prefix filter), so these are the places where sets meet:

* a tile holds the sets that share such a shingle and whose sizes lie in two
  neighbouring bands, as similar sets have similar sizes; shingles that exactly
  the same sets share make one tile;
* within a tile, hashed bitmaps are compared: every bit that one set has and the
  other lacks stands for a shingle they do not share, so bit counts bound the
  overlap from above;
* pairs that may still be similar are decided by intersecting the sorted arrays.

The common order puts shingles of crowded counting buckets last, then goes by
hash: passages that many documents share do not make large tiles.

Scale: equal sets are one set from the start.  Before the tiles, sets that share
a least hash are compared to one pivot each, and the links found are contracted;
tiles then compare only sets of different classes, so a group of near copies,
however large, is never compared pair by pair.  A first round tries few pairs of
every two classes that meet, a last one all that are left: no link between
different classes is lost.  A tile of more than ``FULL`` sets is cut into blocks:
those of its largest class meet only the others.  Arrays are made again from the
texts, only of sets in a pair to decide.  The driver holds the counting buckets
(a fixed number), and nothing of the documents.

Defined cases: a null, empty or blank text has the empty set and is linked with
nothing, its component is its own id; a text of fewer words than a shingle is
one shingle; a very long text is hashed in slices, its set must fit a task; rows
with a null id take part, their id names a component only if all ids of it are
null; repeated rows stay rows of one component; an empty table gives no rows;
extra columns are ignored.  Different shingles are told apart by 64 bits, sets
by 128.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import fits_broadcast
from .common import materialize
from .graph import components

SHINGLE = 5
PERCENT = 80
SKETCH = 1 << 20  # counting buckets of shingles
BLOCK = 1 << 16  # buckets per record of counts
SALTS = 8
PIVOTS = 3
FULL = 2048  # sets of a tile that one task compares
FEW = 8  # pairs of two classes that are tried in the first round
BITS = (128, 8192)  # least and most bits of a bitmap
SLICE = 1 << 20
KNOWN = 250_000  # words whose hashes a worker remembers
BUFFER = 16_384  # rows of tiles compared at once
_ODD = 0x9E3779B97F4A7C15
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


class _Hashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a UTF-8 text."""
    clean, at, parts = (text or b"").translate(_FOLD), 0, []
    while at < len(clean):
        end = clean.find(b" ", at + SLICE)
        end = len(clean) if end < 0 else end
        found = clean[at:end].split()
        parts.append(np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found)))
        at = end
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    if not len(words):
        return words
    factors = np.array([pow(_ODD, k + 1, 1 << 64) for k in range(shingle)], np.uint64)
    if len(words) < shingle:
        return _mixed((words * factors[:len(words)]).sum(keepdims=True) + np.uint64(len(words)))
    many = len(words) - shingle + 1
    sums = np.zeros(many, np.uint64)
    for k, f in enumerate(factors):
        sums += words[k:k + many] * f
    return np.unique(_mixed(sums))


def _binary(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(column).cast(pa.binary()))


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype(np.int64).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, decompressed_size=8 * BLOCK, codec="zstd", asbytes=True), np.int64)


def _summed(counts: DataFrame, *keys: str) -> DataFrame:
    """Sum the arrays of equal keys, streaming."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["block"], row["salt"])
                some = _unpacked(row["counts"])
                sums[key] = sums[key] + some if key in sums else some
        for (block, salt), some in sums.items():
            yield pa.RecordBatch.from_pylist([{"block": block, "salt": salt, "counts": _packed(some)}],
                                             schema=pa.schema([("block", pa.int32()), ("salt", pa.int32()),
                                                               ("counts", pa.binary())]))
    return counts.repartition(*keys).mapInArrow(run, counts.schema)


def crowding(docs: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """How far each counting bucket's documents exceed the mean, in doublings (0: not at all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, held, size = np.zeros(SKETCH, np.int64), [], 0
        for batch in batches:
            for text in _binary(batch, 0):
                held.append((shingle_set(text, shingle) % np.uint64(SKETCH)).astype(np.int64))
                size += len(held[-1])
                if size >= SKETCH:
                    counts += np.bincount(np.concatenate(held), minlength=SKETCH)
                    held, size = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=SKETCH)
        salt = TaskContext.get().partitionId() % SALTS
        for block in range(SKETCH // BLOCK):
            part = counts[block * BLOCK:(block + 1) * BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()),
                                                  pa.array([_packed(part)], pa.binary())], ["block", "salt", "counts"])

    each = docs.select("text").mapInArrow(run, "block int, salt int, counts binary")
    whole = _summed(_summed(each, "block", "salt").withColumn("salt", F.lit(0)), "block")
    counts = np.zeros(SKETCH, np.int64)
    for r in whole.toLocalIterator():  # a fixed number of buckets
        counts[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = _unpacked(r["counts"])
    usual = max(1.0, counts.mean())
    return np.floor(np.log2(np.maximum(counts / usual, 1))).astype(np.uint8)


class Rule:
    """Sizes and overlaps that a similarity of ``percent`` or more asks for."""

    def __init__(self, percent: int = PERCENT) -> None:
        self.percent = percent
        self.base = math.log(100 / percent * 1.008)  # a margin above the ratio of similar sets' sizes

    def overlap(self, x, y):
        """Least shared shingles of sets of these sizes."""
        return -(-self.percent * (x + y) // (100 + self.percent))

    def prefix(self, n: int) -> int:
        """Shingles of which a set shares one with every similar set."""
        return n + (-self.percent * n // 100) + 1

    def short_prefix(self, n: Column) -> Column:
        """The same towards sets of its size or larger."""
        return n - F.ceil(F.lit(2 * self.percent) * n / F.lit(100 + self.percent)) + 1

    def band(self, n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / F.lit(self.base)).cast("int")

    def width(self, band: int) -> int:
        """Bits of the bitmaps of a tile: two to four times as many as its larger sets have shingles."""
        least, most = BITS
        return min(most, max(least, 2 << math.ceil(self.base * (band + 1) / math.log(2))))


def _bitmap(found: np.ndarray, width: int) -> bytes:
    flags = np.zeros(width, bool)
    flags[((found >> np.uint64(30)) % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def sets(docs: DataFrame, crowded: np.ndarray, rule: Rule, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, text_key, n, set_id, keys (prefix), plain (keys of no crowded bucket, the first), pivots, bits."""
    sent = docs.sparkSession.sparkContext.broadcast(crowded)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    factors = [np.uint64(pow(_ODD, 2 * k, 1 << 64)) for k in range(PIVOTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowd = sent.value
        for batch in batches:
            n, ids, keys, plain, pivots, bits = [], [], [], [], [], []
            for text in _binary(batch, 2):
                found = shingle_set(text, shingle)
                n.append(len(found))
                if not len(found):
                    for column, nothing in ((ids, b""), (keys, []), (plain, 0), (pivots, []), (bits, b"")):
                        column.append(nothing)
                    continue
                ids.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                level = crowd[(found % np.uint64(SKETCH)).astype(np.int64)]
                first = found[np.argsort(level, kind="stable")] if level.any() else found
                keys.append(first[:rule.prefix(len(found))].view(np.int64))
                plain.append(min(len(keys[-1]), int((level == 0).sum())))
                pivots.append(np.array([(found * f).min() for f in factors], np.uint64).view(np.int64))
                # Kept for the higher of the two bands a set is compared in.
                bits.append(_bitmap(found, rule.width(math.floor(math.log(len(found)) / rule.base + 1e-9) + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(plain, pa.int32()),
                 pa.array(pivots, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["doc_id", "text_key", "n", "set_id", "keys", "plain", "pivots", "bits"])

    return _keyed(docs).mapInArrow(
        run, f"doc_id {id_type}, text_key long, n long, set_id binary, keys array<long>, plain int, pivots array<long>, "
             "bits binary")


class Texts:
    """The documents' texts, read again for the sets that are intersected."""

    def __init__(self, docs: DataFrame, unique: DataFrame, repeated: bool, shingle: int) -> None:
        self.docs, self.shingle, self.repeated = _keyed(docs), shingle, repeated
        self.places = unique.select("id", F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))

    def arrays(self, wanted: DataFrame, *more: str) -> DataFrame:
        """(id, more..., found): the sorted hashes of the set of every row of ``wanted`` (id, more...), as binary."""
        names, shingle = ["id", *more], self.shingle
        placed = materialize(wanted.join(self.places, "id"))
        side = F.broadcast(placed) if fits_broadcast(placed) else placed
        texts = self.docs.join(side, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
        texts = texts.select(*names, "text")
        if self.repeated:  # several rows of one id and text
            texts = texts.groupBy(*names).agg(F.first("text").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingle_set(t, shingle).tobytes() for t in _binary(batch, len(names))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary())], [*names, "found"])

        return texts.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", found binary")


def _verified(pairs: DataFrame, texts: Texts, rule: Rule) -> DataFrame:
    """The pairs (u, v) whose sets are similar: exact intersections of sorted arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(shared >= rule.overlap(len(x), len(y)))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    pairs = materialize(pairs)
    left = texts.arrays(pairs.toDF("id", "v"), "v").toDF("u", "v", "found_u")
    right = texts.arrays(pairs.select(F.col("v").alias("id")).distinct()).toDF("v", "found_v")
    return left.join(right, "v").select("u", "v", "found_u", "found_v").mapInArrow(run, "u long, v long")


def _pivot_pairs(unique: DataFrame) -> DataFrame:
    """(u, v): every set with the first of those that share one of its least hashes."""
    each = unique.select("id", F.posexplode("pivots").alias("kind", "least"))
    first = materialize(each.groupBy("kind", "least").agg(F.min("id").alias("v"), F.count("*").alias("n"))
                        .where("n > 1").select("kind", "least", "v"))
    return each.join(first, ["kind", "least"]).where("id <> v").select(F.col("id").alias("u"), "v").distinct()


def _folded(bits: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of at least this width, as rows of 64-bit numbers."""
    rows = np.zeros((len(bits), width // 64), np.uint64)
    sizes = np.array([len(b) for b in bits]) * 8
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        wide = np.frombuffer(b"".join([bits[i] for i in at]), np.uint64).reshape(len(at), size // width, width // 64)
        rows[at] = np.bitwise_or.reduce(wide, axis=1)
    return rows


def _compared(rows: dict[str, np.ndarray], rule: Rule, few: int | None) -> dict[str, np.ndarray]:
    """Pairs of different classes that may be similar, in whole tiles ordered by size within.

    u, v, their classes low and high, and spare, by how much the bound exceeds
    the overlap asked for.  With ``few`` only so many of two classes of a tile;
    ``cut`` has the keys of tiles that have more.
    """
    group, band, n, label, ids = (rows[c] for c in ("group", "t", "n", "label", "id"))
    out = []
    for t in np.unique(band):
        first, last = np.searchsorted(band, [t, t + 1])
        maps = _folded(rows["bits"][first:last].tolist(), rule.width(int(t)))
        going, shift = np.arange(first, last - 1), 1
        while len(going):
            going = going[going + shift < last]
            j = going + shift
            near = (group[going] == group[j]) & (100 * n[going] >= rule.percent * n[j])  # sizes ascend: no later one either
            going, j = going[near], j[near]
            # Sets of the lower band have met in its own tiles; the shingle is in the smaller set's short prefix.
            pick = (label[going] != label[j]) & rows["short"][going] & (rows["own"][j] == t)
            x, y = going[pick], j[pick]
            a, b = maps[x - first], maps[y - first]
            bound = np.minimum(n[x] - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64),
                               n[y] - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
            spare = bound - rule.overlap(n[x], n[y])
            may = spare >= 0
            out.append(np.stack([x[may], y[may], spare[may]]))
            shift += 1
    x, y, spare = np.concatenate(out, axis=1) if out else np.empty((3, 0), np.int64)
    low, high, cut = np.minimum(label[x], label[y]), np.maximum(label[x], label[y]), np.empty(0, np.int64)
    if few is not None and len(x):  # the most promising pairs of every two classes of a tile
        order = np.lexsort((-spare, high, low, group[x]))
        same = np.ones(len(x), bool)
        for c in (group[x][order], low[order], high[order]):
            same[1:] &= c[1:] == c[:-1]
        same[0] = False
        starts = np.flatnonzero(~same)
        place = np.arange(len(x)) - np.repeat(starts, np.diff(np.append(starts, len(x))))
        cut = np.unique(rows["key"][x[order[place >= few]]])
        keep = order[place < few]
        x, y, spare, low, high = x[keep], y[keep], spare[keep], low[keep], high[keep]
    return {"u": ids[x], "v": ids[y], "low": low, "high": high, "spare": spare, "cut": cut}


def _small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if its bytes are few."""
    return F.broadcast(table) if fits_broadcast(table) else table


def _meetings(unique: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """(key, id, n, short): the prefix shingles that sets of different classes share.

    Sets meet in one exchange by shingle.  Shingles of crowded buckets, which may
    be those of a large part of all sets, are counted first and then joined.
    All shingles that the same sets share are one key, made of these sets' ids
    (if other sets had the same key, they would only meet more), ``short`` where
    one of them is.
    """
    who = F.bit_xor(F.xxhash64("id"))
    short = F.col("place") < rule.short_prefix(F.col("n"))
    each = (unique.join(_small(labels), "id", "left")
            .select("id", "n", "plain", F.coalesce("label", "id").alias("label"),
                    F.posexplode("keys").alias("place", "key"))
            .select("key", "id", "n", short.alias("short"), "label", (F.col("place") < F.col("plain")).alias("_plain")))
    together = Window.partitionBy("key")
    # Dealt before the hash is added, which would else go through the exchange of the window.
    plain = (each.where("_plain").select("key", "id", "n", "short", "label").repartition("key").withColumn("_hash", F.xxhash64("id"))
             .withColumns({"_low": F.min("label").over(together), "_high": F.max("label").over(together),
                           "_who": F.bit_xor("_hash").over(together)})
             .where("_low < _high").select("_who", "id", "n", "short"))
    crowded = each.where("not _plain")
    several = materialize(crowded.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high"),
                                                     who.alias("_who"))
                          .where("_low < _high").select("key", "_who"))
    met = plain.union(crowded.join(several, "key").select("_who", "id", "n", "short"))
    return met.groupBy(F.col("_who").alias("key"), "id", "n").agg(F.max("short").alias("short"))


def _candidates(meets: DataFrame, attributes: DataFrame, labels: DataFrame, rule: Rule, few: int | None) -> DataFrame:
    """(u, v, low, high, spare) of sets of different classes that may be similar, from all tiles.

    With ``few`` only so many of two classes of a tile; rows that have just ``cut``
    name the shingles whose tiles have more.  ``meets`` (key, id, n, short) has the prefixes, ``labels`` (id, label) the
    classes of sets that are linked already.
    """
    own = rule.band(F.col("n"))
    # In the tiles of the next band a set is the smaller one, whose shingle must be in its short prefix.
    bands = F.when(F.col("short"), F.array(own, own + 1)).otherwise(F.array(own))
    laid = (meets.join(_small(labels), "id", "left").withColumn("label", F.coalesce("label", "id"))
            .select("key", "id", "n", "short", "label", own.alias("own"), F.explode(bands).alias("t")))
    # Tiles with sets of different classes: their size, their largest class and its size.
    # A pair has a set with the shingle in its short prefix and one of the tile's own band.
    sizes = (laid.groupBy("key", "t", "label")
             .agg(F.count("*").alias("c"), F.max("short").alias("s"), F.max(F.col("own") == F.col("t")).alias("o"))
             .groupBy("key", "t")
             .agg(F.sum("c").alias("all"), F.max(F.struct("c", "label")).alias("main"), F.count("*").alias("classes"),
                  F.max("s").alias("s"), F.max("o").alias("o"))
             .where("classes > 1 and s and o"))
    blocks = F.when(F.col("all") <= FULL, F.struct(F.lit(0).alias("main"), F.lit(1).alias("rest"))).otherwise(
        F.struct(F.ceil(F.col("main.c") / FULL).cast("int").alias("main"),
                 F.ceil((F.col("all") - F.col("main.c")) / FULL).cast("int").alias("rest")))
    sizes = materialize(sizes.select("key", "t", F.col("main.label").alias("main"), blocks.alias("cut")))
    m, r = F.col("cut.main"), F.col("cut.rest")
    hashed = F.xxhash64("id")
    in_main = F.pmod(hashed, F.greatest(m, F.lit(1)).cast("long")).cast("int")
    in_rest = F.pmod(hashed, r.cast("long")).cast("int")
    rest_blocks = F.sequence(F.lit(0), r - 1)

    def tile(p: Column, q: Column) -> Column:
        return p * (m + r) + q
    # Block p of the rest meets every block of the main class, and the blocks of the rest from p on.
    tiles = F.when(m == 0, F.array(F.lit(0))).when(
        F.col("label") == F.col("main"), F.transform(rest_blocks, lambda p: tile(p, in_main))).otherwise(
        F.concat(F.transform(F.sequence(F.lit(0), F.greatest(m, F.lit(1)) - 1), lambda q: tile(in_rest, q)),
                 F.transform(rest_blocks, lambda p: tile(F.least(p, in_rest), m + F.greatest(p, in_rest)))))
    placed = (laid.join(sizes, ["key", "t"])
              .select("t", "key", F.explode(tiles).alias("tile"), "id", "n", "short", "label", "own")
              .join(attributes, "id")
              .select("t", "key", "tile", "id", "n", "short", "label", "own", "bits")
              .repartition("t", "key", "tile").sortWithinPartitions("t", "key", "tile", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(last: bool) -> Iterator[pa.RecordBatch]:
            """Compare the tiles held whole; keep the rows of the last one, which may go on."""
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            rows = {c: table.column(c).to_numpy() for c in table.column_names}
            new = np.zeros(table.num_rows, bool)
            for c in ("t", "key", "tile"):
                new[1:] |= rows[c][1:] != rows[c][:-1]
            whole = table.num_rows if last else int(np.max(np.flatnonzero(new), initial=0))
            if whole < table.num_rows:
                held.extend(table.slice(whole).to_batches())
            rows = {c: x[:whole] for c, x in rows.items()} | {"group": np.cumsum(new[:whole])}
            out = _compared(rows, rule, few)
            pairs, cut = len(out["u"]), out.pop("cut")
            columns = [pa.array(x, pa.int64()) for x in out.values()]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(pairs, pa.int64())], [*out, "cut"])
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(cut), pa.int64())] * len(out), pa.array(cut, pa.int64())],
                                             [*out, "cut"])

        for batch in batches:
            for at in range(0, batch.num_rows, BUFFER):
                held.append(batch.slice(at, BUFFER))
                if sum(b.num_rows for b in held) >= BUFFER:
                    yield from compared(False)
        if held:
            yield from compared(True)

    return placed.mapInArrow(run, "u long, v long, low long, high long, spare long, cut long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    rule = Rule(percent)
    rows = materialize(sets(docs, crowding(docs, shingle), rule, shingle)
                       .withColumn("_row", F.monotonically_increasing_id()))
    named = materialize(rows.where("n > 0").groupBy("set_id").agg(F.min("_row").alias("id"), F.min("doc_id").alias("low")))
    ids = named.select(F.col("id").alias("_row"))
    small = fits_broadcast(ids)
    unique = rows.join(F.broadcast(ids) if small else ids, "_row", "left_semi").withColumnRenamed("_row", "id")
    unique = unique if small else materialize(unique)  # a filter of what is stored already, or an exchange
    repeated = not rows.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty()
    texts = Texts(docs, unique, repeated, shingle)

    links = materialize(_verified(_pivot_pairs(unique), texts, rule))
    classes = materialize(components(links)).toDF("id", "label")
    meets = materialize(_meetings(unique, classes, rule))
    bits = unique.select("id", "bits")

    def linked_with(more: DataFrame) -> tuple[DataFrame, DataFrame]:
        # Classes stand for the links they were made of.
        now = materialize(classes.where("id <> label").toDF("u", "v").union(_verified(more, texts, rule)))
        return now, materialize(components(now)).toDF("id", "label")

    # First the most promising pairs of every two classes that meet, ...
    found = materialize(_candidates(meets, bits, classes, rule, FEW))
    pairs = found.where("u is not null").groupBy("u", "v", "low", "high").agg(F.max("spare").alias("spare"))
    best = Window.partitionBy("low", "high").orderBy(F.desc("spare"), "u", "v")
    pairs = materialize(pairs.withColumn("turn", F.row_number().over(best)))
    links, classes = linked_with(pairs.where(F.col("turn") <= FEW).select("u", "v"))
    # ... then all others, of classes that are still apart.
    rest = pairs.where(F.col("turn") > FEW).select("u", "v")
    cut = materialize(found.where("cut is not null").select(F.col("cut").alias("key")).distinct())
    if not cut.isEmpty():
        again = _candidates(meets.join(cut, "key", "left_semi"), bits, classes, rule, None).select("u", "v").distinct()
        rest = rest.union(again.join(pairs.where(F.col("turn") <= FEW).select("u", "v"), ["u", "v"], "left_anti"))
    apart = (rest.distinct().join(classes.toDF("u", "class_u"), "u", "left").join(classes.toDF("v", "class_v"), "v", "left")
             .where(F.coalesce("class_u", "u") != F.coalesce("class_v", "v")).select("u", "v"))
    apart = materialize(apart)
    if not apart.isEmpty():
        links, classes = linked_with(apart)
    together = (named.join(classes, "id", "left")
                .select("set_id", F.coalesce("label", "id").alias("root"), "low"))
    together = materialize(together)
    lowest = materialize(together.groupBy("root").agg(F.min("low").alias("component_id")))
    names = materialize(together.join(lowest, "root").select("set_id", "component_id"))
    linked = rows.where("n > 0").join(names, "set_id").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(rows.where("n = 0").select("doc_id", "n", "doc_id"))
