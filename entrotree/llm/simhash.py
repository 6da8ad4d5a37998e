"""Operator 4: near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint is cut into ``BLOCKS`` pieces.  Two fingerprints that differ in
at most d bits differ in at most d pieces, so they agree on some choice of
``BLOCKS - d`` pieces: each such choice is a block key.  Distinct fingerprints
are joined on block keys and verified by Hamming distance; links are contracted
to components.

Scale: texts are read once, in record batches, and never shuffled.  Equal
texts collapse into one fingerprint before any join, so thousands of copies
cost one row.  With six pieces and three bits a key fixes about 32 bits.  A
block of more than ``FULL_BLOCK`` fingerprints is cut again: the free bits are
split into eight pieces, of which close pairs agree on five, which leaves 12 or
13 free bits; such a block has by construction at most a few thousand distinct
fingerprints, whatever the input.  No pair within the distance is lost.

Defined cases: a null or blank text has fingerprint zero and is linked like
any other; rows with a null id take part, their id never names a component
unless all ids of it are null; repeated rows stay separate rows of one
component; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize
from .graph import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 6
FULL_BLOCK = 512
SUB_BLOCKS = 8

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1,
                           bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number."""
    found = (text or b"").lower().split()  # A-Z only; the six ASCII blanks
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    hash64 = xxhash.xxh64_intdigest
    if len(found) < shingle:
        hashes = [hash64(joined, SEED)]
    else:
        hashes = [hash64(joined[a:b - 1], SEED)
                  for a, b in zip([0, *ends], ends[shingle - 1:], strict=False)]
    octets = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_of(text: str | Column = "text", shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column, computed in Arrow batches."""
    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return run(F.encode(text, "UTF-8"))


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _pieces(bits: list[int], n: int) -> list[list[int]]:
    return [[int(b) for b in part] for part in np.array_split(bits, n)]


def block_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[list[int]]:
    """Bit positions of each block key: all choices of ``blocks - max_bits`` pieces."""
    return [sum(c, []) for c in combinations(_pieces(list(range(64)), blocks), blocks - max_bits)]


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks)])
    return fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.kind", "k.key")


def _pairs(keyed: DataFrame, max_bits: int, *keys: str) -> DataFrame:
    a, b = keyed.alias("a"), keyed.withColumnRenamed("fp", "fp2").alias("b")
    close = (F.col("fp") < F.col("fp2")) & (
        F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits)
    return a.join(b, list(keys)).where(close).select(F.col("fp").alias("v"), F.col("fp2").alias("u"))


def close_pairs(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                full_block: int = FULL_BLOCK) -> DataFrame:
    """(u, v): all pairs of distinct fingerprints (column fp) within ``max_bits``; may repeat."""
    masks = block_masks(max_bits, blocks)
    keyed = _keyed(fps, [_signed(m) for m in masks])
    sizes = keyed.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(keyed.join(sizes, ["kind", "key"]))
    found = _pairs(shared.where(F.col("n") <= full_block).select("fp", "kind", "key"),
                   max_bits, "kind", "key")
    finer = []
    for kind, mask in enumerate(masks):
        free = _pieces(sorted(set(range(64)) - set(mask)), SUB_BLOCKS)
        for sub, c in enumerate(combinations(free, SUB_BLOCKS - max_bits)):
            finer.append((kind, sub, _signed(mask + sum(c, []))))
    per_kind = {k: F.array(*[F.struct(F.lit(s).alias("sub"), F.lit(m).alias("mask"))
                             for kk, s, m in finer if kk == k]) for k in range(len(masks))}
    full = shared.where(F.col("n") > full_block)
    if not full.isEmpty():
        choice = F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in per_kind.items()])
        cut = (full.select("fp", "kind", F.explode(choice).alias("s"))
               .select("fp", "kind", "s.sub", F.col("fp").bitwiseAND(F.col("s.mask")).alias("key")))
        found = found.union(_pairs(cut, max_bits, "kind", "sub", "key"))
    return found


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) per row, and (fp, root, component_id) per distinct fingerprint."""
    marked = materialize(docs.select("doc_id", fingerprint_of("text", shingle).alias("fp")))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(close_pairs(distinct.select("fp"), max_bits))
    named = (distinct.join(linked, distinct.fp == linked.node, "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked, materialize(named.join(lowest, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    marked, component = _grouped(docs, shingle, max_bits)
    return marked.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Ids that are null or stand on several rows do not tell rows apart; such
    rows are told apart by fingerprint, and of those in one component the first
    by text hash stays.
    """
    marked, component = _grouped(docs, shingle, max_bits)
    heads = marked.join(component, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    many = materialize(marked.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"))
    if many.isEmpty():
        return docs.join(heads.select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    kept = docs.join(heads.select("doc_id").distinct().join(many, "doc_id", "left_anti"),
                     "doc_id", "left_semi").select(docs.columns)
    unclear = docs.where("doc_id is null").unionByName(docs.join(many, "doc_id", "left_semi").select(docs.columns))
    first = F.row_number().over(Window.partitionBy("_root").orderBy(F.xxhash64("text"), "text"))
    also = (unclear.withColumn("_fp", fingerprint_of("text", shingle))
            .join(component.toDF("_fp", "_root", "_low"), "_fp")
            .where(F.col("doc_id").eqNullSafe(F.col("_low")))
            .withColumn("_row", first).where("_row = 1").select(docs.columns))
    return kept.unionByName(also)
