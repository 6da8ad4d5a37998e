"""Operator 8: chat formatting with a prefix tree.

Conversations that begin with the same turns share tree nodes.  Every node is
one turn, formatted by a template that escapes control strings inside texts; its
tokens (code points of the formatted text) are emitted once, depth-first.  Each
node carries its position ids (tokens before it in its conversation) and the
attention intervals of its ancestors in the packed sequence.

Runs of nodes without a branch are chains.  A chain is contiguous in depth-first
order, so a node attends to one interval per chain above it, and the sort key is
the list of chain heads rather than of all ancestors.

Scale: conversations are read by streaming sweeps over rows sorted by
(conversation, turn); a sweep holds one turn and a digest, not a conversation.
A first turn that a third of all conversations share is merged before the
shuffle of nodes.  Offsets are running sums over range partitions.  Reading back
joins each conversation's intervals with the segments of the chains that begin
there; a hot chain is a hot key that the planner may split.  One conversation's turns are read in order by one
task, in constant memory.

Defined cases: null text and role are empty; rows with a null conv_id are one
conversation; turns with equal number are ordered by role and text, null first;
repeated rows are turns of their own; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import global_sum, materialize, text_of

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that a model may read as control: never emitted from a text (fixed values).
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>")
LEARNED_ROLE = "assistant"
#: Conversation -1 of the query (fixed by the contract).
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def escape(text: Column) -> Column:
    """Backslashes doubled, and one set into each control string after its first character."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = segment[len(TURN):-len(END)].split(TEXT)
    return unescape(role), unescape(text)


def _by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node ids (digest of all turns so far), parents, depths and positions."""
    begun, conv, digest, depth, at = False, None, b"", 0, 0
    for batch in batches:
        out = ([], [], [], [])
        for c, segment in zip(batch.column("conv_id").to_pylist(), batch.column("segment").to_pylist(), strict=True):
            if not begun or c != conv:
                begun, conv, digest, depth, at = True, c, b"", 0, 0
            parent, digest = digest, hashlib.sha256(digest + segment.encode()).digest()[:16]
            for column, value in zip(out, (digest, parent, depth, at), strict=True):
                column.append(value)
            depth += 1
            at += len(segment)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("role"), batch.column("segment"),
             pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.int64())],
            ["conv_id", "role", "segment", "node", "parent", "depth", "position"])


def _pathed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chain heads from the root to each node, joined."""
    begun, conv, path = False, None, ""
    for batch in batches:
        convs = batch.column("conv_id").to_pylist()
        paths = []
        for c, node, head in zip(convs, batch.column("node").to_pylist(), batch.column("head").to_pylist(),
                                 strict=True):
            if not begun or c != conv:
                begun, conv, path = True, c, ""
            if head:
                path = f"{path}/{node.hex()}" if path else node.hex()
            paths.append(path)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("node"), batch.column("depth"),
                                          pa.array(paths, pa.string())], ["conv_id", "node", "depth", "path"])


def pack(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(packed, index).

    packed: one row per tree node, in depth-first order of ``start`` -- start, end
    (token interval), position (of its first token in its conversation), role,
    segment, learned (tokens under the loss mask: start and end within the
    segment), path (chain), attends (ancestor intervals, its own chain up to
    itself last).  index: conv_id and ``last``, the end of its last node.
    """
    role, text = text_of("role"), text_of("text")
    segment = F.concat(F.lit(TURN), escape(F.col("_role")), F.lit(TEXT), escape(F.col("_text")), F.lit(END))
    rows = conversations.select("conv_id", "turn", role.alias("_role"), text.alias("_text")).select(
        "conv_id", "turn", F.col("_role").alias("role"), F.col("_text").alias("text"), segment.alias("segment"))
    id_field = rows.schema["conv_id"]
    chained = materialize(_by_conversation(rows, "turn", "role", "text").mapInArrow(_chained, T.StructType([
        id_field, T.StructField("role", T.StringType()), T.StructField("segment", T.StringType()),
        T.StructField("node", T.BinaryType()), T.StructField("parent", T.BinaryType()),
        T.StructField("depth", T.LongType()), T.StructField("position", T.LongType())])))
    nodes = chained.groupBy("node").agg(*[F.first(c).alias(c) for c in
                                          ("role", "segment", "parent", "depth", "position")])
    # Where conversations end inside a chain it goes on: only branching parts chains.
    edges = chained.select("node", "parent", "depth").distinct()
    inner = edges.where("depth > 0")
    branches = inner.groupBy("parent").count().where("count > 1").select("parent", F.lit(True).alias("branch"))
    heads = (inner.join(branches, "parent", "left").select("node", F.coalesce("branch", F.lit(False)).alias("head"))
             .unionAll(edges.where("depth = 0").select("node", F.lit(True).alias("head"))))
    member = chained.select("conv_id", "node", "depth").join(heads, "node")
    pathed = materialize(_by_conversation(member, "depth").mapInArrow(_pathed, T.StructType([
        id_field, T.StructField("node", T.BinaryType()), T.StructField("depth", T.LongType()),
        T.StructField("path", T.StringType())])))
    paths = pathed.groupBy("node").agg(F.first("path").alias("path"))
    ordered = global_sum(nodes.join(paths, "node"), F.length("segment").cast("long"),
                         F.col("path"), F.col("depth"), name="end")
    placed = materialize(ordered.withColumn("start", F.col("end") - F.length("segment")))
    chains = placed.groupBy("path").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    above = _prefixes(chains.select("path"), "path")
    spans = above.join(chains.withColumnRenamed("path", "chain"), "chain").groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    mask = F.when(F.col("role") == LEARNED_ROLE, F.struct(
        F.lit(len(TURN + LEARNED_ROLE + TEXT)).alias("start"),
        (F.length("segment") - len(END)).alias("end")))
    own = F.struct(F.element_at("spans", -1)["start"].alias("start"), F.col("end").alias("end"))
    packed = placed.join(spans, "path").select(
        "start", "end", "position", "role", "segment", mask.alias("learned"), "path",
        F.concat(F.slice("spans", 1, F.size("spans") - 1), F.array(own)).alias("attends"))
    last = pathed.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    index = last.join(placed.select("node", "end"), "node").select("conv_id", F.col("end").alias("last"))
    return packed, index


def _prefixes(df: DataFrame, path: str) -> DataFrame:
    """``df`` with a row for each chain on the path, as ``chain``."""
    heads = F.split(path, "/")
    return df.withColumn("chain", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(heads)), lambda n: F.array_join(F.slice(heads, 1, n), "/"))))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest columns of each conversation from its segments in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    state, done = None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def close() -> None:
        if state:
            conv, n, turns, lost, loss, size = state
            done.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), size))

    for batch in batches:
        for row in batch.to_pylist():
            if state is None or row["conv_id"] != state[0]:
                close()
                state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            if row["position"] != state[5]:
                raise ValueError(f"conversation {row['conv_id']}: position {row['position']} follows {state[5]} tokens")
            role, text = parse(row["segment"])
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            if row["learned"] is not None:
                learned = unescape(row["segment"][row["learned"]["start"]:row["learned"]["end"]])
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(row["segment"])
        if done:
            yield batch_of(done)
            done.clear()
    close()
    if done:
        yield batch_of(done)


def read_back(packed: DataFrame, index: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from the packed output.

    A conversation is what its last node attends to: the segments that lie in its
    intervals, each of which begins where a chain does.  Their position ids must
    follow each other without a gap.
    """
    ends = index.join(packed.select(F.col("end").alias("last"), "attends"), "last")
    wanted = ends.select("conv_id", F.inline("attends")).toDF("conv_id", "chain", "upto")
    segments = packed.select(F.element_at("attends", -1)["start"].alias("chain"), "end", "position", "segment", "learned")
    rows = wanted.join(segments, "chain").where("end <= upto").select("conv_id", "position", "segment", "learned")
    return _by_conversation(rows, "position").mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long")


def with_extra(conversations: DataFrame) -> DataFrame:
    """The conversations and the contract's conversation -1."""
    extra = conversations.sparkSession.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
