"""Scoring with a tree table (T8, T9), leaf labels (T6) and the listing (T7).

``predict`` turns a tree of few nodes into one expression, nested CASEs that end
in the leaf's label and path: a projection, on tables and streams alike.  Larger
trees are walked with one equi-join per level: (node id, branch) of the row meets
the edge table, which returns the child's id, its label and its split.  The edges
are broadcast when they are proven small (in bytes), and joined by a plain join
otherwise, where the branch value spreads the rows of a node.  A row whose branch
was never seen in training stays at the deepest node it reached and gets that
node's majority label (T9).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from entrotree.functions.exprs import NULL_BRANCH, is_whole, sql_literal, sql_name, sql_text, value_type_of
from entrotree.operators.binary import left_sql
from entrotree.runtime import BROADCAST_BYTES, global_sum, materialize, value_bytes

# Nodes of a tree that is compiled into one expression.
COMPILED_NODES = 512


def _edges(tree: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per node: ids of parent and node, branch, label and split; roots have no parent id."""
    nodes = materialize(tree.withColumn("_id", F.monotonically_increasing_id()))
    split = [F.when(~F.col("is_leaf"), F.col(c)).alias(a) for c, a in
             (("split_index", "_si"), ("threshold", "_thr"), ("cut", "_cut")) if c in tree.columns]
    if "threshold" in tree.columns and "cut" not in tree.columns:
        split.append(F.lit(None).cast("bigint").alias("_cut"))
    child = nodes.select(*by, "parent", "node", "depth", F.col("_id").alias("_child"),
                         F.col("branch_value").alias("_branch"), F.col("majority").alias("_label"), *split)
    parent = nodes.select(*by, F.col("node").alias("parent"), F.col("_id").alias("_parent"))
    return materialize(child.join(parent, [*by, "parent"], "left"))


def _compiled(nodes: Sequence[Row], kinds: dict[str, str], features: Sequence[str], by: Sequence[str],
              value_type: str, label_type: str) -> str:
    """SQL text of a whole tree (one per ``by`` key): nested CASEs that end in (label, node)."""
    children: dict[tuple, list[Row]] = {}
    for r in nodes:
        if r["parent"] is not None:
            children.setdefault((r["parent"], *[r[k] for k in by]), []).append(r)

    def walk(r: Row) -> str:
        end = (f"named_struct('label', {sql_literal(r['majority'], label_type)}, "
               f"'node', {sql_text(r['node'])})")
        below = [] if r["is_leaf"] else children.get((r["node"], *[r[k] for k in by]), [])
        if not below:
            return end
        feature = features[r["split_index"]]
        if "threshold" in r:
            cut = r["cut"] if "cut" in r else None
            sides = {c["branch_value"][:1]: walk(c) for c in below}
            return (f"CASE WHEN {left_sql(feature, kinds[feature], r['threshold'], cut)} THEN {sides['<']} "
                    f"ELSE {sides['>']} END")
        value = f"CAST(CAST({sql_name(feature)} AS {value_type}) AS STRING)"
        whens = [f"WHEN {value} <=> {sql_literal(c['branch_value'], 'string')} THEN {walk(c)}" for c in below]
        return f"CASE {' '.join(whens)} ELSE {end} END"

    roots = [r for r in nodes if r["parent"] is None]
    if not by:
        return walk(roots[0])
    whens = [f"WHEN {' AND '.join(f'{sql_name(k)} = {sql_literal(r[k], kinds[k])}' for k in by)} THEN {walk(r)}"
             for r in roots]
    return f"CASE {' '.join(whens)} END"


def predict(df: DataFrame, tree: DataFrame, features: Sequence[str], *,
            by: Sequence[str] = (), value_type: str | None = None,
            out: str = "prediction", node_out: str | None = None,
            compiled_nodes: int = COMPILED_NODES,
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``out`` (the predicted label) and optionally ``node_out`` (leaf path).

    ``by`` keys select one tree per row (e.g. the fold model).  Works for the
    multiway and the binary tree tables (a ``threshold`` column marks binary
    splits).  One row comes out for each that goes in.  Trees of at most
    ``compiled_nodes`` nodes are one expression, so scoring adds no join and no
    exchange; larger ones are joined level by level.
    """
    by, features = list(by), list(features)
    value_type = value_type or ("double" if "threshold" in tree.columns else value_type_of(df, features))
    tree = materialize(tree)  # read several times
    nodes = tree.limit(compiled_nodes + 1).collect()
    if not nodes and tree.isEmpty():
        raise ValueError("empty tree")
    if len(nodes) > compiled_nodes:
        return _predict_by_joins(df, tree, features, by, value_type, out, node_out, broadcast_bytes)
    kinds = dict(df.dtypes)
    case = _compiled(nodes, kinds, features, by, value_type, dict(tree.dtypes)["majority"])
    # One struct of the row and one of its leaf: no helper column beside the input's.
    scored = df.select(F.struct(*[F.col(sql_name(c)) for c in df.columns]).alias("row"), F.expr(case).alias("leaf"))
    ends = [F.col("leaf.node").alias(node_out)] if node_out else []
    return scored.select("row.*", *ends, F.col("leaf.label").alias(out))


def _predict_by_joins(df: DataFrame, tree: DataFrame, features: Sequence[str], by: Sequence[str], value_type: str,
                      out: str, node_out: str | None, broadcast_bytes: int) -> DataFrame:
    binary = "threshold" in tree.columns
    edges = _edges(tree, by)
    size = edges.agg(F.max("depth").alias("depth"), value_bytes(edges).alias("bytes")).first()
    small = F.broadcast if size["bytes"] <= broadcast_bytes else (lambda side: side)
    state = ["_id", "_pred", "_si", *(["_thr", "_cut"] if binary else [])]
    found = [F.col("_child").alias("_c_id"), F.col("_label").alias("_c_pred"),
             *[F.col(c).alias(f"_c{c}") for c in state[2:]]]
    # The input row is packed, so that no column of it meets one of these.
    packed = df.select(F.struct(*[F.col(sql_name(c)) for c in df.columns]).alias("_row"),
                       *[F.col(sql_name(k)).alias(f"_by_{k}") for k in by])
    roots = edges.where("depth = 0").select(*[F.col(k).alias(f"_by_{k}") for k in by],
                                            *[F.col(c).alias(a) for c, a in zip(["_child", "_label", *state[2:]], state, strict=True)])
    kinds = dict(df.dtypes)

    def inputs(kind: str, test=lambda k: True) -> list[Column]:
        return [F.col(f"_row.{sql_name(f)}").cast(kind) if test(kinds[f]) else F.lit(None).cast(kind) for f in features]
    rows = packed.join(small(roots), [f"_by_{k}" for k in by], "left") if by else packed.join(F.broadcast(roots), F.lit(True))
    at = F.col("_si") + 1
    for depth in range(1, size["depth"] + 1):
        if binary:
            number, whole = F.element_at(F.array(*inputs("double")), at), F.element_at(F.array(*inputs("bigint", is_whole)), at)
            left = F.when(F.col("_cut").isNotNull() & whole.isNotNull(), whole <= F.col("_cut")).otherwise(
                number <= F.col("_thr"))
            branch = F.when(left, F.lit("<")).otherwise(F.lit(">"))
        else:
            branch = F.element_at(F.array(*inputs(value_type)), at).cast("string")
        # Rows that have stopped look for no parent.
        looked = rows.withColumn("_at", F.when(F.col("_si").isNotNull(), F.col("_id"))).withColumn("_to", branch)
        level = edges.where(F.col("depth") == depth).select(
            *[F.col(k).alias(f"_k_{k}") for k in by], "_parent",
            (F.substring("_branch", 1, 1) if binary else F.col("_branch")).alias("_branch"), *found)
        on = [F.col("_at") == F.col("_parent"), F.col("_to").eqNullSafe(F.col("_branch")),
              *[F.col(f"_by_{k}") == F.col(f"_k_{k}") for k in by]]
        hit = F.col("_c_id").isNotNull()
        moved = [F.when(hit, F.col(f"_c{c}")).otherwise(F.col(c) if c in ("_id", "_pred") else F.lit(None)).alias(c)
                 for c in state]
        rows = looked.join(small(level), reduce(lambda a, b: a & b, on), "left").select(*packed.columns, *moved)
    ends = []
    if node_out:
        rows = rows.join(small(edges.select(F.col("_child").alias("_id"), F.col("node").alias("_node"))), "_id", "left")
        ends = [F.col("_node").alias(node_out)]
    return rows.select("_row.*", *ends, F.col("_pred").alias(out))


def leaf_labels(tree: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Leaves with their size and majority label (T6)."""
    return tree.where(F.col("is_leaf")).select(*by, "node", "depth", "n", "majority")


def tree_listing(tree: DataFrame, by: Sequence[str] = (), numeric: bool = False) -> DataFrame:
    """One text line per node, indented by depth, and its number ``line_no`` in
    depth-first order (T7).

    ``line`` reads e.g. ``"    f0=2: best f1, predict 0"``.  Siblings are ordered
    by branch value -- by number if ``numeric`` -- null first.
    """
    binary = "threshold" in tree.columns
    sep = F.lit("") if binary else F.lit("=")  # binary: "f2<=4.5"
    branch = F.when(F.col("parent_feature").isNotNull(),
                    F.concat(F.col("parent_feature"), sep,
                             F.coalesce(F.col("branch_value"), F.lit(NULL_BRANCH)), F.lit(": "))
                    ).otherwise(F.lit(""))
    what = F.when(F.col("is_leaf"),
                  F.concat(F.coalesce(F.concat(F.lit("best "), F.col("split_feature"), F.lit(", ")),
                                      F.lit("")),
                           F.lit("predict "), F.col("majority").cast("string"))
                  ).otherwise(F.concat(F.lit("split on "), F.col("split_feature")))
    line = F.concat(F.repeat(F.lit("  "), F.col("depth")), branch, what)
    nodes = materialize(tree.select(*by, "node", "parent", "depth", "branch_value", line.alias("line")))
    # Rank among siblings, then the list of ranks from the root orders depth-first.
    value = F.col("branch_value")
    key = value.try_cast("double") if numeric else value
    sibling = F.row_number().over(Window.partitionBy(*by, "parent").orderBy(key.asc_nulls_first(), value))
    ranked = nodes.withColumn("_rank", sibling)
    deepest = nodes.agg(F.max("depth")).first()[0]
    level = ranked.where("depth = 0").withColumn("_path", F.array("_rank"))
    levels = [level]
    for depth in range(1, (deepest or 0) + 1):
        above = level.select(*by, F.col("node").alias("parent"), F.col("_path").alias("_above"))
        level = (ranked.where(F.col("depth") == depth).join(above, [*by, "parent"])
                 .withColumn("_path", F.concat("_above", F.array("_rank"))).drop("_above"))
        levels.append(level.select(levels[0].columns))
    listed = reduce(lambda a, b: a.unionByName(b), levels)
    order = [*[F.col(k) for k in by], F.col("_path")]
    return global_sum(listed, F.lit(1), *order, name="line_no").select(*by, "line_no", "node", "depth", "line")
