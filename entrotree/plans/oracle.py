"""Equivalent ANSI SQL (run by DuckDB) for the queries in ``catalog``.

The SQL restates each operator independently of the Spark code: entropies use
the textbook ``-sum(p log2 p)``, arg-min/arg-max use ``ROW_NUMBER()``, the
fixed-depth trees are CTE chains (one block per level), and rows are routed
through a tree with joins per level.  The helpers below only assemble SQL
text; DuckDB plans and runs it.
"""

from __future__ import annotations

from collections.abc import Sequence

from entrotree.plans.catalog import DEPTH, FEATURE_GROUPS, SEED
from entrotree.sources.fixtures import DOC_FEATURES, EV_FEATURES, LI_FEATURES

NULL_BRANCH = "<null>"

# ------------------------------------------------------------ fixture views
LI_BINS = """li_bins AS (
  SELECT k, f0, f1, f2, f3, f4, f5, f6,
         CAST(CASE WHEN (k * 7) % 11 = 0 THEN 1 - y0 ELSE y0 END AS INTEGER) AS y
  FROM (
    SELECT *, CASE WHEN (f0 >= 3 AND f1 >= 2) OR f2 >= 5 THEN 1 ELSE 0 END AS y0
    FROM (
      SELECT l_orderkey * 10 + l_linenumber AS k,
             CAST(least(6, floor((l_quantity - 1) * 7 / 49)) AS INTEGER) AS f0,
             CAST(least(6, floor(l_discount * 7 / 0.10)) AS INTEGER) AS f1,
             CAST(least(6, floor(l_tax * 7 / 0.08)) AS INTEGER) AS f2,
             CAST(l_linenumber - 1 AS INTEGER) AS f3,
             CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS f4,
             CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS INTEGER) AS f5,
             CAST(year(l_shipdate) - 1995 AS INTEGER) AS f6
      FROM lineitem) a) b)"""

DOC_BINS = """doc_j AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
doc_bins AS (
  SELECT doc_id AS k, lang, source,
         CAST(CAST(CASE WHEN n_chars IS NOT NULL THEN
              least(6, greatest(0, floor((n_chars - (SELECT min(n_chars) FROM doc_j)) * 7
              / ((SELECT max(n_chars) FROM doc_j) - (SELECT min(n_chars) FROM doc_j))))) END
              AS INTEGER) AS VARCHAR) AS nb,
         CAST(quality AS INTEGER) AS y
  FROM doc_j)"""

EV_BINS = """ev_bins AS (
  SELECT event_id AS k,
         CAST(CASE WHEN value IS NOT NULL THEN
              least(6, greatest(0, floor((value - (SELECT min(value) FROM events)) * 7
              / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events))))) END
              AS INTEGER) AS f0,
         CAST(hour(ts) AS INTEGER) AS f1,
         CAST(user_id % 7 AS INTEGER) AS f2,
         event_type AS y
  FROM events)"""


#: Rows that the tree of ``score_unseen`` is grown on.
SEEN = "f2 <= 3 AND f0 <= 4"
URL_FEATURES = ["u", "lang"]
URL_PARTS = """url_parts AS (
  SELECT page_id AS k, regexp_replace(url, '[0-9]+', '', 'g') AS u, split_part(url, '/', 4) AS lang,
         CAST(CASE WHEN strlen(html) % 3 = 0 OR url LIKE '%=%' THEN 1 ELSE 0 END AS INTEGER) AS y
  FROM pages)"""
WIDE_FEATURES = ["price", "f2"]
LI_WIDE = """li_wide AS (
  SELECT l_extendedprice AS price, least(6, floor(l_tax * 7 / 0.08)) AS f2,
         CAST(CASE WHEN l_extendedprice > 40000 OR l_linenumber = 2 THEN 1 ELSE 0 END AS INTEGER) AS y
  FROM lineitem)"""
LI_NULLS = f"""li_nulls AS (
  SELECT {", ".join("CASE WHEN f3 % 3 = 1 THEN NULL ELSE f0 END AS f0" if f == "f0" else f for f in LI_FEATURES)}, y
  FROM li_bins)"""
LI_PARTS = """li_parts AS (
  SELECT l_partkey AS part, l_suppkey AS supp, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS y
  FROM lineitem)"""


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _k(keys: Sequence[str], prefix: str = "") -> str:
    return "".join(f"{prefix}{k}, " for k in keys)


def _part(keys: Sequence[str]) -> str:
    return ("PARTITION BY " + ", ".join(keys)) if keys else ""


def fidx_sql(col: str, features: Sequence[str]) -> str:
    whens = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(features))
    return f"CASE {col} {whens} END"


def pick_sql(col: str, features: Sequence[str], cast: str = "VARCHAR", alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    whens = " ".join(f"WHEN '{f}' THEN CAST({a}{f} AS {cast})" for f in features)
    return f"CASE {col} {whens} END"


def esc(expr: str) -> str:
    """A name or value as it stands in a node path."""
    out = f"CAST({expr} AS VARCHAR)"
    for c, escaped in (("%", "%25"), ("/", "%2F"), ("=", "%3D"), ("<", "%3C"), (">", "%3E")):
        out = f"replace({out}, '{c}', '{escaped}')"
    return out


# ----------------------------------------------------------- building blocks
def unpivot_sql(src: str, features: Sequence[str], keys: Sequence[str], vtype: str,
                label: str = "y", weight: str | None = None) -> str:
    w = weight or "1"
    parts = [f"SELECT {_k(keys)}'{f}' AS feature, CAST({f} AS {vtype}) AS value, "
             f"{label} AS label, {w} AS w FROM {src}" for f in features]
    return "\n    UNION ALL ".join(parts)


def cont_sql(src: str, features: Sequence[str], keys: Sequence[str] = (), vtype: str = "INTEGER",
             label: str = "y", weight: str | None = None) -> str:
    """Contingency ``keys, feature, value, label, n``."""
    return (f"SELECT {_k(keys)}feature, value, label, CAST(SUM(w) AS BIGINT) AS n FROM (\n    "
            f"{unpivot_sql(src, features, keys, vtype, label, weight)}) u\n"
            f"  GROUP BY {_k(keys)}feature, value, label")


def dist_sql(src: str, keys: Sequence[str], where: str = "", tie: str = "DESC") -> str:
    """``keys, n, entropy, majority`` of rows ``keys, label, n`` (summed first)."""
    w = f"WHERE {where}" if where else ""
    return f"""SELECT {_k(keys)}CAST(SUM(n) AS BIGINT) AS n,
         0.0 - SUM(p * log2(p)) AS entropy,
         MAX(CASE WHEN rk = 1 THEN label END) AS majority
  FROM (SELECT {_k(keys)}label, n, n / SUM(n) OVER ({_part(keys)}) AS p,
               ROW_NUMBER() OVER ({_part(keys)} ORDER BY n DESC, label {tie}) AS rk
        FROM (SELECT {_k(keys)}label, SUM(n) AS n FROM {src} {w} GROUP BY {_k(keys)}label) s0) s1
  {"GROUP BY " + ", ".join(keys) if keys else ""}"""


def vstats_sql(cont: str, keys: Sequence[str] = ()) -> str:
    return dist_sql(cont, [*keys, "feature", "value"])


def fs_sql(cont: str, vs: str, features: Sequence[str], keys: Sequence[str] = ()) -> str:
    """Weighted entropy, node entropy and gain per (keys, feature)."""
    ne = dist_sql(cont, [*keys, "feature"])
    on = " AND ".join(f"a.{k} = b.{k}" for k in [*keys, "feature"])
    return f"""SELECT {_k(keys, 'a.')}a.feature, a.feature_index, a.node_n, a.n_values,
         a.weighted_entropy, b.entropy AS node_entropy, b.entropy - a.weighted_entropy AS gain
  FROM (SELECT {_k(keys)}feature, {fidx_sql('feature', features)} AS feature_index,
               CAST(SUM(n) AS BIGINT) AS node_n, CAST(COUNT(*) AS BIGINT) AS n_values,
               SUM(n * entropy) / SUM(n) AS weighted_entropy
        FROM {vs} GROUP BY {_k(keys)}feature) a
  JOIN ({ne}) b ON {on}"""


def best_sql(fs: str, keys: Sequence[str] = (), order: str = "round(weighted_entropy, 12), feature_index") -> str:
    return f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER ({_part(keys)} ORDER BY {order}) AS brk
                FROM {fs}) x WHERE brk = 1"""


def hash_sql(key: str, seed: int = SEED) -> str:
    m = 2147483647
    return (f"(((((({key}) % {m} + {m}) % {m}) * 48271 + {seed}) % {m}) * 69621 % {m})")


# ------------------------------------------------------------ multiway tree
def id3_ctes(src: str, features: Sequence[str], depth: int, vtype: str = "INTEGER",
             prefix: str = "t", keys: Sequence[str] = (), reuse: bool = True,
             split_pure: bool = True) -> tuple[list[str], str]:
    """CTEs growing the multiway tree over ``src`` (columns keys, features, y).

    Returns ``(ctes, tree_cte_name)``; the tree has the catalog's columns.
    """
    p = prefix
    kk = [*keys, "node"]
    feats = ", ".join(features)
    ctes = [f"{p}_d0 AS (SELECT {_k(keys)}'' AS node, {feats}, y FROM {src})"]
    levels = []
    for d in range(depth):
        last = d == depth - 1
        ctes.append(f"{p}_c{d} AS ({cont_sql(f'{p}_d{d}', features, kk, vtype)})")
        ctes.append(f"{p}_v{d} AS ({vstats_sql(f'{p}_c{d}', kk)})")
        ctes.append(f"{p}_f{d} AS ({fs_sql(f'{p}_c{d}', f'{p}_v{d}', features, kk)})")
        if not reuse:
            ctes.append(f"{p}_g{d} AS (SELECT * FROM {p}_f{d} WHERE NOT contains(node, '/' || feature || '='))")
        ctes.append(f"{p}_b{d} AS ({best_sql(f'{p}_f{d}' if reuse else f'{p}_g{d}', kk)})")
        if d == 0:
            ctes.append(f"""{p}_n0 AS (SELECT {_k(keys)}node, CAST(NULL AS VARCHAR) AS parent,
               CAST(NULL AS VARCHAR) AS parent_feature, CAST(NULL AS VARCHAR) AS branch_value,
               n, entropy, majority
        FROM ({dist_sql(f'{p}_c0', kk, where=f"feature = '{features[0]}'")}) r)""")
        else:
            on = " AND ".join(f"v.{k} = b.{k}" for k in kk)
            ctes.append(f"""{p}_n{d} AS (
        SELECT {_k(keys, 'v.')}v.node || '/' || v.feature || '=' || COALESCE({esc('v.value')}, '{NULL_BRANCH}') AS node,
               v.node AS parent, v.feature AS parent_feature, CAST(v.value AS VARCHAR) AS branch_value,
               v.n, v.entropy, v.majority
        FROM {p}_v{d - 1} v JOIN {p}_l{d - 1} b ON {on} AND v.feature = b.split_feature
        WHERE NOT b.is_leaf)""")
        on = " AND ".join(f"n.{k} = b.{k}" for k in kk)
        ctes.append(f"""{p}_l{d} AS (
        SELECT {_k(keys, 'n.')}n.node, n.parent, {d} AS depth, n.parent_feature, n.branch_value,
               b.feature AS split_feature, b.feature_index AS split_index, n.n, n.entropy,
               n.majority, b.weighted_entropy, b.gain,
               ({'TRUE' if last else 'FALSE'} OR b.feature IS NULL
                OR {'FALSE' if split_pure else 'n.entropy <= 0'}) AS is_leaf
        FROM {p}_n{d} n LEFT JOIN {p}_b{d} b ON {on})""")
        levels.append(f"SELECT * FROM {p}_l{d}")
        if not last:
            on = " AND ".join(f"r.{k} = b.{k}" for k in kk)
            ctes.append(f"""{p}_d{d + 1} AS (
        SELECT {_k(keys, 'r.')}r.node || '/' || b.split_feature || '=' ||
               COALESCE({esc(pick_sql('b.split_feature', features, 'VARCHAR', 'r'))}, '{NULL_BRANCH}') AS node,
               {', '.join('r.' + f for f in features)}, r.y
        FROM {p}_d{d} r JOIN {p}_l{d} b ON {on} WHERE NOT b.is_leaf)""")
    ctes.append(f"{p}_tree AS ({' UNION ALL '.join(levels)})")
    return ctes, f"{p}_tree"


def route_ctes(rows: str, row_cols: Sequence[str], tree: str, features: Sequence[str],
               depth: int, prefix: str = "s", binary: bool = False,
               keys: Sequence[str] = ()) -> tuple[list[str], str]:
    """CTEs walking ``rows`` down ``tree``; the result adds ``node`` and ``prediction``."""
    p = prefix
    cols = ", ".join(f"r.{c}" for c in row_cols)
    kon = "".join(f" AND t.{k} = r.{k}" for k in keys)
    ctes = [f"{p}_0 AS (SELECT {cols}, '' AS node FROM {rows} r)"]
    for d in range(depth):
        if binary:
            val = pick_sql("t.split_feature", features, "DOUBLE", "r")
            cand = (f"r.node || '/' || t.split_feature || CASE WHEN {val} <= t.threshold "
                    f"THEN '<=' ELSE '>' END || CAST(t.threshold AS VARCHAR)")
        else:
            val = pick_sql("t.split_feature", features, "VARCHAR", "r")
            cand = f"r.node || '/' || t.split_feature || '=' || COALESCE({esc(val)}, '{NULL_BRANCH}')"
        ckon = "".join(f" AND c.{k} = r.{k}" for k in keys)
        ctes.append(f"""{p}_{d + 1} AS (
        SELECT {cols}, CASE WHEN c.node IS NOT NULL THEN c.node ELSE r.node END AS node
        FROM (SELECT {cols}, r.node, CASE WHEN t.split_feature IS NOT NULL THEN {cand} END AS cand
              FROM {p}_{d} r LEFT JOIN {tree} t
                ON t.node = r.node AND t.depth = {d} AND NOT t.is_leaf{kon}) r
        LEFT JOIN {tree} c ON c.node = r.cand AND c.depth = {d + 1}{ckon})""")
    kon = "".join(f" AND t.{k} = r.{k}" for k in keys)
    ctes.append(f"""{p}_out AS (SELECT {cols}, r.node, t.majority AS prediction
        FROM {p}_{depth} r LEFT JOIN {tree} t ON t.node = r.node{kon})""")
    return ctes, f"{p}_out"


# -------------------------------------------------------------- binary tree
def _dist_counts(cols: Sequence[str], labels: Sequence) -> tuple[str, str, str]:
    """SQL for n, entropy and majority (tie -> lowest label) of count columns."""
    n = "(" + " + ".join(cols) + ")"
    ent = "(0.0 - (" + " + ".join(
        f"CASE WHEN {c} > 0 THEN ({c} / {n}) * log2({c} / {n}) ELSE 0.0 END" for c in cols) + "))"
    whens = []
    for i, c in enumerate(cols):
        conds = [f"{c} > {o}" for o in cols[:i]] + [f"{c} >= {o}" for o in cols[i + 1:]]
        lab = f"'{labels[i]}'" if isinstance(labels[i], str) else str(labels[i])
        whens.append(f"WHEN {' AND '.join(conds) or 'TRUE'} THEN {lab}")
    maj = "CASE " + " ".join(whens) + " END"
    return n, ent, maj


def _middle(kind: str) -> str:
    """A cut that separates ``value`` from the next one, ``nxt``."""
    if kind == "BIGINT":
        return "CAST((CAST(value AS HUGEINT) + nxt) // 2 AS BIGINT)"
    return "CASE WHEN (value + nxt) / 2 >= value AND (value + nxt) / 2 < nxt THEN (value + nxt) / 2 ELSE value END"


def binary_ctes(src: str, features: Sequence[str], depth: int, labels: Sequence,
                prefix: str = "b", keys: Sequence[str] = (), weight: str | None = None,
                kind: str = "DOUBLE") -> tuple[list[str], str]:
    """CTEs growing the binary entropy tree over ``src`` (keys, features, y[, weight])."""
    p = prefix
    kk = [*keys, "node"]
    K = len(labels)
    cs = [f"c{i}" for i in range(K)]
    w = weight or "1"
    lit = [f"'{v}'" if isinstance(v, str) else str(v) for v in labels]
    feats = ", ".join(f"CAST({f} AS {kind}) AS {f}" for f in features)
    ctes = [f"{p}_d0 AS (SELECT {_k(keys)}'' AS node, {feats}, y, {w} AS w FROM {src})"]
    levels = []
    for d in range(depth + 1):
        if d < depth or d == 0:
            sums = ", ".join(f"CAST(SUM(CASE WHEN label = {lit[i]} THEN w ELSE 0 END) AS BIGINT) AS c{i}"
                             for i in range(K))
            ctes.append(f"""{p}_x{d} AS (SELECT {_k(kk)}feature, value, {sums} FROM (
        {unpivot_sql(f'{p}_d{d}', features, kk, kind, 'y', 'w')}) u GROUP BY {_k(kk)}feature, value)""")
        if d == 0:
            n, ent, maj = _dist_counts(cs, labels)
            sums = ", ".join(f"SUM(c{i}) AS c{i}" for i in range(K))
            ctes.append(f"""{p}_n0 AS (SELECT {_k(kk)}CAST(NULL AS VARCHAR) AS parent,
               CAST(NULL AS VARCHAR) AS parent_feature, CAST(NULL AS VARCHAR) AS branch_value,
               {', '.join(cs)}, CAST({n} AS BIGINT) AS n, {ent} AS entropy, {maj} AS majority
        FROM (SELECT {_k(kk)}{sums} FROM {p}_x0 WHERE feature = '{features[0]}' GROUP BY {', '.join(kk)}) r)""")
        if d == depth:
            ctes.append(f"""{p}_l{d} AS (SELECT {_k(kk)}parent, {d} AS depth, parent_feature, branch_value,
               CAST(NULL AS VARCHAR) AS split_feature, CAST(NULL AS INTEGER) AS split_index,
               CAST(NULL AS {kind}) AS threshold, n, entropy, majority,
               CAST(NULL AS DOUBLE) AS weighted_entropy, CAST(NULL AS DOUBLE) AS gain, TRUE AS is_leaf
        FROM {p}_n{d})""")
            levels.append(f"SELECT * FROM {p}_l{d}")
            break
        part = _part([*kk, "feature"])
        lsums = ", ".join(f"SUM(c{i}) OVER ({part} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l{i}"
                          for i in range(K))
        tsums = ", ".join(f"SUM(c{i}) OVER ({part}) AS t{i}" for i in range(K))
        ln, lent, _ = _dist_counts([f"l{i}" for i in range(K)], labels)
        rn, rent, _ = _dist_counts([f"r{i}" for i in range(K)], labels)
        rdefs = ", ".join(f"t{i} - l{i} AS r{i}" for i in range(K))
        ctes.append(f"""{p}_k{d} AS (
        SELECT {_k(kk)}feature, {fidx_sql('feature', features)} AS split_index, threshold,
               {', '.join(f'l{i}' for i in range(K))}, {', '.join(f'r{i}' for i in range(K))},
               ({ln} * {lent} + {rn} * {rent}) / ({ln} + {rn}) AS weighted_entropy
        FROM (SELECT *, {rdefs}, {_middle(kind)} AS threshold FROM (
                SELECT {_k(kk)}feature, value, LEAD(value) OVER ({part} ORDER BY value) AS nxt,
                       {lsums}, {tsums}
                FROM {p}_x{d}) a WHERE nxt IS NOT NULL) b)""")
        ctes.append(f"{p}_b{d} AS ({best_sql(f'{p}_k{d}', kk, 'round(weighted_entropy, 12), split_index, threshold')})")
        on = " AND ".join(f"n.{k} = b.{k}" for k in kk)
        ctes.append(f"""{p}_m{d} AS (
        SELECT n.*, b.feature AS split_feature, b.split_index, b.threshold, b.weighted_entropy,
               {', '.join(f'b.l{i}' for i in range(K))}, {', '.join(f'b.r{i}' for i in range(K))},
               (b.feature IS NULL OR n.entropy <= 0) AS is_leaf
        FROM {p}_n{d} n LEFT JOIN {p}_b{d} b ON {on})""")
        ctes.append(f"""{p}_l{d} AS (SELECT {_k(kk)}parent, {d} AS depth, parent_feature, branch_value,
               CASE WHEN is_leaf THEN NULL ELSE split_feature END AS split_feature,
               CASE WHEN is_leaf THEN NULL ELSE split_index END AS split_index,
               CASE WHEN is_leaf THEN NULL ELSE threshold END AS threshold,
               n, entropy, majority,
               CASE WHEN is_leaf THEN NULL ELSE weighted_entropy END AS weighted_entropy,
               CASE WHEN is_leaf THEN NULL ELSE entropy - weighted_entropy END AS gain, is_leaf
        FROM {p}_m{d})""")
        levels.append(f"SELECT * FROM {p}_l{d}")
        sides = []
        for op, pre in (("<=", "l"), (">", "r")):
            cols = [f"{pre}{i}" for i in range(K)]
            n, ent, maj = _dist_counts(cols, labels)
            sides.append(f"""SELECT {_k(keys)}node || '/' || split_feature || '{op}' || CAST(threshold AS VARCHAR) AS node,
               node AS parent, split_feature AS parent_feature, '{op}' || CAST(threshold AS VARCHAR) AS branch_value,
               {', '.join(f'{c} AS c{i}' for i, c in enumerate(cols))},
               CAST({n} AS BIGINT) AS n, {ent} AS entropy, {maj} AS majority
        FROM {p}_m{d} WHERE NOT is_leaf""")
        ctes.append(f"{p}_n{d + 1} AS ({' UNION ALL '.join(sides)})")
        on = " AND ".join(f"r.{k} = m.{k}" for k in kk)
        val = pick_sql("m.split_feature", features, kind, "r")
        ctes.append(f"""{p}_d{d + 1} AS (
        SELECT {_k(keys, 'r.')}r.node || '/' || m.split_feature || CASE WHEN {val} <= m.threshold THEN '<=' ELSE '>' END
               || CAST(m.threshold AS VARCHAR) AS node, {', '.join('r.' + f for f in features)}, r.y, r.w
        FROM {p}_d{d} r JOIN {p}_m{d} m ON {on} WHERE NOT m.is_leaf)""")
    ctes.append(f"{p}_tree AS ({' UNION ALL '.join(levels)})")
    return ctes, f"{p}_tree"


# ----------------------------------------------------------------- queries
def _li_cont() -> str:
    return _with(LI_BINS, f"c AS ({cont_sql('li_bins', LI_FEATURES)})")


def _vs_query(view: str, cte: str, features, vtype, cols: str) -> str:
    return (_with(cte, f"c AS ({cont_sql(view, features, vtype=vtype)})",
                  f"v AS ({vstats_sql('c')})")
            + f"SELECT {cols} FROM v")


def _fs_query(view: str, cte: str, features, vtype) -> str:
    return _with(cte, f"c AS ({cont_sql(view, features, vtype=vtype)})",
                 f"v AS ({vstats_sql('c')})", f"fs AS ({fs_sql('c', 'v', features)})")


_WH_COLS = f"feature, feature_index, node_n, n_values, {r6('weighted_entropy')} AS weighted_entropy"
_TREE_COLS = (f"node, parent, depth, parent_feature, branch_value, split_feature, n, "
              f"{r6('entropy')} AS entropy, majority, {r6('weighted_entropy')} AS weighted_entropy, "
              f"{r6('gain')} AS gain, is_leaf")


def _li_tree_sql(select: str, train_only: bool = False, depth: int = DEPTH) -> str:
    src = "li_bins"
    extra = []
    if train_only:
        extra.append(f"li_train AS (SELECT * FROM li_bins WHERE {hash_sql('k')} % 100 < 80)")
        src = "li_train"
    ctes, tree = id3_ctes(src, LI_FEATURES, depth)
    return _with(LI_BINS, *extra, *ctes) + select.format(tree=tree)


def _level_counts_sql(depth: int) -> str:
    ctes, tree = id3_ctes("li_bins", LI_FEATURES, depth + 1)
    rctes, routed = route_ctes("li_bins", ["k", *LI_FEATURES, "y"], tree, LI_FEATURES, depth + 1)
    return (_with(LI_BINS, *ctes, *rctes, f"c AS ({cont_sql(routed, LI_FEATURES, ['node'])})")
            + "SELECT node, feature, value, label, n FROM c")


def _holdout_sql(select: str) -> str:
    ctes, tree = id3_ctes("li_train", LI_FEATURES, DEPTH)
    rctes, routed = route_ctes("li_test", ["k", *LI_FEATURES, "y"], tree, LI_FEATURES, DEPTH)
    return _with(LI_BINS,
                 f"li_train AS (SELECT * FROM li_bins WHERE {hash_sql('k')} % 100 < 80)",
                 f"li_test AS (SELECT * FROM li_bins WHERE {hash_sql('k')} % 100 >= 80)",
                 *ctes, *rctes,
                 f"cc AS (SELECT y AS actual, prediction AS predicted, CAST(COUNT(*) AS BIGINT) AS n "
                 f"FROM {routed} GROUP BY y, prediction)",
                 _LABEL_METRICS) + select.format(routed=routed)


_LABEL_METRICS_OF = """lm AS (
  SELECT label, CAST(SUM(tp) AS BIGINT) AS tp, CAST(SUM(na) AS BIGINT) AS n_actual,
         CAST(SUM(np) AS BIGINT) AS n_predicted,
         CASE WHEN SUM(np) > 0 THEN SUM(tp) / SUM(np) ELSE 0.0 END AS precision,
         CASE WHEN SUM(na) > 0 THEN SUM(tp) / SUM(na) ELSE 0.0 END AS recall
  FROM (SELECT actual AS label, CASE WHEN actual = predicted THEN n ELSE 0 END AS tp, n AS na, 0 AS np FROM cc
        UNION ALL SELECT predicted AS label, 0 AS tp, 0 AS na, n AS np FROM cc) u
  GROUP BY label),
sm AS (
  SELECT CAST(SUM(n_actual) AS BIGINT) AS n, CAST(SUM(tp) AS BIGINT) AS correct,
         SUM(tp) / SUM(n_actual) AS accuracy, 1 - SUM(tp) / SUM(n_actual) AS error_rate,
         COALESCE(MAX(CASE WHEN label = {positive} THEN precision END), 0.0) AS precision,
         COALESCE(MAX(CASE WHEN label = {positive} THEN recall END), 0.0) AS recall,
         AVG(precision) AS precision_macro, AVG(recall) AS recall_macro
  FROM lm)"""
_LABEL_METRICS = _LABEL_METRICS_OF.format(positive=1)


def _cv_sql(select: str, view: str = "li_bins", cte: str = LI_BINS, features: Sequence[str] = tuple(LI_FEATURES),
            labels: Sequence | None = (0, 1), positive: str = "1") -> str:
    """Cross-validation; binary trees over ``labels``, or multiway ones (None) over texts."""
    feats = ", ".join(features)
    h = hash_sql("k")
    binary = labels is not None
    ctes, tree = (binary_ctes("rep", features, DEPTH, labels, keys=["model"]) if binary else
                  id3_ctes("rep", features, DEPTH, vtype="VARCHAR", keys=["model"]))
    rctes, routed = route_ctes("held", ["model", *features, "y"], tree, features, DEPTH,
                               binary=binary, keys=["model"])
    rctes2, routed2 = route_ctes("test", [*features, "y"], "best_tree", features, DEPTH,
                                 prefix="h", binary=binary)
    return _with(
        cte,
        f"base AS (SELECT k, {feats}, y, {h} AS u2 FROM {view})",
        "train AS (SELECT *, CAST(CAST(floor(u2 / 100) AS BIGINT) % 5 AS INTEGER) AS fold "
        "FROM base WHERE u2 % 100 < 70)",
        "test AS (SELECT * FROM base WHERE u2 % 100 >= 70)",
        "models AS (SELECT CAST(range AS INTEGER) AS model FROM range(5))",
        f"rep AS (SELECT m.model, {', '.join('t.' + f for f in features)}, t.y "
        "FROM train t JOIN models m ON m.model <> t.fold)",
        *ctes,
        f"held AS (SELECT fold AS model, {feats}, y FROM train)",
        *rctes,
        f"fcc AS (SELECT model, y AS actual, prediction AS predicted, CAST(COUNT(*) AS BIGINT) AS n "
        f"FROM {routed} GROUP BY model, y, prediction)",
        """flm AS (
  SELECT model, label, SUM(tp) AS tp, SUM(na) AS na, SUM(np) AS np,
         CASE WHEN SUM(np) > 0 THEN SUM(tp) / SUM(np) ELSE 0.0 END AS precision,
         CASE WHEN SUM(na) > 0 THEN SUM(tp) / SUM(na) ELSE 0.0 END AS recall
  FROM (SELECT model, actual AS label, CASE WHEN actual = predicted THEN n ELSE 0 END AS tp, n AS na, 0 AS np FROM fcc
        UNION ALL SELECT model, predicted AS label, 0, 0, n FROM fcc) u
  GROUP BY model, label)""",
        """fm AS (
  SELECT model, CAST(SUM(na) AS BIGINT) AS n, SUM(tp) / SUM(na) AS accuracy,
         AVG(precision) AS precision_macro, AVG(recall) AS recall_macro
  FROM flm GROUP BY model)""",
        """bestm AS (SELECT model, accuracy FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY accuracy DESC, model) AS rk FROM fm) x WHERE rk = 1)""",
        f"best_tree AS (SELECT t.* FROM {tree} t JOIN bestm b ON t.model = b.model)",
        *rctes2,
        f"cc AS (SELECT y AS actual, prediction AS predicted, CAST(COUNT(*) AS BIGINT) AS n "
        f"FROM {routed2} GROUP BY y, prediction)",
        _LABEL_METRICS_OF.format(positive=positive),
    ) + select


def _feature_group_sql() -> str:
    h = hash_sql("k")
    ctes = [LI_BINS,
            f"g_train AS (SELECT * FROM li_bins WHERE {h} % 100 < 70)",
            f"g_test AS (SELECT * FROM li_bins WHERE {h} % 100 >= 70)"]
    parts = []
    for name, feats in FEATURE_GROUPS.items():
        tc, tree = id3_ctes("g_train", feats, DEPTH, prefix=f"t{name}")
        rc, routed = route_ctes("g_test", ["k", *feats, "y"], tree, feats, DEPTH, prefix=f"s{name}")
        ctes += tc + rc
        parts.append(f"SELECT '{name}' AS \"group\", CAST(COUNT(*) AS BIGINT) AS n, "
                     f"1 - AVG(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) AS err FROM {routed}")
    ctes.append(f"ge AS ({' UNION ALL '.join(parts)})")
    return _with(*ctes)


_BIN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _ewb(c: str) -> str:
    lo, hi = f"(SELECT min({c}) FROM lineitem)", f"(SELECT max({c}) FROM lineitem)"
    return (f"CAST(CASE WHEN {c} IS NOT NULL THEN "
            f"least(6, greatest(0, floor(({c} - {lo}) * 7 / ({hi} - {lo})))) END AS INTEGER)")


ORACLE: dict[str, str] = {
    "scan_count": "SELECT CAST(COUNT(*) AS BIGINT) AS n FROM lineitem",
    "peek": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate LIMIT 2""",
    "equal_width_bins": "SELECT l_orderkey, l_linenumber, "
                        + ", ".join(f"{_ewb(c)} AS {c}" for c in _BIN_COLS) + " FROM lineitem",
    "bin_occupancy": "SELECT \"column\", bin, CAST(COUNT(*) AS BIGINT) AS n FROM ("
                     + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_ewb(c)} AS bin FROM lineitem"
                                          for c in _BIN_COLS)
                     + ") u GROUP BY \"column\", bin",
    "class_histogram": _with(LI_BINS) + "SELECT y AS label, CAST(COUNT(*) AS BIGINT) AS n FROM li_bins GROUP BY y",
    "class_histogram_events": _with(EV_BINS) + "SELECT y AS label, CAST(COUNT(*) AS BIGINT) AS n FROM ev_bins GROUP BY y",
    "dataset_entropy": _with(LI_BINS, "h AS (SELECT y AS label, COUNT(*) AS n FROM li_bins GROUP BY y)",
                             f"d AS ({dist_sql('h', [])})") + f"SELECT n, {r6('entropy')} AS entropy FROM d",
    "dataset_entropy_events": _with(EV_BINS, "h AS (SELECT y AS label, COUNT(*) AS n FROM ev_bins GROUP BY y)",
                                    f"d AS ({dist_sql('h', [])})") + f"SELECT n, {r6('entropy')} AS entropy FROM d",
    "unpivot_counts": _li_cont() + "SELECT feature || '_' || CAST(value AS VARCHAR) AS key, feature, value, label, n FROM c",
    "value_entropy": _vs_query("li_bins", LI_BINS, LI_FEATURES, "INTEGER",
                               f"feature, value, n, {r6('entropy')} AS entropy, majority"),
    "value_entropy_docs": _vs_query("doc_bins", DOC_BINS, DOC_FEATURES, "VARCHAR",
                                    f"feature, value, n, {r6('entropy')} AS entropy, majority"),
    "majority_label_events": _vs_query("ev_bins", EV_BINS, EV_FEATURES, "INTEGER",
                                       "feature, value, n, majority"),
    "weighted_entropy": _fs_query("li_bins", LI_BINS, LI_FEATURES, "INTEGER") + f"SELECT {_WH_COLS} FROM fs",
    "weighted_entropy_docs": _fs_query("doc_bins", DOC_BINS, DOC_FEATURES, "VARCHAR") + f"SELECT {_WH_COLS} FROM fs",
    "weighted_entropy_events": _fs_query("ev_bins", EV_BINS, EV_FEATURES, "INTEGER") + f"SELECT {_WH_COLS} FROM fs",
    "info_gain": _fs_query("li_bins", LI_BINS, LI_FEATURES, "INTEGER")
                 + f"SELECT feature, {r6('node_entropy')} AS node_entropy, "
                   f"{r6('weighted_entropy')} AS weighted_entropy, {r6('gain')} AS gain FROM fs",
    "min_weighted_entropy": _with(
        LI_BINS, DOC_BINS, EV_BINS,
        f"c1 AS ({cont_sql('li_bins', LI_FEATURES)})", f"v1 AS ({vstats_sql('c1')})",
        f"f1 AS ({fs_sql('c1', 'v1', LI_FEATURES)})",
        f"c2 AS ({cont_sql('doc_bins', DOC_FEATURES, vtype='VARCHAR')})", f"v2 AS ({vstats_sql('c2')})",
        f"f2 AS ({fs_sql('c2', 'v2', DOC_FEATURES)})",
        f"c3 AS ({cont_sql('ev_bins', EV_FEATURES)})", f"v3 AS ({vstats_sql('c3')})",
        f"f3 AS ({fs_sql('c3', 'v3', EV_FEATURES)})")
        + f"SELECT 'li_bins' AS table_name, {r6('MIN(weighted_entropy)')} AS min_weighted_entropy FROM f1 "
          f"UNION ALL SELECT 'doc_bins', {r6('MIN(weighted_entropy)')} FROM f2 "
          f"UNION ALL SELECT 'ev_bins', {r6('MIN(weighted_entropy)')} FROM f3",
    "root_feature": _fs_query("li_bins", LI_BINS, LI_FEATURES, "INTEGER")[:-1]
                    + f",\nb AS ({best_sql('fs')})\n"
                    + f"SELECT feature, feature_index, {r6('weighted_entropy')} AS weighted_entropy FROM b",
    "root_profile": _fs_query("li_bins", LI_BINS, LI_FEATURES, "INTEGER")[:-1]
                    + f",\nb AS ({best_sql('fs')})\n"
                    + f"SELECT v.feature, v.value, v.n, {r6('v.entropy')} AS entropy, v.majority "
                      "FROM v JOIN b ON v.feature = b.feature",
    "branch_counts": _level_counts_sql(1),
    "path_counts": _level_counts_sql(2),
    "level2_features": _li_tree_sql(
        f"SELECT node, split_feature, {r6('weighted_entropy')} AS weighted_entropy FROM {{tree}} WHERE depth = 1"),
    "level3_features": _li_tree_sql(
        f"SELECT node, split_feature, {r6('weighted_entropy')} AS weighted_entropy FROM {{tree}} WHERE depth = 2"),
    "id3_tree": _li_tree_sql(f"SELECT {_TREE_COLS} FROM {{tree}}"),
    "tree_listing": _li_tree_sql(
        "SELECT CAST(row_number() OVER (ORDER BY list_transform(string_split(node, '/')[2:], "
        "lambda s: CAST(split_part(s, '=', 2) AS DOUBLE))) AS BIGINT) AS line_no, node, depth, repeat('  ', depth) || "
        "CASE WHEN parent_feature IS NOT NULL THEN parent_feature || '=' || "
        f"COALESCE(branch_value, '{NULL_BRANCH}') || ': ' ELSE '' END || "
        "CASE WHEN is_leaf THEN COALESCE('best ' || split_feature || ', ', '') || 'predict ' || "
        "CAST(majority AS VARCHAR) ELSE 'split on ' || split_feature END AS line FROM {tree}"),
    "leaf_labels": _li_tree_sql("SELECT node, depth, n, majority FROM {tree} WHERE is_leaf"),
}


def _add_later():
    ctes, tree = id3_ctes("li_bins", LI_FEATURES, DEPTH)
    rctes, routed = route_ctes("li_bins", ["k", *LI_FEATURES, "y"], tree, LI_FEATURES, DEPTH)
    ORACLE["score_rows"] = _with(LI_BINS, *ctes, *rctes) + f"SELECT k, y, prediction FROM {routed}"
    for name in ("score_rows_compiled", "score_rows_joined"):
        ORACLE[name] = _with(LI_BINS, *ctes, *rctes) + f"SELECT k, y, node, prediction FROM {routed}"
    ctes, tree = id3_ctes("seen", LI_FEATURES, DEPTH)
    rctes, routed = route_ctes("li_bins", ["k", *LI_FEATURES, "y"], tree, LI_FEATURES, DEPTH)
    ORACLE["score_unseen"] = _with(LI_BINS, f"seen AS (SELECT * FROM li_bins WHERE {SEEN})", *ctes, *rctes) + (
        f"SELECT k, y, node, prediction FROM {routed}")
    for name, options in (("id3_tree_no_reuse", {"reuse": False}), ("id3_tree_stop_pure", {"split_pure": False})):
        ctes, tree = id3_ctes("li_bins", LI_FEATURES, DEPTH, **options)
        ORACLE[name] = _with(LI_BINS, *ctes) + f"SELECT {_TREE_COLS} FROM {tree}"
    ctes, tree = id3_ctes("url_parts", URL_FEATURES, 2, vtype="VARCHAR")
    ORACLE["id3_tree_paths"] = _with(URL_PARTS, *ctes) + (
        f"SELECT node, depth, split_feature, n, {r6('entropy')} AS entropy, majority, is_leaf FROM {tree}")
    rctes, routed = route_ctes("url_parts", ["k", *URL_FEATURES, "y"], tree, URL_FEATURES, 2)
    ORACLE["score_paths"] = _with(URL_PARTS, *ctes, *rctes) + f"SELECT k, y, node, prediction FROM {routed}"
    for name, view, cte, features in (("binary_tree_wide", "li_wide", LI_WIDE, WIDE_FEATURES),
                                      ("binary_tree_nulls", "li_nulls", LI_NULLS, LI_FEATURES)):
        bc, btree = binary_ctes(view, features, 2, [0, 1])
        ORACLE[name] = _with(LI_BINS, cte, *bc) + (
            f"SELECT depth, split_feature, {r6('threshold')} AS threshold, n, {r6('entropy')} AS entropy, "
            f"majority, {r6('weighted_entropy')} AS weighted_entropy, is_leaf FROM {btree}")
    ORACLE["weighted_entropy_wide"] = _fs_query("li_parts", LI_PARTS, ["part", "supp"], "BIGINT") + (
        f"SELECT {_WH_COLS} FROM fs")
    ORACLE["cv_fold_metrics_docs"] = _cv_sql(
        "SELECT model, n, " + ", ".join(f"{r6(c)} AS {c}" for c in ("accuracy", "precision_macro", "recall_macro"))
        + " FROM fm", "doc_bins", DOC_BINS, DOC_FEATURES, None)
    ORACLE["cv_holdout_events"] = _cv_sql(
        "SELECT n, correct, " + ", ".join(f"{r6(c)} AS {c}" for c in (
            "accuracy", "precision", "recall", "precision_macro", "recall_macro")) + " FROM sm",
        "ev_bins", EV_BINS, EV_FEATURES, ["click", "error", "purchase", "signup", "view"], "'click'")
    ctes, tree = id3_ctes("ev_train", EV_FEATURES, 2)
    rctes, routed = route_ctes("ev_test", ["k", *EV_FEATURES, "y"], tree, EV_FEATURES, 2)
    ORACLE["confusion_events"] = _with(
        EV_BINS, f"ev_train AS (SELECT * FROM ev_bins WHERE {hash_sql('k')} % 100 < 80)",
        f"ev_test AS (SELECT * FROM ev_bins WHERE {hash_sql('k')} % 100 >= 80)", *ctes, *rctes,
        f"cc AS (SELECT y AS actual, prediction AS predicted, COUNT(*) AS n FROM {routed} GROUP BY ALL)",
        "ls AS (SELECT actual AS label FROM cc UNION SELECT predicted FROM cc)") + (
        "SELECT a.label AS actual, p.label AS predicted, CAST(COALESCE(cc.n, 0) AS BIGINT) AS n "
        "FROM ls a JOIN ls p ON TRUE LEFT JOIN cc ON cc.actual = a.label AND cc.predicted = p.label")
    ORACLE["text_fields"] = """SELECT CAST(l_orderkey AS INTEGER) AS a, CAST(l_linenumber AS INTEGER) AS b,
       CAST(l_partkey AS INTEGER) AS c FROM lineitem"""
    for name in ("typed_fields", "csv_scan"):
        ORACLE[name] = """SELECT CAST(l_orderkey AS INTEGER) AS a, l_orderkey * 4000000000 + l_linenumber AS b,
       CAST(l_extendedprice AS DOUBLE) AS c, l_returnflag AS d,
       CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_partkey AS INTEGER) END AS e,
       CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_linenumber AS VARCHAR) ELSE 'x' END AS f FROM lineitem"""
    ORACLE["random_split_sizes"] = "SELECT 'train' AS side, TRUE AS near_share UNION ALL SELECT 'test', TRUE"
    cuts, parts = [], []
    for name, value, kind in (("near", "1.0::DOUBLE + l_linenumber * power(2.0, -52)", "DOUBLE"),
                              ("huge", "l_linenumber * 2.5e307", "DOUBLE"),
                              ("endless", "CASE l_linenumber WHEN 7 THEN 'inf'::DOUBLE WHEN 1 THEN '-inf'::DOUBLE "
                                          "ELSE l_linenumber END", "DOUBLE"),
                              ("wide", "9007199254740992 + l_linenumber", "BIGINT")):
        bc, btree = binary_ctes(f"src_{name}", [name], 3, [0, 1], prefix=f"b{name}", kind=kind)
        cuts += [f"src_{name} AS (SELECT {value} AS {name}, CASE WHEN l_linenumber >= 3 AND (l_orderkey % 9 > 0 "
                 "OR l_linenumber = 7) THEN 1 ELSE 0 END AS y FROM lineitem)", *bc]
        parts.append(f"SELECT '{name}' AS kind, depth, split_feature, CAST(threshold AS DOUBLE) AS threshold, "
                     f"{'threshold' if kind == 'BIGINT' else 'CAST(NULL AS BIGINT)'} AS cut, n, "
                     f"{r6('entropy')} AS entropy, majority, {r6('weighted_entropy')} AS weighted_entropy, is_leaf "
                     f"FROM {btree}")
    ORACLE["binary_tree_cuts"] = _with(*cuts) + " UNION ALL ".join(parts)
    ORACLE["random_split_partition"] = """SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) AS BIGINT) AS n_sides,
       CAST(0 AS BIGINT) AS n_both FROM lineitem"""
    ORACLE["confusion"] = _holdout_sql(
        "SELECT a.label AS actual, p.label AS predicted, CAST(COALESCE(cc.n, 0) AS BIGINT) AS n "
        "FROM (SELECT DISTINCT label FROM lm) a JOIN (SELECT DISTINCT label FROM lm) p ON TRUE "
        "LEFT JOIN cc ON cc.actual = a.label AND cc.predicted = p.label")
    for name, col in (("accuracy", "accuracy"), ("precision_pos", "precision"),
                      ("precision_macro", "precision_macro"), ("recall_pos", "recall"),
                      ("recall_macro", "recall_macro"), ("error_rate", "error_rate")):
        ORACLE[name] = _holdout_sql(f"SELECT {r6(col)} AS {col} FROM sm")
    ORACLE["precision_per_label"] = _holdout_sql(f"SELECT label, {r6('precision')} AS precision FROM lm")
    ORACLE["recall_per_label"] = _holdout_sql(f"SELECT label, {r6('recall')} AS recall FROM lm")
    ORACLE["metrics_summary"] = _holdout_sql(
        "SELECT n, correct, " + ", ".join(f"{r6(c)} AS {c}" for c in
                                          ("accuracy", "error_rate", "precision", "recall",
                                           "precision_macro", "recall_macro")) + " FROM sm")
    key = "l_orderkey * 10 + l_linenumber"
    h = hash_sql(key)
    ORACLE["holdout_split"] = (f"SELECT {h} % 100 < 80 AS is_train, CAST(COUNT(*) AS BIGINT) AS n "
                               f"FROM lineitem GROUP BY 1")
    ORACLE["holdout_split_70"] = (f"SELECT {h} % 100 < 70 AS is_train, CAST(COUNT(*) AS BIGINT) AS n "
                                  f"FROM lineitem GROUP BY 1")
    digest = f"md5('{SEED}:' || CAST(k AS VARCHAR))"
    ranked = (f"SELECT k, row_number() OVER (ORDER BY {digest}, k) AS rk, COUNT(*) OVER () AS total "
              f"FROM (SELECT {key} AS k FROM lineitem) a")
    ORACLE["fold_sizes_equal"] = (f"SELECT CAST((rk - 1) % 7 AS INTEGER) AS fold, CAST(COUNT(*) AS BIGINT) AS n, "
                                  f"CAST(SUM(k) AS BIGINT) AS sum_k FROM ({ranked}) b GROUP BY 1")
    ORACLE["holdout_exact_70"] = (f"SELECT rk > ceil(0.3 * total) AS is_train, CAST(COUNT(*) AS BIGINT) AS n, "
                                  f"CAST(SUM(k) AS BIGINT) AS sum_k FROM ({ranked}) b GROUP BY 1")
    ORACLE["fold_sizes"] = (f"SELECT CAST(CAST(floor(u2 / 100) AS BIGINT) % 5 AS INTEGER) AS fold, "
                            f"CAST(COUNT(*) AS BIGINT) AS n, "
                            f"CAST(SUM(CASE WHEN u2 % 100 < 80 THEN 1 ELSE 0 END) AS BIGINT) AS n_train "
                            f"FROM (SELECT {h} AS u2 FROM lineitem) t GROUP BY 1")
    bc, btree = binary_ctes("li_bins", LI_FEATURES, 1, [0, 1])
    ORACLE["binary_root_split"] = _with(LI_BINS, *bc) + (
        f"SELECT split_feature, threshold, {r6('weighted_entropy')} AS weighted_entropy, "
        f"{r6('gain')} AS gain FROM {btree} WHERE depth = 0")
    bc, btree = binary_ctes("li_bins", LI_FEATURES, DEPTH, [0, 1])
    ORACLE["binary_tree"] = _with(LI_BINS, *bc) + (
        f"SELECT node, parent, depth, split_feature, threshold, n, {r6('entropy')} AS entropy, "
        f"majority, {r6('weighted_entropy')} AS weighted_entropy, is_leaf FROM {btree}")
    ORACLE["cv_fold_metrics"] = _cv_sql(
        "SELECT model, n, " + ", ".join(f"{r6(c)} AS {c}" for c in
                                        ("accuracy", "precision_macro", "recall_macro")) + " FROM fm")
    ORACLE["cv_mean"] = _cv_sql(
        "SELECT " + ", ".join(f"{r6('AVG(' + c + ')')} AS {c}" for c in
                              ("accuracy", "precision_macro", "recall_macro")) + " FROM fm")
    ORACLE["cv_best_fold"] = _cv_sql(f"SELECT model, {r6('accuracy')} AS accuracy FROM bestm")
    ORACLE["cv_holdout"] = _cv_sql(
        "SELECT n, correct, " + ", ".join(f"{r6(c)} AS {c}" for c in
                                          ("accuracy", "precision_macro", "recall_macro")) + " FROM sm")
    ORACLE["cv_holdout_labels"] = _cv_sql(
        f"SELECT label, tp, n_actual, n_predicted, {r6('precision')} AS precision, "
        f"{r6('recall')} AS recall FROM lm")
    ORACLE["feature_group_error"] = _feature_group_sql() + (
        f"SELECT \"group\", n, {r6('err')} AS error_rate FROM ge")
    ORACLE["best_feature_group"] = _feature_group_sql() + (
        f"SELECT \"group\", {r6('err')} AS error_rate FROM (SELECT *, ROW_NUMBER() OVER "
        f"(ORDER BY round(err, 12), \"group\") AS rk FROM ge) x WHERE rk = 1")
    ev_labels = ["click", "error", "purchase", "signup", "view"]
    bc, btree = binary_ctes("ev_bins", EV_FEATURES, DEPTH, ev_labels)
    ORACLE["binary_tree_events"] = _with(EV_BINS, *bc) + (
        f"SELECT node, depth, split_feature, threshold, n, {r6('entropy')} AS entropy, "
        f"majority, is_leaf FROM {btree}")
    ctes, tree = id3_ctes("ev_bins", EV_FEATURES, 2)
    ORACLE["id3_tree_events"] = _with(EV_BINS, *ctes) + (
        f"SELECT node, depth, split_feature, n, {r6('entropy')} AS entropy, majority, "
        f"{r6('weighted_entropy')} AS weighted_entropy, is_leaf FROM {tree}")
    ctes, tree = id3_ctes("doc_bins", DOC_FEATURES, DEPTH, vtype="VARCHAR")
    ORACLE["id3_tree_docs"] = _with(DOC_BINS, *ctes) + (
        f"SELECT node, depth, split_feature, n, {r6('entropy')} AS entropy, majority, is_leaf FROM {tree}")


_add_later()
