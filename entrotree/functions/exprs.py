"""Column expressions used by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``;
nothing runs in Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the keyed split: two multiplicative
# congruential steps modulo the Mersenne prime 2^31 - 1.
HASH_MODULUS = 2147483647
HASH_MULT_1 = 48271
HASH_MULT_2 = 69621

# Branch of a null feature value in node paths; no escaped value can equal it.
NULL_BRANCH = "<null>"

# Characters with a meaning in node paths, escaped inside names and values
# (the escape character first).
PATH_ESCAPES = {"%": "%25", "/": "%2F", "=": "%3D", "<": "%3C", ">": "%3E"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nlog2n(n: str | Column) -> Column:
    """``n * log2(n)`` with ``0 log 0 = 0``."""
    n = _col(n).cast("double")
    return F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))


def entropy_from_sums(total: str | Column, sum_nlogn: str | Column,
                      n_labels: str | Column | None = None) -> Column:
    """Label entropy (bits) of a group from ``N = sum(n)`` and ``sum(n log2 n)``.

    ``H = -sum(n/N * log2(n/N)) = log2(N) - sum(n log2 n) / N``; one pass,
    no per-group total needed first.  A group with one label is exactly 0.
    """
    total = _col(total).cast("double")
    h = F.greatest(F.lit(0.0), F.log2(total) - _col(sum_nlogn) / total)
    if n_labels is not None:
        h = F.when(_col(n_labels) <= 1, F.lit(0.0)).otherwise(h)
    return h


def equal_width_bin(x: str | Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin ``0 .. bins-1`` of ``x`` over ``[lo, hi]``.

    Null and NaN have no bin (null); infinities fall into the outer bins.
    """
    x = _col(x).cast("double")
    known = x.isNotNull() & ~F.isnan(x)
    if hi is None or lo is None or hi <= lo:
        return F.when(known, F.lit(0))
    lo, width = float(lo), float(hi) - float(lo)
    raw = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(bins)), (x - F.lit(lo)) * F.lit(bins) / F.lit(width))))
    return F.when(known, F.least(F.lit(bins - 1), raw)).cast("int")


def keyed_hash(key: str | Column, seed: int) -> Column:
    """Deterministic pseudo-random ``u2`` in ``[0, 2^31-1)`` of an integer key.

    Any SQL engine can repeat it, and it does not depend on partitioning
    (unlike ``randomSplit``).  Keys are first reduced modulo the prime, so
    products stay far below 2^63.  A null key hashes like 0, so that its row
    is on one side of every split.
    """
    k = F.pmod(F.coalesce(_col(key).cast("long"), F.lit(0)), F.lit(HASH_MODULUS))
    u1 = F.pmod(k * F.lit(HASH_MULT_1) + F.lit(int(seed)), F.lit(HASH_MODULUS))
    return F.pmod(u1 * F.lit(HASH_MULT_2), F.lit(HASH_MODULUS))


def keyed_train_flag(key: str | Column, seed: int, train_percent: int) -> Column:
    """True for the train side of a keyed ``train_percent : rest`` split."""
    return F.pmod(keyed_hash(key, seed), F.lit(100)) < F.lit(int(train_percent))


def keyed_fold(key: str | Column, seed: int, k: int) -> Column:
    """Fold ``0 .. k-1``; reads other digits of the hash than the split."""
    u2 = keyed_hash(key, seed)
    return F.pmod(F.floor(u2 / F.lit(100)), F.lit(int(k))).cast("int")


def feature_index(feature: str | Column, features: Sequence[str]) -> Column:
    """Position of a feature name in ``features`` (0-based), for tie-breaks."""
    names = F.array(*[F.lit(f) for f in features])
    return (F.array_position(names, _col(feature)) - 1).cast("int")


def pick_feature(features: Sequence[str], index: str | Column,
                 cast: str = "string") -> Column:
    """Value of the feature at ``index`` (0-based, per row) as ``cast``."""
    values = F.array(*[F.col(f).cast(cast) for f in features])
    return F.element_at(values, _col(index) + 1)


def path_part(text: str | Column) -> Column:
    """A feature name or value as it stands in a node path (injective)."""
    out = _col(text).cast("string")
    for c, escaped in PATH_ESCAPES.items():
        out = F.replace(out, F.lit(c), F.lit(escaped))
    return out


def child_path(parent: str | Column, feature: str | Column,
               value: str | Column) -> Column:
    """Path of a multiway child: ``parent/feature=value``, both parts escaped."""
    return F.concat(_col(parent), F.lit("/"), path_part(feature), F.lit("="),
                    F.coalesce(path_part(value), F.lit(NULL_BRANCH)))


def binary_path(parent: str | Column, feature: str | Column, side: str,
                threshold: str | Column) -> Column:
    """Path of a binary child: ``parent/feature<=t`` or ``parent/feature>t``."""
    return F.concat(_col(parent), F.lit("/"), path_part(feature), F.lit(side),
                    _col(threshold).cast("string"))


def sql_name(column: str) -> str:
    """A column name in SQL text."""
    return "`" + column.replace("`", "``") + "`"


def sql_text(value) -> str:
    """A text literal in SQL text."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_literal(value, kind: str) -> str:
    """A value of type ``kind`` in SQL text; exact, as every type reads back its own text."""
    if value is None:
        return f"CAST(NULL AS {kind})"
    if kind == "string":
        return sql_text(value)
    return f"CAST({sql_text(str(value).lower() if isinstance(value, bool) else value)} AS {kind})"


def sql_path_part(expr: str) -> str:
    """``path_part`` as SQL text."""
    out = f"CAST({expr} AS STRING)"
    for c, escaped in PATH_ESCAPES.items():
        out = f"replace({out}, '{c}', '{escaped}')"
    return out


def escaped_part(text: str) -> str:
    """``path_part`` of a text known here."""
    for c, escaped in PATH_ESCAPES.items():
        text = text.replace(c, escaped)
    return text


def is_whole(kind: str) -> bool:
    """Whether a column type holds integers of at most 64 bits."""
    return kind in ("tinyint", "smallint", "int", "bigint")


def value_type_of(df, features: Sequence[str]) -> str:
    """One type that holds all features: int, bigint, double or string."""
    types = {df.schema[f].dataType.simpleString() for f in features}
    if types <= {"tinyint", "smallint", "int"}:
        return "int"
    if types <= {"tinyint", "smallint", "int", "bigint"}:
        return "bigint"
    if types <= {"tinyint", "smallint", "int", "bigint", "float", "double"}:
        return "double"
    return "string"
