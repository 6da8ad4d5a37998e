"""Delimited text sources (S1-S3).

The reference reads its binned table as raw text lines and splits each line on
commas; it also reads the same file with a header and inferred types.  Both
forms are built on Spark's own readers.  Types are inferred as one aggregation:
every field has a place in the chain nothing < int < bigint < double < string,
and a column takes the highest place of its fields.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entrotree.functions.exprs import sql_name


def _clean(line: str) -> str:
    return line.lstrip("\ufeff").rstrip("\r")


def _header_line(spark: SparkSession, path: str) -> str:
    # One line, fetched once, to name the columns.  The files of a folder have
    # the same header each.
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path} is empty")
    return _clean(first[0][0])


def split_fields(line: Column, names: Sequence[str], sep: str = ",", kind: str = "int") -> list[Column]:
    """The fields of a text line, cast, under their names (S2, R7); an empty field is null."""
    fields = F.split(line, re.escape(sep))
    return [F.nullif(F.trim(F.get(fields, F.lit(i))), F.lit("")).cast(kind).alias(c)
            for i, c in enumerate(names)]


def _rename(names: Sequence[str], label: str, feature_prefix: str,
            label_name: str) -> list[str]:
    out = []
    for c in names:
        if c == label:
            out.append(label_name)
        elif feature_prefix and c.isdigit():
            out.append(f"{feature_prefix}{c}")
        else:
            out.append(c)
    return out


# A column's type by the highest place of its fields.
KINDS = ("string", "int", "bigint", "double", "string")
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i)[+-]?(nan|inf|infinity))$"


def _field(column: str) -> Column:
    """A field without the blanks around it; an empty one is null."""
    return F.nullif(F.trim(F.col(sql_name(column))), F.lit(""))


def infer_kinds(fields: DataFrame) -> dict[str, str]:
    """The type of each text column, from one pass: int, bigint, double or string.

    Empty fields tell nothing; a column of nothing else is a string.  Integers of
    more than 64 bits make a column of doubles.
    """
    def place(column: str) -> Column:
        x = _field(column)
        return (F.when(x.isNull(), 0)
                .when(x.rlike(_WHOLE) & x.try_cast("int").isNotNull(), 1)
                .when(x.rlike(_WHOLE) & x.try_cast("bigint").isNotNull(), 2)
                .when(x.rlike(_NUMBER) & x.try_cast("double").isNotNull(), 3).otherwise(4))
    found = fields.agg(*[F.max(place(c)).alias(f"k{i}") for i, c in enumerate(fields.columns)]).first()
    return {c: KINDS[found[f"k{i}"] or 0] for i, c in enumerate(fields.columns)}


def typed_fields(fields: DataFrame, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Text columns under the types given or inferred; an empty field is null."""
    kinds = kinds or infer_kinds(fields)
    return fields.select(*[(_field(c) if kinds[c] == "string" else _field(c).try_cast(kinds[c])).alias(c)
                           for c in fields.columns])


def read_binned_csv(spark: SparkSession, path: str, *,
                    columns: Sequence[str] | None = None,
                    label: str = "class", label_name: str = "y",
                    feature_prefix: str = "f", sep: str = ",",
                    kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Read a header CSV with inferred types (S1, S3), or with ``kinds`` by column, for one pass less.

    Numeric header names ``0, 1, ...`` become ``f0, f1, ...`` and ``label``
    becomes ``label_name``.  A UTF-8 BOM, CRLF line ends and quotes are handled by
    the CSV source.
    """
    names = list(columns) if columns is not None else [
        c.strip() for c in _header_line(spark, path).split(sep)]
    out = _rename(names, label, feature_prefix, label_name)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in out])
    fields = (spark.read.schema(schema)
              .option("header", True)
              .option("sep", sep)
              .option("mode", "FAILFAST")
              .csv(path))
    return typed_fields(fields, kinds)


def read_lines_as_fields(spark: SparkSession, path: str, *,
                         label: str = "class", label_name: str = "y",
                         feature_prefix: str = "f", sep: str = ",") -> DataFrame:
    """Text-line form of the same scan (S1 + S2): read lines, split on ``sep``.

    Unlike the reference, the header line is dropped (its fields would
    otherwise be counted as data), and the BOM and carriage returns are
    removed before splitting.
    """
    header_line = _header_line(spark, path)
    out = _rename([c.strip() for c in header_line.split(sep)], label, feature_prefix, label_name)
    clean = F.regexp_replace(F.col("value"), "^\ufeff|\r$", "")
    lines = (spark.read.text(path)
             .select(clean.alias("line"))
             .where((F.col("line") != F.lit(header_line)) & (F.length("line") > 0)))
    return lines.select(*split_fields(F.col("line"), out, sep))
