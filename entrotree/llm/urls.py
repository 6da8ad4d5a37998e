"""Operator 7: URL filters by a sort-merge range join.

Reversed-host keys ("org.example.www.") turn "this host and its subdomains"
into the key interval of a prefix.  URLs are range-sorted by key; every rule is
placed into each range its interval meets; one sorted sweep per range keeps the
stack of rules whose intervals are open, which are nested by construction, and
judges each URL by the longest one whose path fits.

Scale: only (page_id, host, path, key) is shuffled.  Ranges are cut by (key,
page_id), so a host with a third of all URLs is spread over many ranges; a
range gets the rules that begin in it and the enclosing ones, at most one per
host label and path.  The sweep streams record batches and holds only the
stack.  The driver reads two keys per range, the bound being the number of
partitions.

Defined cases: a null URL or one without "://" has empty host and path and no
rule; rows are judged one by one, so repeats and null ids are ordinary rows;
equal rules count once, of two that fit with the same length the one with the
longer host wins, then "block"; empty tables of URLs or rules are fine; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

#: The query's rules: verdict, host, path (fixed values).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL column; empty without "://"."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def reversed_key(host: Column) -> Column:
    """Labels in reverse order, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Level:
    """Open rules of one key: verdicts by path, and the path lengths to try."""

    def __init__(self, key: str) -> None:
        self.key, self.rules, self.lengths = key, {}, []

    def add(self, host: str, path: str, verdict: str) -> None:
        if path not in self.rules or verdict == "block":
            self.rules[path] = (host, verdict)
            self.lengths = sorted({len(p) for p in self.rules}, reverse=True)

    def longest(self, path: str) -> tuple[int, int, str, str] | None:
        for n in self.lengths:
            if n <= len(path) and path[:n] in self.rules:
                host, verdict = self.rules[path[:n]]
                return len(host) + n, len(host), host + path[:n], verdict
        return None


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Level] = []
        part = None
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("_part", "_key", "_kind", "host", "path", "verdict")}
            rows, rules, verdicts = [], [], []
            for i, key in enumerate(cols["_key"]):
                if cols["_part"][i] != part:
                    part, stack = cols["_part"][i], []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if cols["_kind"][i] == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Level(key))
                    stack[-1].add(cols["host"][i], cols["path"][i], cols["verdict"][i])
                    continue
                fits = [f for level in stack if (f := level.longest(cols["path"][i]))]
                best = max(fits, default=None, key=lambda f: (f[0], f[1]))
                rows.append(i)
                rules.append(best[2] if best else None)
                verdicts.append(best[3] if best else default)
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(n) for n in ("page_id", "host", "path")]
                + [pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``.

    ``rules`` has verdict, host and path.  A rule fits its host and all
    subdomains where the URL's path starts with its path; the longest
    (host and path together) wins.
    """
    host, path = host_and_path()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    dealt = materialize(urls.withColumn("_key", reversed_key(F.col("host")))
                        .repartitionByRange(F.col("_key"), F.col("page_id"), F.col("path"))
                        .withColumn("_part", F.spark_partition_id()))
    ends = dealt.groupBy("_part").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).collect()
    ranges = F.array(*[F.struct(F.lit(r["_part"]).alias("part"), F.lit(r["lo"]).alias("lo"),
                                F.lit(r["hi"]).alias("hi")) for r in ends] or [
        F.struct(F.lit(0).alias("part"), F.lit("").alias("lo"), F.lit("").alias("hi"))])
    keyed = (rules.where("host is not null and path is not null and verdict is not null")
             .select("verdict", "host", "path").distinct()
             .withColumn("_key", reversed_key(F.col("host"))))
    # "/" follows "." directly: all keys with the prefix lie below it.
    beyond = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit("/"))
    placed = keyed.withColumn("_part", F.explode(F.transform(
        F.filter(ranges, lambda r: (r["hi"] >= F.col("_key")) & (r["lo"] < beyond)), lambda r: r["part"])))
    events = dealt.withColumn("verdict", F.lit(None).cast("string")).withColumn("_kind", F.lit(1)).unionByName(
        placed.withColumn("page_id", F.lit(None).cast(urls.schema["page_id"].dataType)).withColumn("_kind", F.lit(0)))
    swept = events.repartition("_part").sortWithinPartitions("_part", "_key", "_kind")
    schema = T.StructType([urls.schema["page_id"]] + [T.StructField(n, T.StringType())
                                                     for n in ("host", "path", "rule", "verdict")])
    return swept.mapInArrow(_sweep(default), schema)


def default_rules(pages: DataFrame) -> DataFrame:
    return pages.sparkSession.createDataFrame(RULES, "verdict string, host string, path string")


ORACLE = rf"""
WITH p AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
                       THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
u AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(verdict, host, path) AS (VALUES {", ".join(map(str, RULES))}),
m AS (SELECT u.page_id, r.verdict, r.host || r.path AS rule, u.host, u.path,
             row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC) AS n
      FROM u JOIN r ON (u.host = r.host OR suffix(u.host, '.' || r.host)) AND prefix(u.path, r.path))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, '{DEFAULT}') AS verdict
FROM u LEFT JOIN m ON u.page_id = m.page_id AND m.n = 1
"""
