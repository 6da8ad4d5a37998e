from __future__ import annotations

import uuid
from pyspark.sql import functions as F
from entrotree.runtime import checkpoint_dir

import base64
import hashlib
import random
import tempfile

import pytest

from entrotree.llm import urls, warc

PAGES = "page_id long, url string, html string"


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def page_rows():
    r = random.Random(6)
    rows = [(9, "http://a\r\nX-Page-Id: 7", "same"), (3, None, "same"), (3, None, "same"), (4, "u", None),
            (5, "u", ""), (None, "n", "only null"), (None, "n", "only null"), (None, "m", "same"),
            (6, "long", "é𝒳" * 200_000)]
    return rows + [(100 + i, f"u{i}", r.choice(["a", "b", "c\r\n\r\nd"])) for i in range(40)]


def test_archive_round_trip_equals_brute_force(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).withColumnRenamed("x", "digest")
    path = tempfile.mkdtemp(dir="/tmp") + "/w"
    got = warc.round_trip(pages, path).collect()
    assert len(got) == len(rows)
    smallest, left = {}, {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None:
            smallest[b] = min(p, smallest.get(b, p))
        left[b] = left.get(b, 0) + 1
    by_sha = {sha(b): b for b in left}
    responses = [g for g in got if g.record_type == "response"]
    assert sorted(g.payload_digest for g in responses) == sorted(by_sha)
    for g in got:
        b = by_sha[g.payload_digest]
        assert g.payload_bytes == len(b)
        if g.record_type == "response":
            assert g.page_id == smallest.get(b) and g.refers_to is None
        else:
            assert g.refers_to == smallest.get(b)
    assert sorted(str(g.page_id) for g in got) == sorted(str(p) for p, _, _ in rows)
    assert spark.read.parquet(f"{path}/payloads").count() == len(by_sha)
    for rec in warc.read_records(spark, path).collect():
        head, rest = bytes(rec.record).split(b"\r\n\r\n", 1)
        assert head.decode() + "\r\n\r\n" == rec.header
        n = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
        assert rest == (bytes(rec.payload) if n else b"") + b"\r\n\r\n"


def test_archive_small_payloads_empty_table_and_damage(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abc"), (4, "x", "abc")], PAGES)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages, min_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    assert warc.round_trip(pages.limit(0)).count() == 0
    path = tempfile.mkdtemp(dir="/tmp") + "/w"
    warc.write_archive(pages, path)
    spark.createDataFrame([("0" * 64, b"x")], "digest string, payload binary").write.mode("append").parquet(
        f"{path}/payloads")
    spark.createDataFrame([("0" * 64, "WARC/1.1\r\n\r\n")], "digest string, header string").write.mode(
        "append").parquet(f"{path}/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_records(spark, path).collect()


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_rules_equal_brute_force(spark):
    r = random.Random(7)
    labels = ["com", "org", "example", "a", "b", "É", "", "a-b", "a/b"]
    rules = urls.RULES + [(r.choice(["allow", "block"]), ".".join(r.choice(labels[:6]) for _ in range(r.randint(1, 4))),
                           r.choice(["", "/", "/en", "/en/1", "/é"])) for _ in range(60)]
    rows = [(1, None), (1, "no scheme"), (None, "http://org"), (2, "://"), (3, "http://ORG/?x#y"), (4, "a://org?/es"),
            (5, "x://" + "a." * 3000 + "org/" + "p" * 40_000), (2, "://")]
    for i in range(500):
        host = ".".join(r.choice(labels) for _ in range(r.randint(0, 5)))
        rows.append((i, f"http://{host}{r.choice(['', '/', '/en/1x', '/es/1', '/fr/', '?q=/es/', '#/de/', '/é/x'])}"))
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "url AS host", "url AS _part")
    table = spark.createDataFrame(rules + rules[:3] + [(None, None, None)], "verdict string, host string, path string")
    got = [tuple(x) for x in urls.judge(pages, table).collect()]
    assert sorted(map(str, got)) == sorted(str((p, *plain(u, rules))) for p, u in rows)
    assert urls.judge(pages.limit(0), table).count() == 0
    assert urls.judge(pages, table.limit(0)).where("verdict <> 'allow' or rule is not null").count() == 0


def test_records_are_read_and_checked(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>ee"), (2, "http://é/", "<p>ee"), (3, None, None)],
                                  "page_id long, url string, html string")
    path = f"{checkpoint_dir(spark)}/warc-test-{uuid.uuid4().hex}"
    warc.write_archive(pages, path)
    records = warc.read_records(spark, path)
    assert sorted(r.payload_bytes for r in warc.parsed(records).collect()) == [0, 5, 5]
    for record in (F.concat(F.substring("record", 1, F.octet_length("record") - 5), F.lit(b"?\r\n\r\n")),
                   F.encode(F.replace(F.decode("record", "UTF-8"), F.lit("sha1:"), F.lit("sha1:A")), "UTF-8")):
        with pytest.raises(Exception, match="does not match its header"):
            warc.parsed(records.withColumn("record", record)).collect()
