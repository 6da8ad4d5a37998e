"""S1-S3: delimited text with BOM, CRLF and a header; parquet fixture views."""

from __future__ import annotations

import tempfile

from conftest import SF001

from entrotree.sources.delimited import read_binned_csv, read_lines_as_fields
from entrotree.sources.fixtures import LI_FEATURES, doc_bins, ev_bins, li_bins


def _write_csv(text: bytes) -> str:
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    path = f"{d}/t.csv"
    with open(path, "wb") as fh:
        fh.write(text)
    return path


HEADER_CSV = "\ufeff0,1,2,class\r\n1,2,3,0\r\n0,0,6,1\r\n4,5,6,1\r\n".encode("utf-8")


def test_header_csv_drops_bom_crlf_header(spark):
    df = read_binned_csv(spark, _write_csv(HEADER_CSV))
    assert df.columns == ["f0", "f1", "f2", "y"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(0, 0, 6, 1), (1, 2, 3, 0), (4, 5, 6, 1)]


def test_text_lines_split_equals_csv(spark):
    path = _write_csv(HEADER_CSV)
    a = read_lines_as_fields(spark, path)
    b = read_binned_csv(spark, path)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_golden_csv_shape(golden):
    assert golden.count() == 569
    hist = {r["y"]: r["count"] for r in golden.groupBy("y").count().collect()}
    assert hist == {0: 357, 1: 212}


def test_fixture_views(spark):
    li = li_bins(spark, SF001)
    assert li.columns == ["k", *LI_FEATURES, "y"]
    bad = li.where(" or ".join(f"{f} < 0 or {f} > 6" for f in LI_FEATURES)).count()
    assert bad == 0
    assert set(doc_bins(spark, SF001).columns) == {"k", "lang", "source", "nb", "y"}
    ev = ev_bins(spark, SF001)
    assert ev.where("f0 < 0 or f0 > 6").count() == 0


def test_scan_is_pruned(spark):
    plan = li_bins(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    # only the eight lineitem columns the view needs are read
    assert "l_extendedprice" not in plan and "l_partkey" not in plan


def test_text_lines_with_other_separator_and_blank_header(spark):
    text = "0| 1 |class\n3|4|1\n|5|0\n".encode()
    got = sorted(map(tuple, read_lines_as_fields(spark, _write_csv(text), sep="|").collect()), key=str)
    assert got == [(3, 4, 1), (None, 5, 0)]
