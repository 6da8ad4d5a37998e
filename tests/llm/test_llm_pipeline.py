from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline as cp  # noqa: E402
from entrotree.llm import decontaminate, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(cp.STAGES)


def test_stage_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scans",
                                         "source_mix"]


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in cp.STAGES[:-1]:
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id: r for r in docs.collect()}
        if name == "quality_rules":
            for r in before:
                failed = brute.rule_counts(r.text)[-1]
                assert not (failed and r.doc_id in after)
                assert failed or labels.get(r.doc_id) != 1 or r.doc_id in after  # clean documents stay
        if name == "near_duplicates":
            fps = {r.doc_id: simhash.fingerprint((r.text or "").encode()) % (1 << 64) for r in before}
            root = {d: d for d in fps}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for a in fps:
                for b in fps:
                    if a < b and bin(fps[a] ^ fps[b]).count("1") <= 3:
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
            assert set(after) == {find(d) for d in fps}
        if name == "decontamination":
            exact = {r.doc_id for r in before for _, t in items
                     if " ".join(decontaminate.tokens(t)) in " ".join(decontaminate.tokens(r.text))}
            assert not exact & set(after)
            assert len(after) >= 0.7 * (len(before) - len(exact))
        if name == "secret_scans":
            assert set(after) == {r.doc_id for r in before}
            changed = [r for r in before if after[r.doc_id].text != r.text]
            assert all("[SECRET]" in after[r.doc_id].text for r in changed)
            assert all(after[r.doc_id].n_chars == len(after[r.doc_id].text) for r in changed)
    mixed = STAGES["source_mix"](spark, docs, SF).collect()
    assert sum(r["size"] for r in mixed) == sum(len(brute.words(r.text)) for r in docs.collect())
    whole = cp.run(spark, SF).collect()
    assert sorted(map(str, whole)) == sorted(map(str, mixed))


def test_odd_tables_go_through_every_stage(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, None, None, None, None), (1, text, "en", None, 5), (1, text, "en", None, 5), (None, text, None, "s", None),
            (2, "", "en", "s", 0), (3, text + " password=hunter2222", "en", "s", 9), (4, "w " * 30_000, "en", "s", 1)]
    extra = [f"'x' AS {c}" for c in ("score", "kept", "found", "base", "_row", "component_id")]
    for table in (rows, []):
        docs = spark.createDataFrame(table, DOCS).selectExpr("*", *extra)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert name == "source_mix" or out.columns == docs.columns
            out.collect()
