"""The pipeline on a small table: stages in order, decisions in effect."""

from __future__ import annotations

import os

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from occulink.llm.common import stage, table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_stages(spark):
    first = docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    ids: list[set] = []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), f"test-{name}")
        ids.append({r[0] for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == columns and docs.schema == first.schema
            assert docs.count() <= before
            before = docs.count()
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and ids[1] == ids[2] and ids[3] == ids[4]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "line_dedup", "near_duplicates", "packing"]


CLASHING = ["score", "row", "__row", "__score", "__gone", "removed_chunks", "removed_chars", "block", "spans", "group_id", "kept", "other_0", "a b"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_odd_rows(spark):
    schema = "doc_id long, text string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHING)
    passage = " ".join(f"word{i} of the passage." for i in range(30))
    texts = [None, "", " \n ", "one", "one", f"Alone here. {passage} And an end.", f"Another start.\n{passage}\nNothing more.", "long " * 40_000, None, ""]
    rows = [(i, t, len(t or ""), *[f"{c}-{i}" for c in CLASHING]) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id at all", 12, *[None] * len(CLASHING)), (None,) * (3 + len(CLASHING))]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, function in corpus_pipeline.STAGES:
            out = stage(function(spark, docs, SF), f"test-odd-{name}")
            if name == "packing":
                assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in given}
                continue
            assert out.columns == docs.columns and out.schema == docs.schema
            found = out.collect()
            for r in found:  # the columns stay with their document
                assert all(r[c] == (None if r["doc_id"] is None else f"{c}-{r['doc_id']}") for c in CLASHING)
                assert r["n_chars"] in (len(r["text"] or ""), None)
            if name == "line_dedup":
                assert len(found) == len(given)
                assert sum(passage in (r["text"] or "") for r in found) == bool(given)
            if name == "near_duplicates":
                kept = [r["text"] or "" for r in found]
                assert kept.count("one") == bool(given) and len(kept) < max(len(given), 1)
