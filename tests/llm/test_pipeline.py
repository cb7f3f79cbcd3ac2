"""The stages of the pipeline on the smallest tables, each held against what it should do to its own input."""

import hashlib

import corpus_pipeline as cp
from termtide.llm import decontaminate as dc

from .test_ngram_join import brute as all_pairs
from .test_suffix import brute as all_windows


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        before, columns = [tuple(r) for r in docs.select("doc_id", "text").collect()], docs.columns
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        kept[name] = len(after)
        if name == "toxicity":
            clean = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0").collect()}
            assert len(after) < len(before) and clean <= set(after)
        if name == "near_duplicates":
            assert sorted(after) == sorted({c if n else d for d, n, c in all_pairs(before, 5, 80)})
        if name == "repeated_passages":
            for doc, _, removed, _, digest in all_windows(before):
                if "�" not in after[doc].text:
                    assert hashlib.sha256(after[doc].text.encode()).hexdigest() == digest
                assert removed or after[doc].text == dict(before)[doc]
        if name == "contamination":
            items = [dc.normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert not any(item in dc.normal(r.text) for r in after.values() for item in items)
            assert len(before) - len(after) < 0.2 * len(before)
        if name == "encoding":
            assert len(after) == len(before) and all(r.round_trip for r in after.values())
    assert kept["encoding"] > 100


def test_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, sf).collect() == []


def test_odd_rows_and_clashing_names(spark, sf):
    """Columns named like the operators' own pass through; nulls and repeated rows are rows like any other."""
    names = ("score", "predicted", "toxic_score", "n_shingles", "component_id", "kept", "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256", "label", "node")
    clean = "a plain text on rivers, hills and the weather of the year %d, with some words more"
    rows = [(1, clean % 1), (2, None), (None, "gardens and kitchens " + clean % 2), (3, ""), (4, "short"), (4, "short"), (5, clean % 1), (6, "trees " * 30_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1] or ""), *[f"own {n}" for n in names]) for r in rows], schema)
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, sf)
        got = out.collect()
        if k < 4:
            assert out.columns == docs.columns
        assert all(r[n] == f"own {n}" for r in got for n in names)
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in got)
        want = [(False, i) for i in ((1, 2, 3, 4, 4, 6) if name == "near_duplicates" else (1, 2, 3, 4, 4, 5, 6))] + [(True, 0)]
        assert ids == want, name
