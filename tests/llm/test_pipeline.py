"""The pipeline against plain versions of its stages on the smallest driver tables."""

import re

import pytest
from plain import components_of, tokens

import __spark_entry__ as E

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_and_whole_run(spark, model_file):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    quiet = stage["toxicity"](spark, docs, SF)
    assert quiet.columns == docs.columns
    lines = stage["line_dedup"](spark, quiet, SF)
    assert lines.columns == docs.columns and lines.filter("n_chars != length(text)").count() == 0
    one = stage["near_dedup"](spark, lines, SF)
    want, _ = components_of([(r.doc_id, r.text) for r in lines.collect()], 5)
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for c in want.values()})
    clean = stage["decontaminate"](spark, one, SF)
    windows = {tuple(w[i:i + 10]) for w in map(tokens, bench) if w for i in range(max(len(w) - 9, 1))}
    sizes = {len(w) for w in windows}
    keep = []
    for r in one.collect():
        w = tokens(r.text)
        if not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            keep.append(r.doc_id)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(keep)
    ids = {r.doc_id: r.ids for r in stage["sentencepiece"](spark, clean, SF).collect()}
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=model_file)
    assert ids == {r.doc_id: library.encode(r.text) for r in clean.collect()}
    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == ids


def test_registered():
    assert "pipeline" in E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in E.queries() if re.match(r"op\d+_", n)) == list(range(1, 14))
