"""The pipeline on a small table against plain versions of its stages, and queries beside DuckDB."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from starling.llm.queries import ORACLES, QUERIES
from tests import oracle
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_beside_duckdb(spark, name):
    ok, text = oracle.compare(spark, oracle.connect(SF), SF, name, QUERIES[name], ORACLES[name])
    assert ok, text


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline_against_plain_stages(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in QUERIES["op7_quality_rules"](spark, SF).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in given.collect() if r.doc_id in kept}
    groups = brute.jaccard_components(texts, 5, 80, 100)
    texts = {d: t for d, t in texts.items() if groups[d][2] == d}
    rows = sorted(texts.items())
    cut = {
        d: (joined if gone else t)
        for (d, t), (_, gone, joined) in zip(rows, brute.substring_dedup(rows, 13), strict=True)
    }
    hits = brute.decontaminate(sorted(cut.items()), bench, 10)
    want = {d: t for (d, t), hit in zip(sorted(cut.items()), hits, strict=True) if hit[1] == 0}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(want) and len(got) == len(want)
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got)
    docs, stages = given, corpus_pipeline.STAGES
    for _, stage in stages[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == given.columns
    assert {r.doc_id: r.text for r in docs.collect()} == want
