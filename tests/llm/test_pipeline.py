"""The pipeline against brute force, stage by stage, and on awkward rows."""

import numpy as np
from tables import TEST_DIR, awkward, empty
from test_duplicates import exact_brute, near_brute
from test_tokens import BYTES, check_packing, library

import corpus_pipeline
from lintel.llm import pii, quality


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{TEST_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{TEST_DIR}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    assert 0 < len(good) < len(texts)
    left = [(i, t) for i, t in texts.items() if i in good]
    kept = {r[0] for r in exact_brute(left) if r[3]}
    left = [(i, t) for i, t in left if i in kept]
    near = {r[2] for r in near_brute(left)}
    left = {i: pii.masked(t or "") for i, t in left if i in near}
    rows = corpus_pipeline.run(spark, TEST_DIR).collect()
    by_doc, _ = check_packing(rows, 1024)
    made = library(BYTES)
    assert set(by_doc) == set(left)
    for i, parts in by_doc.items():
        ids = [x for p in sorted(parts, key=lambda p: p.piece) for x in p.ids]
        assert np.array_equal(ids, made.encode(left[i], add_special_tokens=False).ids + [2])


def test_every_stage_takes_awkward_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        docs = awkward(spark, "score", "key", "item", "fp")
        out = stage(spark, docs, TEST_DIR)
        assert out.count() > 0 or name == "quality"
        nothing = stage(spark, empty(spark), TEST_DIR)
        assert nothing.count() == 0
        if name != "packing":
            assert out.columns == docs.columns and nothing.columns == empty(spark).columns
