"""Line dedup of whole runs and near-dedup from 0.80 on, as stages over the test data."""

import re

import corpus_pipeline
from test_line_dedup_runs import expected
from test_near_dup import brute_force


def test_both_dedup_stages_against_plain_python(spark, small):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    lines = stages["line dedup"](spark, docs, small)
    want = {i: t for i, t, n, gone in expected(rows, 40) if not gone or re.search(r"\S", t)}
    assert {r.doc_id: r.text for r in lines.collect()} == want and lines.columns == docs.columns
    near = stages["minhash near-dedup"](spark, lines, small)
    assert {r.doc_id for r in near.collect()} == {i for i, (_, _, stays) in brute_force(list(want.items()), 80).items() if stays}
