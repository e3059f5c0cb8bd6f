import zlib

import numpy as np
import pyarrow as pa

from starflow.llm import quality, queries
from starflow.llm.common import texts_of


def test_forward_backward_against_all_labellings():
    r = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        evidence, good, bad = r.normal(size=n), *r.normal(size=2)
        weight = np.zeros(n)
        total = 0.0
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            score = sum(e for e, v in zip(evidence, y) if v) + sum(good if a else bad for a, b in zip(y, y[1:]) if a == b)
            total += np.exp(score)
            weight += np.exp(score) * np.array(y)
        first = np.array([0, n])
        ahead, behind = quality.forward_backward(evidence, first, good, bad)
        assert np.allclose(1 / (1 + np.exp(-ahead - behind)), weight / total)


def test_scores_do_not_depend_on_the_batch():
    r = np.random.default_rng(2)
    texts = ["", None, "\n \n", "one line", "a\nb c\n\nd!!", "x " * 5000, "\n".join(f"line {k} é" for k in range(300))]
    x, _, first = quality.line_features(*texts_of(pa.array(texts)))
    assert np.diff(first).tolist() == [1, 1, 1, 1, 3, 1, 300]
    model = {"mean": x.mean(axis=0), "spread": x.std(axis=0) + 1, "weights": r.normal(size=3 * quality.FEATURES + 1), "stay": np.array([0.5, 1.0])}
    whole = quality.text_scores(model, *texts_of(pa.array(texts)))
    alone = [quality.text_scores(model, *texts_of(pa.array([t], pa.string())))[0] for t in texts]
    assert np.allclose(whole, alone) and ((whole >= 0) & (whole <= 1)).all()


def test_nulls_one_class_empty_tables_and_clashing_names(frame):
    schema, labels = "doc_id long, text string, score int", "doc_id long, quality int"
    docs = frame([(1, None, 0), (2, "", 0), (2, "a b", 0), (None, "a", 0)], schema)
    for known in ([], [(1, 1), (2, 1)], [(1, None), (None, 1), (99, 0)]):
        model = quality.train(docs, frame(known, labels))
        made = quality.scored(docs, model)
        assert made.columns == ["doc_id", "text", "score", "_score"] and all(0 <= r._score <= 1 for r in made.collect())
    assert quality.scored(frame([], schema), model).collect() == []


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op7_quality(spark, data).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    known = [(rows[k].predicted, y) for k, y in labels.items() if k in rows and rows[k].held_out]
    assert len(known) > 50 and np.mean([p == y for p, y in known]) > 0.95


def test_the_fit_takes_one_row_of_an_id_and_some_stretches_of_a_long_text(frame, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "fit", lambda x, first, y: taken.append((len(x), np.diff(first).max(), len(y))) or {})
    long = "\n".join(f"line {k}" for k in range(5000))
    docs = frame([(1, long)] + [(2, f"some text {k % 3}") for k in range(500)] + [(3, None)], "doc_id long, text string")
    quality.train(docs, frame([(1, 1), (2, 0), (3, 0), (5, 1)], "doc_id long, quality int"))
    (lines, longest, stretches), = taken
    assert lines <= quality.MOST_STRETCHES * quality.STRETCH + 2
    assert longest <= quality.STRETCH and stretches <= quality.MOST_STRETCHES + 2


def test_slices_are_bounded_in_bytes():
    from starflow.llm.common import text_slices

    texts = pa.array(["a" * n for n in (5, 5, 0, 30, 1, 1, 12)] + [None, "é" * 6])
    assert list(text_slices(texts, most=12, rows=3)) == [(0, 3), (3, 4), (4, 6), (6, 8), (8, 9)]
    assert list(text_slices(texts.slice(3, 3), most=12)) == [(0, 1), (1, 3)] and list(text_slices(texts.slice(0, 0))) == []
