"""Whole repeated runs, against all runs of all texts."""

import hashlib

import pytest
from test_line_dedup import corpus, got, words_of

from starflow.llm import line_dedup, queries


def expected(docs, words):
    """Lines inside any run of that many words that equals an earlier one."""
    seen, gone = set(), {}
    distinct = sorted({(i, t) for i, t in docs if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    for doc, text in distinct:
        lines = [(k, line.strip(line_dedup.EDGES)) for k, line in enumerate(text.split("\n"))]
        lines = [(k, line) for k, line in lines if line]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += words_of(lines[b][1])
                key = hashlib.sha256("\n".join(x for _, x in lines[a : b + 1]).encode()).digest()
                if total >= words and key in seen:
                    gone.setdefault((doc, text), set()).update(range(lines[a][0], lines[b][0] + 1))
                elif total >= words:
                    seen.add(key)
    out = []
    for doc, text in docs:
        drop = gone.get((doc, text), set())
        lines = [] if text is None else text.split("\n")
        out.append((doc, None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in drop), len(lines), len(drop)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("words", [1, 5, 12])
def test_it_deletes_every_run_that_stood_earlier(frame, seed, words):
    docs = corpus(seed)
    assert got(line_dedup.without_repeats(frame(docs, "doc_id long, text string"), words=words, grow=True)) == expected(docs, words)


def test_the_last_lines_of_a_run_go_too(frame):
    line = lambda n, c: " ".join([c] * n)
    one, two = f"{line(60, 'a')}\n\n{line(20, 'b')}", "\n".join((line(38, "c"), line(5, "d"), line(20, "e")))
    other = f"{line(60, 'a')}\nz"  # the earliest place of the 60 words has other lines after them
    docs = [(1, other), (2, one), (3, f"x\n{one}\ny"), (4, two), (5, two), (6, one), (None, "q")]
    made = got(line_dedup.without_repeats(frame(docs, "doc_id long, text string"), grow=True))
    assert made == expected(docs, 40)
    assert {i: t for i, t, _, _ in made if i in (3, 5, 6)} == {3: "x\ny", 5: "", 6: ""}


def test_the_query_deletes_every_run_of_the_test_data(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, gone, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n, gone in expected(docs, 40)}
    assert {tuple(r[k] for k in ("doc_id", "n_lines", "n_removed", "kept_sha256")) for r in queries.op1_line_dedup(spark, small).collect()} == want
