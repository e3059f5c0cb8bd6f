import random

import pytest
from pyspark.sql import functions as F

from starflow.llm import line_dedup


def words_of(line):
    line = line.strip(line_dedup.EDGES)
    return line.count(" ") + 1 if line else 0


def brute_force(docs, words):
    """For each row: the line numbers that lie in a window that stood earlier."""
    seen, gone = {}, {}
    distinct = sorted({(i, t) for i, t in docs if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    windows = []
    for doc, text in distinct:
        lines = [(k, line.strip(line_dedup.EDGES)) for k, line in enumerate(text.split("\n"))]
        lines = [(k, line) for k, line in lines if line]
        for a in range(len(lines)):
            total, b = 0, a
            while b < len(lines) and total < words:
                total += words_of(lines[b][1])
                b += 1
            if total >= words:
                windows.append((doc, text, lines[a][0], lines[b - 1][0], tuple(x for _, x in lines[a:b])))
    for doc, text, first, last, key in windows:
        if key in seen:
            gone.setdefault((doc, text), set()).update(range(first, last + 1))
        else:
            seen[key] = True
    return gone


def expected(docs, words):
    gone, out = brute_force(docs, words), []
    for doc, text in docs:
        drop = gone.get((doc, text), set())
        lines = [] if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in drop)
        out.append((doc, kept, len(lines), len(drop)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in df.collect()), key=str)


def corpus(seed, n=40):
    r = random.Random(seed)
    pool = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(30)]
    docs = []
    for k in range(n):
        lines = [r.choice([*pool, "", "  "]) for _ in range(r.randint(0, 12))]
        if docs and r.random() < 0.5:
            other = r.choice(docs)[1].split("\n")
            s = r.randrange(len(other))
            lines[2:2] = other[s : s + r.randint(1, 8)]
        docs.append((k, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("words", [1, 5, 12])
def test_it_deletes_what_brute_force_deletes(frame, seed, words):
    docs = corpus(seed)
    df = frame(docs, "doc_id long, text string")
    assert got(line_dedup.without_repeats(df, words=words)) == expected(docs, words)


def test_copies_ties_nulls_and_repeats_inside_a_text(frame):
    one = "a b c\nd e f\n\ng h i"
    docs = [(1, one), (2, one), (3, f"x y z\n{one}\n"), (4, None), (5, ""), (6, "q q\n" * 9), (7, one), (7, one), (None, one)]
    df = frame(docs, "doc_id long, text string")
    assert got(line_dedup.without_repeats(df, words=6)) == expected(docs, 6)


def test_a_hot_line_and_a_very_long_text(frame):
    docs = [(k, f"the same passage again and again\nown {k}") for k in range(300)]
    docs.append((300, "\n".join(f"line {k % 700} of many" for k in range(3000))))
    df = frame(docs, "doc_id long, text string", 8)
    assert got(line_dedup.without_repeats(df, words=6)) == expected(docs, 6)


def test_empty_table_and_clashing_names(frame):
    schema = "doc_id long, text string, n_lines string, id long, lines int, pos int"
    assert line_dedup.without_repeats(frame([], schema)).collect() == []
    made = line_dedup.without_repeats(frame([(1, "a b", "x", 9, 8, 7)], schema), words=1)
    assert made.columns == ["doc_id", "text", "n_lines", "id", "lines", "pos", "_n_lines", "n_removed"]
    assert tuple(made.first()) == (1, "a b", "x", 9, 8, 7, 1, 0)


def test_names_of_its_own_and_dotted_names(frame):
    schema = "doc_id long, text string, __id int, __hash int, __runs int, own_id int, own_runs string, `a.b` int"
    made = line_dedup.without_repeats(frame([(1, "a b c", 1, 2, 3, 4, "r", 5), (2, "a b c", 1, 2, 3, 4, "r", 5)], schema), words=2)
    assert sorted(tuple(r) for r in made.collect()) == [(1, "a b c", 1, 2, 3, 4, "r", 5, 1, 0), (2, "", 1, 2, 3, 4, "r", 5, 1, 1)]


def test_every_document_of_the_test_data(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    df = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    made = line_dedup.without_repeats(df)
    assert got(made) == expected(docs, 40)
    assert made.agg(F.sum("n_removed")).first()[0] > 0
