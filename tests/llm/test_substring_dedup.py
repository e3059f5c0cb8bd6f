import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import differences
from starflow.llm import queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(docs, window):
    """(id, kept text, words, words removed) by row."""
    least = {}
    for i, text in docs:
        words = WORD.findall(text or "")
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if i is not None:
                least[key] = min(i, least.get(key, i))
    out = []
    for i, text in docs:
        words, gone = WORD.findall(text or ""), set()
        for k in range(len(words) - window + 1):
            if i is not None and least[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, None if text is None else kept, len(words), len(gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in df.collect()), key=str)


def corpus(seed, n=60, alphabet="abcdefgh"):
    r = random.Random(seed)
    blank = lambda: r.choice([" ", "  ", "\n", "\t \r\n", "\v", "\f"])
    docs = []
    for k in range(n):
        words = [r.choice(alphabet) * r.randint(1, 2) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            if docs:
                other = WORD.findall(r.choice(docs)[1])
                s = r.randrange(len(other) + 1)
                at = r.randrange(len(words) + 1)
                words[at:at] = other[s : s + r.randint(3, 30)]
        docs.append((r.randrange(10 * n), r.choice(["", " ", "\n"]) + "".join(w + blank() for w in words)))
    return docs


@pytest.mark.parametrize("period", range(1, 40))
def test_covers(period):
    places = substring_dedup.cover(period)
    assert {(a - b) % period for a in places for b in places} == set(range(period))
    if period == 7:
        assert places == [0, 1, 3]


def test_three_of_seven_windows_are_hashed():
    assert substring_dedup.shape(13) == (7, 7, [0, 1, 3])


@pytest.mark.parametrize("window", [1, 2, 3, 8, 13, 20])
@pytest.mark.parametrize("seed", range(3))
def test_it_removes_what_brute_force_removes(frame, seed, window):
    docs = corpus(seed)
    assert got(substring_dedup.without_repeats(frame(docs, "doc_id long, text string"), window=window)) == brute_force(docs, window)


@pytest.mark.parametrize("shift", range(14))
def test_a_passage_at_every_shift(frame, shift):
    passage = " ".join(f"w{k}" for k in range(13))
    docs = [(1, f"x y {passage} z"), (2, "q " * shift + passage), (3, "p " * (20 - shift) + passage + " end")]
    found = {r.doc_id: r.n_removed for r in substring_dedup.without_repeats(frame(docs, "doc_id long, text string")).collect()}
    assert found == {1: 0, 2: 13, 3: 13}


def test_small_batches_and_many_buckets_give_the_same(frame, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET", 300)
    monkeypatch.setattr(substring_dedup, "PART", 200)
    monkeypatch.setattr(substring_dedup, "TOGETHER", 100)
    docs = corpus(9, 120)
    assert got(substring_dedup.without_repeats(frame(docs, "doc_id long, text string", 5))) == brute_force(docs, 13)


def test_nulls_repeats_ties_and_characters(frame):
    one = " ".join(f"word{k}" for k in range(20))
    docs = [(5, one), (5, one), (5, one + " more"), (7, one), (None, one), (None, None), (8, None), (9, ""), (10, " \n\t"), (11, "short text"), (-3, "b " + one)]
    docs += [(20, "é ü " * 15), (21, "é ü\n" * 15), (22, "\x1c" * 3 + " é " * 2), (23, one.upper()), (24, one + "\x00 "), (25, one + " " + one)]
    assert got(substring_dedup.without_repeats(frame(docs, "doc_id long, text string"))) == brute_force(docs, 13)


def test_a_hot_passage_and_a_very_long_text(frame):
    passage = " ".join(f"p{k}" for k in range(25))
    docs = [(k, f"own{k} {passage} {k} end{k}") for k in range(600)]
    docs += [(700, " ".join(f"t{k % 9000}" for k in range(60_000))), (701, " ".join(f"t{k}" for k in range(4000, 9000))), (702, "same " * 50_000), (703, "same " * 20)]
    assert got(substring_dedup.without_repeats(frame(docs, "doc_id long, text string", 8))) == brute_force(docs, 13)


def test_empty_table_and_clashing_names(frame):
    schema = "doc_id long, text string, n_words string, id long, at int, hash int, made int"
    assert substring_dedup.without_repeats(frame([], schema)).collect() == []
    one = " ".join("abcdefghijklmnop")
    made = substring_dedup.without_repeats(frame([(1, one, "x", 9, 8, 7, 6), (2, one, "x", 9, 8, 7, 6)], schema))
    assert made.columns == ["doc_id", "text", "n_words", "id", "at", "hash", "made", "_n_words", "n_removed"]
    assert sorted(map(tuple, made.collect())) == [(1, one, "x", 9, 8, 7, 6, 16, 0), (2, "", "x", 9, 8, 7, 6, 16, 16)]
    dotted = frame([(1, one, "x"), (2, one, "y")], "doc_id long, text string, `a.b` string")
    assert {r["n_removed"] for r in substring_dedup.without_repeats(dotted).collect()} == {0, 16}


def test_query_against_brute_force_and_sql(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    made = queries.op11_substring_dedup(spark, small)
    want = [(i, n, gone, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n, gone in brute_force(docs, 13)]
    assert sorted(map(tuple, made.collect()), key=str) == sorted(want, key=str)
    assert made.agg(F.sum("n_removed")).first()[0] > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert differences(made, con, queries.ORACLES["op11_substring_dedup"]) == []
