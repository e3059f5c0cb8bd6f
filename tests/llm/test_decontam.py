import random

import numpy as np

from starflow.llm import decontam, queries

WORDS = [f"w{k}" for k in range(400)] + ["the", "and", "of"] * 60
ITEMS = "item_id long, text string"


def plain_distance(item, text):
    """Least edit distance of the item to any stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != t)))
        row = new
    return min(row)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        k = r.randrange(len(words))
        match r.randrange(3):
            case 0:
                words[k] = r.choice(WORDS)
            case 1:
                del words[k]
            case 2:
                words.insert(k, r.choice(WORDS))
    return words


def found(df):
    return {(r.doc_id, m.item_id): m for r in df.collect() for m in r.matches}


def test_distances_are_those_of_the_plain_recurrence():
    r = random.Random(1)
    for _ in range(200):
        item, text = ([r.randrange(6) for _ in range(r.randint(1, n))] for n in (9, 25))
        assert decontam.edit_distance(np.array(item), np.array(text))[0] == plain_distance(item, text)


def test_matches_are_exact_and_recall_reaches_its_target(frame):
    r = random.Random(2)
    items = [(k, [r.choice(WORDS) for _ in range(r.randint(14, 60))]) for k in range(30)]
    docs, want = [], set()
    for n in range(300):
        item, words = r.choice(items)
        inner = edited(r, words, r.randint(0, len(words) // 5))
        text = [r.choice(WORDS) for _ in range(r.randint(0, 80))] + inner + [r.choice(WORDS) for _ in range(r.randint(0, 80))]
        docs.append((n, " ".join(text)))
        want |= {(n, i) for i, w in items if (i == item or n < 20) and plain_distance(w, text) <= len(w) // 5}
    docs += [(1000 + k, " ".join(r.choice(WORDS) for _ in range(200))) for k in range(50)]
    got = found(decontam.with_matches(frame(docs, "doc_id long, text string"), frame([(k, " ".join(w)) for k, w in items], ITEMS)))
    texts, words = dict(docs), dict(items)
    for (doc, item), m in got.items():
        assert plain_distance(words[item], texts[doc].split()) <= m.distance <= len(words[item]) // 5
    assert len(want & got.keys()) >= 0.95 * len(want)


def test_unchanged_items_are_found_at_every_place(frame):
    item = "Alpha, beta GAMMA delta: epsilon zeta eta theta iota kappa lamda mu"
    docs = [(k, "x " * k + item.lower() + " y" * (9 - k)) for k in range(10)]
    got = found(decontam.with_matches(frame(docs, "doc_id long, text string"), frame([(1, item), (2, item), (3, "mu"), (4, None), (5, "?!")], ITEMS)))
    assert {(d, i) for d, i in got} == {(k, i) for k in range(10) for i in (1, 2, 3)}
    assert all((m.word, m.words, m.distance) == (d, 12, 0) for (d, i), m in got.items() if i < 3)


def test_blocks_nulls_long_texts_empty_tables_and_clashing_names(frame, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 4)
    items = frame([(k, f"one two three four five six seven eight nine item{k}") for k in range(3)], ITEMS, 1)
    schema = "doc_id long, text string, item_id string, matches int"
    long = "z " * 300_000 + "one two three four five six seven eight nine item2 " + "z " * 1000
    docs = [(1, None, "a", 0), (2, "", "a", 0), (3, long, "a", 0), (3, long, "a", 0)]
    made = decontam.with_matches(frame(docs, schema), items)
    assert made.columns == ["doc_id", "text", "item_id", "matches", "_matches"]
    assert sorted((r.doc_id, [(m.item_id, m.distance) for m in r._matches]) for r in made.collect()) == [
        (1, []), (2, []), *[(3, [(0, 1), (1, 1), (2, 0)])] * 2,
    ]
    assert decontam.with_matches(frame([], schema), items).collect() == []
    assert decontam.with_matches(frame(docs, schema), frame([], ITEMS)).count() == 4


def test_query_finds_every_item_that_stands_in_a_text(spark, small):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    assert want and want <= {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, small).collect()}
