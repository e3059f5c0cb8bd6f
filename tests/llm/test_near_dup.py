import random

import numpy as np

from starflow.llm import near_dup, queries
from starflow.llm.components import components
from starflow.llm.common import Scratch


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(docs, percent=85):
    sets = {i: shingles(t) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def family(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(1, 5)))
    docs, origin = [], [word() for _ in range(150)]
    for k in range(n):
        kind = r.random()
        if kind < 0.5:  # near copies of one text, most not similar to each other
            w = list(origin)
            for _ in range(r.randint(0, 8)):
                w[r.randrange(len(w))] = word()
        elif kind < 0.7 and docs:
            w = r.choice(docs)[1].split()
            if r.random() < 0.5 and w:
                w[-1] = word()
        else:
            w = [word() for _ in range(r.choice([0, 1, 3, 5, 9, 14, 40, 300]))]
        docs.append((k * 3 + 1, " ".join(w)))
    return docs


def test_components_are_those_of_all_pairs(frame):
    for seed in range(4):
        docs = family(seed)
        assert got(near_dup.near_duplicates(frame(docs, "doc_id long, text string"))) == brute_force(docs), seed


def test_short_texts_case_white_space_and_nulls(frame):
    docs = [(1, "A b"), (2, "a\tB "), (3, "É"), (4, "é"), (5, ""), (6, None), (7, "  "), (8, "a b c d e f"), (9, "a b c d e f g"), (10, "a b c d e")]
    docs += [(20, "p q r s t u v w x y z 1 2 3 4"), (21, "P q r s t u v w x y z 1 2 3 4")]
    assert got(near_dup.near_duplicates(frame(docs, "doc_id long, text string"))) == brute_force(docs)


def test_null_ids_and_repeated_rows(frame):
    made = near_dup.near_duplicates(frame([(None, "a b c"), (2, "a b c"), (2, "a b c"), (3, "a b c")], "doc_id long, text string"))
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in made.collect()) == [("2", 2, True), ("2", 2, True), ("3", 2, False), ("None", None, True)]


def test_empty_table_and_clashing_names(frame):
    schema = "doc_id long, text string, id long, n long, rep string, bands int"
    assert near_dup.near_duplicates(frame([], schema)).collect() == []
    assert got(near_dup.near_duplicates(frame([(5, "a b", 1, 2, "x", 3)], schema))) == {5: (1, 5, True)}


def test_registers_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = [t for _, t in family(1)]
    from starflow.llm.common import texts_of

    whole = near_dup.registers(*near_dup.shingle_sets(*texts_of(pa.array(texts))))
    for k in (0, 7, 50):
        alone = near_dup.registers(*near_dup.shingle_sets(*texts_of(pa.array(texts[k : k + 1]))))
        assert np.array_equal(alone[0][0], whole[0][k])
        assert np.array_equal(near_dup.borrow(*alone)[0], near_dup.borrow(*whole)[k])


def test_estimates_are_corrected_for_collisions():
    r = np.random.default_rng(1)
    errors = []
    for jaccard in (0.5, 0.7, 0.85, 0.95):
        for _ in range(30):
            n = 4000
            union = np.unique(r.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            both = int(jaccard * len(union))
            a, b = np.sort(union), np.sort(union[r.permutation(len(union))[:both]])
            regs = near_dup.registers(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            four = near_dup.four_bits(*regs)
            p = (four[0] == four[1]).mean()
            errors.append((p - near_dup.COLLISION) / (1 - near_dup.COLLISION) - both / len(union))
    assert abs(np.mean(errors)) < 0.02


def test_components_of_chains_and_stars(spark, frame):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 150)] + [(200, 200)]
    random.Random(3).shuffle(links)
    found = {r.node: r.root for r in components(frame(links, "u long, v long"), Scratch(spark)).collect()}
    assert all(found[k] == 1 for k in range(2, 61)) and all(found[k] == 100 for k in range(101, 150))
    assert 200 not in found


def test_query_over_the_test_data(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op8_minhash_near_dedup(spark, small)) == brute_force(docs)
