import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starflow.llm import bpe, queries

PATH = queries.tokenizer("byte_bpe_50k.json")
REAL = Tokenizer.from_file(PATH)
with open(PATH, "rb") as _f:
    RAW = _f.read()
OWN, READER = bpe.loaded(RAW), bpe.loaded(RAW, bpe.Reader)

TEXTS = [None, "", " ", "  \n\t ", "a", "Hello world's don't we'LL 123abc", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endof", "é😀    x", "\x85\x1c\x1d a᠎ b", "aaaa" * 500, "=" * 999 + " " * 999 + "x", "的的的的 ﷽", "‍﻿\x00\x01"]


def real(text):
    return REAL.encode(text or "", add_special_tokens=False).ids


def test_texts_are_encoded_as_the_library_does(frame):
    df = bpe.decode(bpe.encode(frame(list(enumerate(TEXTS)), "k int, text string"), PATH), PATH)
    for r in df.collect():
        assert r.ids == real(TEXTS[r.k]), r.k
        assert r.decoded == REAL.decode(r.ids, skip_special_tokens=False) == (TEXTS[r.k] or "")


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abcdehinorst ", max_size=120), st.text(alphabet=" \n\t'sx1é<|endoftext|>", max_size=60)))
def test_random_texts(text):
    ids = OWN.encode(text).tolist()
    assert ids == real(text)
    assert READER.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_decoding_of_any_ids(ids):
    assert READER.decode(ids) == REAL.decode(ids, skip_special_tokens=False)


def test_the_tables_are_cut(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 3)
    for k in range(20):
        texts = [f"one two {k} three four five {k * 7} one two", " odd  space one", f"{k}"]
        assert [x.tolist() for x in OWN.encode_all(texts)] == [real(t) for t in texts]
    OWN.fresh()


def test_a_very_long_text():
    text = "The quick brown fox, it's 12 o'clock.\n" * 30_000
    assert OWN.encode(text).tolist() == real(text)


def test_null_ids_empty_table_and_clashing_names(frame):
    rows = frame([(1, None), (2, [])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(rows, PATH).collect()} == {1: None, 2: ""}
    schema = "doc_id long, text string, ids string, decoded int"
    made = bpe.encode(frame([], schema), PATH)
    assert made.columns == ["doc_id", "text", "ids", "decoded", "_ids"] and made.collect() == []


def test_query_over_the_test_data(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op10_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = real(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(REAL.decode(ids, skip_special_tokens=False))


def test_small_tables_give_the_same_ids(frame):
    path = queries.tokenizer("byte_bpe_50k.json")
    rows = [(k, " ".join(f"word{j * k % 97}" for j in range(60))) for k in range(80)]
    df = frame(rows, "doc_id long, text string")
    one, two = (sorted((r.doc_id, r.ids, r.decoded) for r in bpe.round_trip(df, path, words=n).collect()) for n in (4, 10**6))
    assert one == two and all(d == dict(rows)[k] for k, _, d in one)
