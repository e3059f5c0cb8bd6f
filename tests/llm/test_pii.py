import hashlib
import re
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starflow.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def found(df):
    return {r.k: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.with_spans(df).collect()}


TEXTS = [
    None,
    "",
    "a@b.c d.e%f+g@h-i.j.k, é@é.fr x@y z@.q a@b.c%x@y.z a@b.c@d.e",
    "a@b.c_d@e.f __@x.y.z. @a.b 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3 9.9.9.9999999999999999999999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500000000000004 0 00 4111  1111",
    "+1 (423) 555-7379 +12345678 +1 2 3 4 5 6 7 8 9) +44.20.7946.0958- ++49 30 901820",
    "é😀 mail a@b.cd 😀 +1 (423) 555-7379 😀 8.8.8.8",
    "x" * 50_000 + "@" + "a." * 20_000 + "b " + "1" * 30_000 + " " + "1." * 20_000 + "1" + "+1" + " " * 20_000 + "2",
    "a@b.c " * 3000,
]


def test_base_spans_are_those_of_the_plain_patterns(frame):
    got = found(frame([(k, t) for k, t in enumerate(TEXTS)], "k int, text string"))
    for k, text in enumerate(TEXTS):
        assert [s for s in got[k] if s[0] in pii.BASE] == base_spans(text), k


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab1 2.3@4+-()%_é😀05", max_size=60), min_size=80, max_size=80))
def test_base_spans_of_random_texts(frame, texts):
    got = found(frame(list(enumerate(texts)), "k int, text string"))
    for k, text in enumerate(texts):
        assert [s for s in got[k] if s[0] in pii.BASE] == base_spans(text), text


def test_checksums_and_context_add_spans(frame):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00.",
        "DE89370400440532013001",  # wrong check digits
        "XDE89370400440532013000Y",
        "my SSN is 123-45-6789",
        "part 123-45-6789",
        "SSN 000-45-6789",
        "call 555-123-4567 now",
        "number 555-123-4567 now",
    ]
    got = found(frame(list(enumerate(texts)), "k int, text string"))
    extra = [[s for s in got[k] if s[0] not in pii.BASE] for k in range(len(texts))]
    assert extra == [[("iban", 5, 32)], [], [], [("ssn", 10, 21)], [], [], [("local", 5, 17)], []]


def test_scores(frame):
    df = frame([(0, "mail a@b.cd, card 4111111111111111; 8.8.8.8")], "k int, text string")
    assert [(s.kind, s.score) for s in pii.with_spans(df).first().spans] == [("email", 0.9), ("ip", 0.6), ("card", 1.0)]


def test_empty_table_and_clashing_names(frame):
    schema = "doc_id long, text string, spans int"
    assert pii.with_spans(frame([], schema)).collect() == []
    assert pii.with_spans(frame([(1, "a@b.c", 2)], schema)).columns == ["doc_id", "text", "spans", "_spans"]


def test_query_over_the_test_data(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op2_pii(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in BASE]
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_secrets_need_context_and_entropy(frame):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f'token = "{key}"', f"commit {key}", "key " + "a1" * 20, "key " + "abcdefghij" * 4, f"api_key:{key} {key}", "key " + key[:19]]
    got = found(frame(list(enumerate(texts)), "k int, text string"))
    extra = [[s for s in got[k] if s[0] == "secret"] for k in range(len(texts))]
    assert extra == [[("secret", 9, 49)], [], [], [], [("secret", 8, 48)], []]


def test_many_matches_in_one_text_take_little_more_than_linear_time(frame):
    times = []
    for n in (4_000, 32_000):
        text = " ".join(f"user{k}@mail{k}.com" for k in range(n))
        df = pii.with_spans(frame([(0, text)], "k int, text string", 1))
        start = time.perf_counter()
        spans = df.first().spans
        times.append(time.perf_counter() - start)
        assert [(s.kind, s.start, s.end) for s in spans if s.kind == "email"] == base_spans(text)
    assert times[1] < 32 * times[0]
