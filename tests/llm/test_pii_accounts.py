"""Account numbers before and after other capitals and digits."""

from starflow.llm import pii

TEXTS = {
    "DE89 3704 0044 0532 0130 00 Please pay": ["DE89 3704 0044 0532 0130 00"],
    "DE89370400440532013000 BIC COBADEFFXXX": ["DE89370400440532013000"],
    "DE89370400440532013000 2 EUR, GB29 NWBK 6016 1331 9268 19 A": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"],
    "DE89 3704 0044 0532 0130 00 GB29NWBK60161331926819": ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"],
    "REF AB12 ORDER 345678 DE89370400440532013000 😀": ["DE89370400440532013000"],
    "😀 MT84MALT011000012345MTLCAST001S NOW": ["MT84MALT011000012345MTLCAST001S"],
    "NO9386011117947 OSLO NO93 8601 1117 947": ["NO9386011117947", "NO93 8601 1117 947"],
    "DE89370400440532013000x XDE89370400440532013000": [],
    "DE89370400440532013001 BIC": [],
    # other letters than a known country's
    "QQ39370400440532013000 AND MORE": None,
}


def mod97(code):
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def test_an_account_number_is_found_before_capitals_and_digits(frame):
    digits = next(k for k in range(2, 99) if mod97(f"QQ{k:02d}370400440532013000"))
    texts = {t.replace("QQ39", f"QQ{digits:02d}"): w if w is not None else [f"QQ{digits:02d}370400440532013000"] for t, w in TEXTS.items()}
    made = pii.with_spans(frame(list(enumerate(texts)), "k int, text string")).collect()
    got = {r.text: [r.text[s.start : s.end] for s in r.spans if s.kind == "iban"] for r in made}
    assert got == texts


def test_the_length_of_the_country_comes_first(frame):
    real, more = "DE89370400440532013000", next(f"{a}{b}" for a in "ABCDEFGHIJ" for b in range(10000, 99999) if mod97(f"DE89370400440532013000{a}{b}"))
    row = pii.with_spans(frame([(f"bank {real} {more} x",)], "text string")).first()
    assert [(s.start, s.end, s.score) for s in row.spans if s.kind == "iban"] == [(5, 5 + len(real), 1.0)]


def test_many_starts_in_a_long_text(frame):
    text = "AB12 " * 2_000 + "DE89370400440532013000 BIC"
    row = pii.with_spans(frame([(text,)], "text string")).first()
    assert (10_000, 10_022) in [(s.start, s.end) for s in row.spans if s.kind == "iban"]
