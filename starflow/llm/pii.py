"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Only DataFrame operations.  A pattern's matches and the stretches between them give the
places: a match starts after all earlier stretches and matches.  Patterns are written so
that no run of characters is scanned from each of its positions; each finds what the
plain pattern in its comment finds, leftmost and without overlap.

======== ================================= ============================== =====
kind     a match is kept if                confirmed by                   score
======== ================================= ============================== =====
email    always                            --                             0.6
ip       parts at most 255                 range                          0.6
card     13 to 19 digits                   Luhn                           0.9
phone    9 to 15 digits                    count of digits                0.6
iban     15 to 34 letters and digits       mod 97                         0.9
ssn      3-2-4 digits, none of them zero   context                        0.3
local    3-3-4 digits of a phone number    context                        0.3
secret   20 or more letters, digits, _+/-  context, letters and digits,   0.3
                                           3 bits of entropy a character
======== ================================= ============================== =====

A context word within 40 characters before a match, or 20 after it, adds 0.3; a span
is reported from 0.6 on.  All but the first four kinds must not touch a letter or digit.  For an
account number only the start is a match: of the ends after it that touch no letter or digit
the one of its country's length counts if confirmed, else the last confirmed one.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import column, free_name

#: What each kind looks like, for Java's matcher.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a start, and without taking them what may follow and 20 characters of context
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}[\s\S]{0,20}))",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local": r"[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
    "secret": r"[A-Za-z0-9_+/-]{20,}+",
}
#: Words that make a kind likelier, in lower case.
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|fax|mobile",
    "iban": "iban|account|bank",
    "ssn": "ssn|social|security",
    "local": "phone|tel|call|fax|mobile",
    "secret": "token|secret|key|apikey|password|passwd|pwd|credential|bearer|auth",
}
#: Letters and digits of account numbers by country.
ACCOUNTS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
BASE = ("email", "ip", "card", "phone")
THRESHOLD = 0.6
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fold(values: Column, start: Column, step) -> Column:
    """What ``step`` appends to the state's ``found``, over all ``hits`` of ``values``.

    Each step copies its state, so the state holds none of the values, and ``found`` is begun
    anew after a root of their number.
    """
    empty = F.array().cast(SPAN)

    def whole(v):
        count = F.size(v["hits"])
        size = F.ceil(F.sqrt(count)).cast("int")

        def block(state, k):
            part = F.aggregate(F.sequence(k, F.least(k + size, count) - 1), state["inner"], lambda s, k: step(v, s, k))
            parts = lambda p: F.concat(state["parts"], F.array(p["found"])).alias("parts")
            return _let(part, lambda p: F.struct(p.withField("found", empty).alias("inner"), parts(p)))

        outer = F.struct(start.withField("found", empty).alias("inner"), F.array().cast(f"array<{SPAN}>").alias("parts"))
        return F.aggregate(F.sequence(F.lit(0), count - 1, size), outer, block, lambda s: F.flatten(s["parts"]))

    return _let(values, whole)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""

    def add(total, k):
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(k % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits pass the mod-97 check of account numbers."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def add(rest, c):
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[A-Z]"), (rest * 100 + letter) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), add) == 1


def entropy(word: Column) -> Column:
    """Bits a character, by the shares of a word's characters."""
    share = lambda c: 1 - F.length(F.replace(word, c, F.lit(""))) / F.length(word)
    return F.aggregate(F.array_distinct(F.split(word, "(?<=.)(?=.)")), F.lit(0.0), lambda sum, c: sum - share(c) * F.log2(share(c)))


def _confirmed(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    if kind == "ip":
        return match.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.when(count.between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    if kind == "ssn":
        return ~match.rlike("^000|-00-|0000$")
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (entropy(match) >= 3)
    return F.lit(True)


def _spans(kind: str, text: Column) -> Column:
    """An array of (kind, start, end, score): code points, end exclusive."""
    pattern = PATTERNS[kind]
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    known = F.lit({"card": 0.9, "ssn": 0.3, "local": 0.3, "secret": 0.3}.get(kind, 0.6))
    words = rf"(?<![a-z])(?:{CONTEXT[kind]})"

    def step(v, state, k):
        gap, hit, after = F.get(v["gaps"], k), F.get(v["hits"], k), F.get(v["gaps"], k + 1)
        start = state["at"] + F.length(gap)
        end = start + F.length(hit)
        near = F.lower(F.right(gap, F.lit(40))).rlike(words) | F.lower(F.left(after, F.lit(20))).rlike(words)
        score = F.round(F.least(F.lit(1.0), known + F.when(near, 0.3).otherwise(0.0)), 1)
        keep = _confirmed(kind, hit)
        if kind not in BASE:
            keep = (score >= THRESHOLD) & ~F.right(gap, F.lit(1)).rlike("[A-Za-z0-9]") & ~F.left(after, F.lit(1)).rlike("[A-Za-z0-9]") & keep
        span = F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"), score.alias("score"))
        found = F.when(keep, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.cast("int").alias("at"), found.alias("found"))

    found = _fold(F.struct(gaps.alias("gaps"), hits.alias("hits")), F.struct(F.lit(0).alias("at")), step)
    # nearly all texts stop at this first scan
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def _accounts(text: Column) -> Column:
    """The same for account numbers, whose ends their starts leave open."""
    pattern, known = PATTERNS["iban"], 0.9
    gaps = F.split(text, pattern, -1)
    hits, rests = (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) for group in (0, 1))
    sizes = F.create_map(*[F.lit(x) for n, of in ACCOUNTS.items() for country in of.split() for x in (country, n)])
    words = rf"(?<![a-z])(?:{CONTEXT['iban']})"

    def step(v, state, k):
        gap, hit, rest = F.get(v["gaps"], k), F.get(v["hits"], k), F.get(v["rests"], k)
        start = state["at"] + F.length(gap)
        size = F.try_element_at(sizes, F.left(hit, F.lit(2)))
        most = F.length(F.regexp_extract(rest, r"^(?:\x20?[A-Z0-9]){11,30}", 0))
        code = lambda n: F.replace(F.concat(hit, F.left(rest, n)), F.lit(" "), F.lit(""))
        free = lambda n: ~F.substring(rest, n, F.lit(2)).rlike("^ |^[A-Z0-9][A-Za-z0-9]")
        ends = F.filter(F.sequence(F.lit(11), most), lambda n: F.when(free(n), F.when(F.length(code(n)) >= 15, mod97(code(n)))))
        last = F.array_max(F.transform(ends, lambda n: F.struct(F.coalesce(F.length(code(n)) == size, F.lit(False)).alias("fits"), n.alias("n"))))["n"]
        end = start + F.length(hit) + last
        near = F.lower(F.right(gap, F.lit(40))).rlike(words) | F.lower(F.substring(rest, last + 1, F.lit(20))).rlike(words)
        score = F.round(F.least(F.lit(1.0), F.lit(known) + F.when(near, 0.3).otherwise(0.0)), 1)
        span = F.struct(F.lit("iban").alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"), score.alias("score"))
        keep = (start >= state["free"]) & last.isNotNull()
        return F.struct(
            (start + F.length(hit)).cast("int").alias("at"),
            F.when(keep, end).otherwise(state["free"]).cast("int").alias("free"),
            F.when(keep, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
        )

    values = F.struct(gaps.alias("gaps"), hits.alias("hits"), rests.alias("rests"))
    found = _fold(values, F.struct(F.lit(0).alias("at"), F.lit(0).alias("free")), step)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def with_spans(df: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """All columns and the spans of personal data in the whole text as ``into``.

    Spans are (kind, start, end, score), by kind in the order of the table above, then by
    start.  Kinds are found independently and may overlap.  A null text has no spans.  A
    name that is taken gets a leading underscore.
    """
    whole = F.coalesce(column(text).cast("string"), F.lit(""))
    return df.withColumn(free_name(df, into), F.concat(*[_accounts(whole) if kind == "iban" else _spans(kind, whole) for kind in PATTERNS]))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
