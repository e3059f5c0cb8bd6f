"""SQL that computes Spark's ``xxhash64`` in DuckDB, which has no such hash.

XXH64 is a public algorithm.  Spark starts with the seed 42, hashes one column after the
other with the hash so far as the seed, and skips NULL.  A step is one more subquery, as
each of its values is used several times; products are taken in 128 bits.
"""

# The five primes of XXH64, and Spark's seed.
P1 = 0x9E3779B185EBCA87
P2 = 0xC2B2AE3D27D4EB4F
P3 = 0x165667B19E3779F9
P4 = 0x85EBCA77C2B2AE63
P5 = 0x27D4EB2F165667C5
SEED = 42


def _wide(x: object) -> str:
    return f"'{x}'::UHUGEINT" if isinstance(x, int) else f"CAST({x} AS UHUGEINT)"


def _low(x: str) -> str:
    """The lower 64 bits."""
    return f"CAST(({x}) % {_wide(1 << 64)} AS UBIGINT)"


def _times(a: object, b: object) -> str:
    return _low(f"{_wide(a)} * {_wide(b)}")


def _plus(a: object, b: object) -> str:
    return _low(f"{_wide(a)} + {_wide(b)}")


def _turned(a: str, bits: int) -> str:
    """Rotated to the left."""
    return _low(f"{_wide(a)} * {_wide(1 << bits)} + {_wide(a)} // {_wide(1 << (64 - bits))}")


def _shifted(a: str, bits: int) -> str:
    return f"CAST({_wide(a)} // {_wide(1 << bits)} AS UBIGINT)"


class Steps:
    """A query that grows by one column a step; ``h`` is the hash so far."""

    def __init__(self, source: str):
        self.sql = f"SELECT *, CAST({SEED} AS UBIGINT) AS h FROM ({source})"

    def set(self, name: str, value: str, when: str | None = None) -> None:
        """Replace or add a column; where ``when`` does not hold it keeps its value."""
        value = f"CASE WHEN {when} THEN {value} ELSE {name} END" if when else value
        known = f"* REPLACE ({value} AS {name})" if name in ("h", "x") and f" AS {name}" in self.sql else f"*, {value} AS {name}"
        self.sql = f"SELECT {known} FROM ({self.sql})"

    def mixed(self, bits: int, factor: int, add: int, when: str) -> None:
        """``h`` rotated, multiplied and moved on."""
        self.set("h", _turned("h", bits), when)
        self.set("h", _plus(_times("h", factor), add), when)

    def finish(self, when: str) -> None:
        for bits, factor in ((33, P2), (29, P3), (32, None)):
            self.set("h", f"xor(h, {_shifted('h', bits)})", when)
            if factor:
                self.set("h", _times("h", factor), when)

    def word(self, value: str, when: str) -> None:
        """Eight bytes as one number."""
        self.set("x", _times(value, P2))
        self.set("x", _turned("x", 31))
        self.set("h", f"xor(h, {_times('x', P1)})", when)
        self.mixed(27, P1, P4, when)

    def half(self, value: str, when: str) -> None:
        """Four bytes as one number."""
        self.set("h", f"xor(h, {_times(value, P1)})", when)
        self.mixed(23, P2, P3, when)

    def number(self, column: str, bytes: int) -> None:
        """A column of non-negative numbers in four or eight bytes."""
        when, value = f"{column} IS NOT NULL", f"coalesce(CAST({column} AS UBIGINT), 0)"
        self.set("h", _plus("h", (P5 + bytes) % (1 << 64)), when)
        (self.word if bytes == 8 else self.half)(value, when)
        self.finish(when)

    def text(self, column: str, longest: int = 31) -> None:
        """A column of ASCII text shorter than the 32 bytes from which the hash has four lanes."""
        there, size = f"{column} IS NOT NULL", f"length({column})"
        byte = lambda at: f"coalesce(CAST(ascii(substr({column}, CAST({at} AS INT), 1)) AS UHUGEINT), 0)"
        packed = lambda at, n: _low(" + ".join(f"{byte(f'{at} + {k}')} * {_wide(1 << 8 * k)}" for k in range(n)))
        self.set("h", _plus("h", f"({_wide(size)} + {_wide(P5)}) % {_wide(1 << 64)}"), there)
        for k in range(longest // 8):
            self.word(packed(8 * k + 1, 8), f"{there} AND {size} >= {8 * (k + 1)}")
        self.half(packed(f"{size} - {size} % 8 + 1", 4), f"{there} AND {size} % 8 >= 4")
        for k in range(3):
            when = f"{there} AND {size} % 4 > {k}"
            self.set("h", f"xor(h, {_times(byte(f'{size} - {size} % 4 + {k + 1}'), P5)})", when)
            self.set("h", _turned("h", 11), when)
            self.set("h", _times("h", P1), when)
        self.finish(there)

    def signed(self) -> str:
        """The hash as Spark's signed long."""
        return f"CASE WHEN h >= {_wide(1 << 63)} THEN CAST(CAST(h AS HUGEINT) - '{1 << 64}'::HUGEINT AS BIGINT) ELSE CAST(h AS BIGINT) END"


def row_id(source: str, keep: str) -> str:
    """``keep`` and ``fact_id`` for a query with the columns of a fact's natural key."""
    steps = Steps(f"SELECT *, epoch_us(admission_time) AS micros FROM ({source})")
    steps.text("patient_id")
    steps.text("department")
    steps.number("hospital_id", 4)
    steps.number("micros", 8)
    return f"SELECT {keep}, {steps.signed()} AS fact_id FROM ({steps.sql})"
