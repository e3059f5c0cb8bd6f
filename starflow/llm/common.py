"""What the operators share: scratch tables, code and files for the workers, word hashes."""

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.session import workspace

U = np.uint64


class Scratch:
    """Tables written once and read again, in the folder the session shares.

    A written table cuts the lineage: an executor that is lost later costs no more
    than the reading of its files again.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.count = spark, workspace(spark), 0

    def table(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives this package's code to the Python workers, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_starflow_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="starflow-code-"), "starflow_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("starflow", os.path.relpath(full, top)))
    context.addPyFile(path)
    context._starflow_shipped = True


def shared_file(spark: SparkSession, path: str, most: int = 64 << 20):
    """A small file of the driver (a vocabulary) as a broadcast value.

    The bound is checked: what is sent to every executor never grows with the data.
    """
    if os.path.getsize(path) > most:
        raise ValueError(f"{path} has more than {most} bytes")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def column(name: str):
    return F.col(f"`{name.replace('`', '``')}`")


# ---- words of a batch of texts, as 64-bit hashes --------------------------------------

_SEED = np.random.default_rng(20240131)
_BYTE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEGMENT = 1 << 20
_POWERS: dict[int, tuple] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finalizer of splitmix64, a fixed public function)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _powers(n: int):
    size = max(_SEGMENT, 1 << int(n - 1).bit_length())
    if size not in _POWERS:
        if size > _SEGMENT:
            _POWERS.clear()
        step = np.full(size, _BASE, dtype=np.uint64)
        back = np.full(size + 1, _INVERSE, dtype=np.uint64)
        step[0] = back[0] = U(1)
        _POWERS[size] = (np.multiply.accumulate(step), np.multiply.accumulate(back))
    return _POWERS[size]


def byte_table(fold: bool = True) -> np.ndarray:
    """The value of each byte; ``fold`` gives A-Z the values of a-z."""
    values = _BYTE.copy()
    if fold:
        values[65:91] = values[97:123]
    return values


#: Bytes that end a word: white space, or white space and ASCII punctuation.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
PUNCTUATION = SPACE.copy()
PUNCTUATION[[*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True
FOLDED = byte_table()


def texts_of(array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offset of each text; null is empty."""
    import pyarrow as pa

    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    at = np.frombuffer(array.buffers()[1], dtype=np.int64 if wide else np.int32)
    at = at[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(at):
        at = np.zeros(1, np.int64)
    return buf[at[0] : at[-1]], at - at[0]


def text_slices(array, most: int = 1 << 20, rows: int = 500):
    """Start and stop of parts of an Arrow string column with at most ``most`` bytes and ``rows`` texts, or one text."""
    at = texts_of(array)[1]
    start = 0
    while start < len(array):
        stop = int(np.searchsorted(at, at[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), start + rows, len(array))
        yield start, stop
        start = stop


def hash_words(buf: np.ndarray, at: np.ndarray, ends: np.ndarray = SPACE, values: np.ndarray = FOLDED):
    """The hash of each word, and the index of the first word of each text.

    Equal words have equal hashes wherever they stand.  The bytes are taken in
    segments that end between words, so a very long text needs no more memory than
    a short one (a single word longer than a segment makes that segment longer).
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    begins = np.zeros(n + 1, dtype=bool)
    begins[at] = True
    inside = ~ends[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:n]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        low = starts[k]
        j = max(k + 1, int(np.searchsorted(stops, low + _SEGMENT, side="right")))
        high = stops[j - 1]
        power, inverse = _powers(high - low)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(values[buf[low:high]] * power[: high - low], out=sums[1:])
        s, e = starts[k:j] - low, stops[k:j] - low
        out[k:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        k = j
    return out, np.searchsorted(starts, at).astype(np.int64)
