"""Near duplicates by HyperMinHash registers, banded, estimated and then verified.

A text's set is its distinct five-word shingles as 64-bit hashes.  The high bits of a
hash choose one of 256 buckets; of the least value in a bucket the sketch stores the
count of leading zeros and some mantissa bits.  Empty buckets borrow from buckets that a
fixed rule names, so short texts have full sketches too.

* Bands of registers (16 bits each) give the candidates, as many registers to a band as
  leave a pair at the threshold without a shared band with a probability of at most 5e-5:
  at 0.85 there are 32 bands of 8, (1 - 0.85^8)^32 = 4e-5, at 0.80 there are 42 of 6, 3e-6.
* A 4-bit form of the registers, without the borrowed ones, estimates the similarity of a
  candidate, corrected for registers that agree by chance; candidates more than four
  standard errors below the threshold are left out.
* What remains is confirmed on the whole texts, with integers.

Copies of a set are one node.  Within a band the links are found in two rounds: each set
against one hub of its bands, then only pairs whose components still differ.  A group of
n similar texts thus costs about n comparisons, and no pair that could join two
components is left out.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import SPACE, Scratch, U, column, hash_words, mix, ship, texts_of
from starflow.llm.components import components

BUCKETS, WIDTH = 256, 5
#: Chance at most that a pair at the threshold shares no band.
MISSED = 5e-5
#: Chance that unequal 4-bit registers agree: 4 classes of leading zeros, 4 of mantissa,
#: of which the first and the last share a code, as zero stands for an empty bucket.
COLLISION = sum((2.0**-k * 8 / 15) ** 2 for k in range(4)) / 4 + 2 * (8 / 60) * (1 / 60)
#: Text that a worker turns into shingles at a time; what it holds is some ten times that.
_BYTES = 1 << 20
_RULE = np.random.default_rng(7).integers(0, BUCKETS, (64, BUCKETS))
_PLACE = [U(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(WIDTH)]
_BAND = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) for k in range(BUCKETS)], dtype=np.uint64)


def banding(percent: int):
    """Registers in a band, bands, and the least size of a set that is similar to an unequal one."""
    t = percent / 100
    rows = max((r for r in range(1, BUCKETS + 1) if (1 - t**r) ** (BUCKETS // r) <= MISSED), default=1)
    # n - 1 shingles of n are the most that unequal sets share
    least = -(-100 // (100 - percent)) - 1 if percent < 100 else np.iinfo(np.int64).max
    return rows, BUCKETS // rows, max(1, least)


def shingle_sets(buf: np.ndarray, at: np.ndarray):
    """All texts' sorted distinct shingles, one after another, and where each set begins."""
    words, first = hash_words(buf, at, SPACE)
    n = np.diff(first)
    grams = np.zeros(max(0, len(words) - WIDTH + 1), dtype=np.uint64)
    for k, place in enumerate(_PLACE):
        grams += words[k : k + len(grams)] * place
    grams = mix(grams)
    sets = []
    for s, size in zip(first[:-1].tolist(), n.tolist()):
        if size >= WIDTH:
            got = grams[s : s + size - WIDTH + 1]
            got = np.sort(got)
            sets.append(got[np.concatenate(([True], got[1:] != got[:-1]))])
        elif size:
            whole = U(size) + sum((words[s + k : s + k + 1] * _PLACE[k] for k in range(size)), np.zeros(1, np.uint64))
            sets.append(mix(whole))
        else:
            sets.append(np.zeros(0, np.uint64))
    begins = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), begins


def registers(grams: np.ndarray, begins: np.ndarray):
    """Leading-zero counts and 10 mantissa bits, a row of 256 for each set that is not empty."""
    sizes = np.diff(begins)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bucket = (grams >> U(56)).astype(np.int64)
    lead = np.ones(len(grams), dtype=bool)
    lead[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
    value = grams[lead] & U((1 << 56) - 1)
    bits = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    zeros = 56 - np.minimum(bits, 56)
    mantissa = (value >> np.maximum(bits - 11, 0).astype(np.uint64)) & U(1023)
    out = np.zeros((len(sizes), BUCKETS), dtype=np.uint16)
    full = np.zeros((len(sizes), BUCKETS), dtype=bool)
    out[owner[lead], bucket[lead]] = (zeros << 10).astype(np.uint16) | mantissa.astype(np.uint16)
    full[owner[lead], bucket[lead]] = True
    return out, full


def four_bits(out: np.ndarray, full: np.ndarray) -> np.ndarray:
    """1 to 15 for a register, 0 for an empty bucket."""
    return np.where(full, 1 + ((out >> 10 & 3) << 2 | out >> 8 & 3) % 15, 0).astype(np.uint8)


def borrow(out: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Fills empty buckets: the first full one that a fixed rule names, else the next to the right."""
    out = out.copy()
    row, gap = np.nonzero(~full & (full.any(axis=1))[:, None])
    for rule in _RULE:
        if not len(row):
            return out
        source = rule[gap]
        found = full[row, source]
        out[row[found], gap[found]] = out[row[found], source[found]]
        row, gap = row[~found], gap[~found]
    for r in np.unique(row):
        own, gaps = np.flatnonzero(full[r]), gap[row == r]
        out[r, gaps] = out[r, own[np.searchsorted(own, gaps) % len(own)]]
    return out


def _parts(batch, *texts):
    """Slices with at most ``_BYTES`` of text in these columns, or a single row."""
    import pyarrow.compute as pc

    sizes = sum(pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for k in texts)
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        stop = int(np.searchsorted(ends, ends[start] - sizes[start] + _BYTES, side="right"))
        stop = min(max(stop, start + 1), start + 2000)
        yield batch.slice(start, stop - start)
        start = stop


def _sketches(percent):
    width, count, least = banding(percent)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _parts(batch, 1):
                grams, begins = shingle_sets(*texts_of(part.column(1)))
                sizes, some = np.diff(begins), np.flatnonzero(np.diff(begins))
                keys = np.zeros((2, len(sizes)), dtype=np.uint64)
                if len(some):
                    for k, salt in enumerate((U(0x1234567), U(0x89ABCDEF01))):
                        keys[k, some] = np.add.reduceat(mix(grams ^ salt), begins[:-1][some])
                out, full = registers(grams, begins)
                small = four_bits(out, full)
                packed = small[:, 0::2] | small[:, 1::2] << 4
                out = borrow(out, full)
                lanes = out[:, : count * width].reshape(len(out), count, width).astype(np.uint64)
                bands = mix((lanes * _BAND[:width]).sum(axis=2, dtype=np.uint64) + np.arange(count, dtype=np.uint64) * U(0x632BE59BD9B4E019))
                # smaller sets equal each other or are not similar
                rows = np.where(sizes >= least, 1, 0)
                listed = np.concatenate(([0], np.cumsum(rows * count))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(listed), pa.array(bands[rows == 1].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(keys[0].view(np.int64)),
                        pa.array(keys[1].view(np.int64)),
                        lists,
                        *(pa.array(np.ascontiguousarray(packed).view(np.int64)[:, k]) for k in range(16)),
                    ],
                    names=["id", "n", "k1", "k2", "bands", *(f"r{k}" for k in range(16))],
                )

    return run


def _verified(percent):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _parts(batch, 2, 3):
                a, b = (np.asarray(part.column(k)) for k in (0, 1))
                sides = []
                for ids, texts in ((a, part.column(2)), (b, part.column(3))):
                    _, some, back = np.unique(ids, return_index=True, return_inverse=True)
                    grams, begins = shingle_sets(*texts_of(texts.take(pa.array(some))))
                    sides.append([grams[begins[k] : begins[k + 1]] for k in back])
                ok = np.zeros(len(a), dtype=bool)
                for k, (x, y) in enumerate(zip(*sides)):
                    if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and len(x):
                        place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                        both = int((y[place] == x).sum())
                        ok[k] = 100 * both >= percent * (len(x) + len(y) - both)
                keep = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep)], names=["u", "v"])

    return run


def _verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole texts are similar enough, as ``(u, v)``."""
    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    two = one.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return two.select("a", "b", "ta", "tb").mapInArrow(_verified(percent), "u long, v long")


def _likely(percent: int):
    """The estimate from the 4-bit registers of two sets, against the threshold less four errors.

    Of the buckets that either set fills, those that differ are counted.  At the threshold
    each differs with a known chance; its variance has a part for the buckets being a
    sample of the union, which shrinks as they come to hold most of it, and a part for
    registers that agree by chance.
    """

    def count(x):  # digits that are not zero
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))
        return F.bit_count(x)

    apart = filled = F.lit(0)
    for k in range(16):
        x, y = F.col(f"x.r{k}"), F.col(f"y.r{k}")
        apart, filled = apart + count(x.bitwiseXOR(y)), filled + count(x.bitwiseOR(y))
    t = percent / 100
    union = (F.col("x.n") + F.col("y.n")) / (1 + t)
    spread = filled * (t * (1 - t) * F.greatest(F.lit(0.05), 1 - filled / union) + (1 - t) * COLLISION)
    most = filled * ((1 - t) * (1 - COLLISION)) + 4 * F.sqrt(spread)
    sizes = F.lit(100) * F.least("x.n", "y.n") >= F.lit(percent) * F.greatest("x.n", "y.n")
    return sizes & (apart <= most), apart / filled


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per document.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets;
    ``component_id`` is the least id that links reach, ``kept`` marks that document.
    Null or empty texts have no shingles and no links; a null id has no component and
    is kept.  Rows of one id count as one document.  Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    texts = docs.select(column(id).cast("long").alias("id"), column(text).cast("string").alias("text"))
    names = [f"r{k}" for k in range(16)]
    schema = "id long, n long, k1 long, k2 long, bands array<long>, " + ", ".join(f"{r} long" for r in names)
    sketches = scratch.table(texts.mapInArrow(_sketches(percent), schema))
    sets = (
        sketches.where("n > 0 and id is not null")
        .groupBy("k1", "k2")
        .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), *(F.first(r).alias(r) for r in names))
    )
    sets = scratch.table(sets)

    keyed = sets.select("rep", F.posexplode("bands").alias("band", "key"))
    hubs = keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top")
    shared = scratch.table(keyed.join(scratch.table(hubs.select("key", "hub")), "key"))

    known = sets.select(F.col("rep").alias("id"), "n", *names)
    likely, apart = _likely(percent)
    texts = texts.where("id is not null")
    # first round: each set against the most similar of its bands' hubs
    stars = shared.where("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    stars = stars.join(known.alias("x"), F.col("a") == F.col("x.id")).join(known.alias("y"), F.col("b") == F.col("y.id"))
    stars = stars.where(likely).groupBy("a").agg(F.min_by("b", F.struct(apart, "b")).alias("b"))
    links = scratch.table(_verify(stars, texts, percent))
    roots = scratch.table(components(links, scratch))

    # second round: what shares a band and lies in different components
    placed = shared.join(roots, shared.rep == roots.node, "left").select("key", "band", "rep", F.coalesce("root", "rep").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    mixed = scratch.table(mixed.select("key"))
    known = sets.select(F.col("rep").alias("id"), "n", "bands", *names)
    left = placed.join(mixed, "key").join(known, F.col("rep") == F.col("id"))
    left = scratch.table(left.select("key", "band", "rep", "c", "n", "bands", *names))
    across = (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.c") != F.col("y.c"))
    # a pair is taken in the first band that it shares
    earlier = F.arrays_overlap(*(F.slice(f"{side}.bands", F.lit(1), F.col("x.band")) for side in "xy"))
    pairs = left.alias("x").join(left.alias("y"), across & likely & ~earlier)
    pairs = pairs.select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"))
    more = _verify(pairs, texts, percent)
    final = scratch.table(components(scratch.table(links.union(more)), scratch))

    members = sets.select("k1", "k2", "rep").join(final, sets.rep == final.node, "left")
    members = members.select("k1", "k2", F.coalesce("root", "rep").alias("component"))
    rows = sketches.select("id", "n", F.when(F.col("n") > 0, F.col("k1")).alias("k1"), "k2")
    out = rows.join(members, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
