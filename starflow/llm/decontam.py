"""Benchmark items inside documents, by CGK embeddings and bit sampling.

Words (letters and digits, A-Z lower-cased) are the symbols.  A CGK walk reads a window
of words: at each step it writes down the word it stands on and moves on or stays, as a
random bit of that word and step says.  Two windows at a small edit distance walk in
step most of the time, so their embeddings are at a small Hamming distance.  A table
keeps a few sampled positions of one walk as a key; equal keys in any table make a
candidate, which is then verified by its exact edit distance.

A document's windows start at every fourth word.  An item is entered at every start that
such a grid can meet, with windows of a size that fits what is left of the item, so each
occurrence has several windows that are aligned with the item.  With 4 walks of 2 tables,
items of 40 words and more with a fifth of their words changed are found with a probability
of over 0.95 (measured in ``tests/llm`` by length).

Shorter items have too few windows for that.  They are cut into one piece more than edits
are allowed, so one piece at least stands unchanged in the text; each piece is looked up at
every word, and no short item is missed.  Unchanged items are always found.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import PUNCTUATION, Scratch, U, column, free_name, hash_words, mix, ship, texts_of

SIZES = (1, 2, 4, 8, 16, 24)
WALKS, TABLES, STRIDE = 4, 2, 4
#: Items with fewer words are also found by pieces.
SHORT = 40
#: Steps that a table samples of a window's; all steps of a small window make one table.
SAMPLED = {1: 1, 2: 2, 4: 4, 8: 8, 16: 10, 24: 12}
#: Items are sent to the executors in blocks of at most so many words.
BLOCK_WORDS = 1 << 20
#: Words of documents that are walked at a time.
_BATCH = 1 << 18
_RULES = np.random.default_rng(3).integers(1, 1 << 63, (WALKS, SIZES[-1]), dtype=np.uint64) | U(1)


def _samples():
    """For each walk and step, the (table, size) pairs that write the step down."""
    random = np.random.default_rng(5)
    at = [[[] for _ in range(SIZES[-1])] for _ in range(WALKS)]
    for walk in range(WALKS):
        for table in range(TABLES):
            for size in SIZES:
                if table and SAMPLED[size] == size:
                    continue
                for step in random.choice(size, SAMPLED[size], replace=False):
                    at[walk][step].append((table, size))
    return at


_AT = _samples()


def embed(words: np.ndarray, starts: np.ndarray, sizes):
    """Keys of the windows at ``starts``: ``(walk, table, size), keys`` one after another.

    ``words`` must go on for the largest size beyond every start.
    """
    sizes = set(sizes)
    for walk in range(WALKS):
        place = starts.copy()
        keys = {(t, s): np.full(len(starts), 1 + walk * 64 + t * 32 + k, np.uint64) for t in range(TABLES) for k, s in enumerate(SIZES) if s in sizes and not (t and SAMPLED[s] == s)}
        for step in range(max(sizes)):
            here = words[place]
            for to in _AT[walk][step]:
                if to in keys:
                    keys[to] *= U(0x9E3779B97F4A7C15)
                    keys[to] += here
            place += ((here * _RULES[walk, step]) >> U(63)).astype(np.int64)
        for (t, s), key in keys.items():
            yield (walk, t, s), mix(key)


def _whole(words: np.ndarray, n: int) -> np.ndarray:
    """Keys of all n words that follow one another, by their first."""
    keys = np.full(max(0, len(words) - n + 1), 2048 + n, np.uint64)
    for k in range(n):
        keys *= U(0x9E3779B97F4A7C15)
        keys += words[k : k + len(keys)]
    return mix(keys)


def _lookup(keys: np.ndarray, of: np.ndarray, offset: np.ndarray):
    """Sorted keys with their items and places, and flags that most other keys lack."""
    bits = max(18, len(keys).bit_length() + 5)
    flags = np.zeros(1 << bits, dtype=bool)
    flags[keys >> U(64 - bits)] = True
    return U(64 - bits), flags, keys, of, offset


def _hits(table, keys: np.ndarray):
    """Which keys are known, with the item and place of each equal one."""
    shift, flags, known, of, offset = table
    hit = np.flatnonzero(flags[keys >> shift])
    low = np.searchsorted(known, keys[hit], side="left")
    many = np.searchsorted(known, keys[hit], side="right") - low
    hit, low, many = hit[many > 0], low[many > 0], many[many > 0]
    which = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(hit, many), of[which], offset[which]


class Items:
    """A block of items with the tables of their windows."""

    def __init__(self, ids, texts: list[str], edits: float):
        import pyarrow as pa

        words, first = hash_words(*texts_of(pa.array(texts, pa.string())), PUNCTUATION)
        some = np.flatnonzero(np.diff(first))
        self.ids = np.asarray(ids, dtype=np.int64)[some]
        self.words = [words[first[k] : first[k + 1]] for k in some]
        self.most = [int(edits * len(w)) for w in self.words]
        shortest = min((len(w) for w in self.words), default=1)
        self.stride = max(1, min(STRIDE, shortest // 3))
        padded, starts, of, offset, size = [], [], [], [], []
        total = 0
        for k, w in enumerate(self.words):
            for o in range(len(w)):
                left = len(w) - o
                if o >= self.stride and left < max(8, len(w) // 2):
                    break
                fits = [s for s in SIZES if s <= left]
                for s in fits[-1:] + [x for x in fits[-2:-1] if x >= 8]:
                    starts.append(total + o)
                    of.append(k)
                    offset.append(o)
                    size.append(s)
            padded += [w, np.zeros(SIZES[-1], np.uint64)]
            total += len(w) + SIZES[-1]
        self.sizes = sorted(set(size))
        self.tables, self.pieces = {}, {}
        if not self.sizes:
            return
        cut = {}
        for k, (w, most) in enumerate(zip(self.words, self.most)):
            ends = [len(w) * j // (most + 1) for j in range(most + 2)] if len(w) < SHORT and most < len(w) else []
            for low, high in zip(ends, ends[1:]):
                cut.setdefault(high - low, []).append((_whole(w, high - low)[low], k, low))
        for n, rows in cut.items():
            keys, owners, offsets = (np.array(x, t) for x, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
            order = np.argsort(keys, kind="stable")
            self.pieces[n] = _lookup(keys[order], owners[order], offsets[order])
        size, of, offset = np.array(size), np.array(of), np.array(offset)
        for (walk, table, s), keys in embed(np.concatenate(padded), np.array(starts, np.int64), self.sizes):
            own = np.flatnonzero(size == s)
            order = own[np.argsort(keys[own], kind="stable")]
            self.tables[walk, table, s] = _lookup(keys[order], of[order], offset[order])

    def candidates(self, words: np.ndarray, first: np.ndarray):
        """Distinct ``(text, item, word of the text at which the item would begin)``."""
        lengths, longest = np.diff(first), SIZES[-1]
        gaps = first[:-1] + longest * np.arange(len(lengths))
        padded = np.zeros(len(words) + longest * len(lengths), np.uint64)
        padded[np.arange(len(words)) + np.repeat(longest * np.arange(len(lengths)), lengths)] = words
        n = -(-lengths // self.stride)
        owner = np.repeat(np.arange(len(lengths)), n)
        at = self.stride * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
        found = []
        for table, keys in embed(padded, gaps[owner] + at, self.sizes):
            rows, of, offset = _hits(self.tables[table], keys)
            found.append(np.stack((owner[rows], of, at[rows] - offset)))
        for n, known in self.pieces.items():
            rows, of, offset = _hits(known, _whole(padded, n))
            text = np.searchsorted(gaps, rows, side="right") - 1
            found.append(np.stack((text, of, rows - gaps[text] - offset)))
        if not sum(x.shape[1] for x in found):
            return np.zeros((0, 3), np.int64)
        rows = np.concatenate(found, axis=1)
        code = (rows[0] * len(self.ids) + rows[1] << 32) + rows[2] + (1 << 31)
        _, kept = np.unique(code, return_index=True)
        return self.possible(words, first, rows[:, kept].T)

    def possible(self, words: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The candidates that may be near enough.

        With k edits all words of the item but k stand in the text, each at most k places
        from where it would be.  Only candidates for which too few do are left out.
        """
        keep = np.zeros(len(rows), dtype=bool)
        for item in np.unique(rows[:, 1]):
            own = np.flatnonzero(rows[:, 1] == item)
            want, most = self.words[item], self.most[item]
            at = rows[own, 2][:, None] + np.arange(-most, len(want) + most)
            low, high = first[rows[own, 0]][:, None], first[rows[own, 0] + 1][:, None]
            here = words[np.clip(at + low, 0, len(words) - 1)]
            here[(at < 0) | (at + low >= high)] = 0
            there = np.zeros((len(own), len(want)), dtype=bool)
            for shift in range(2 * most + 1):
                there |= here[:, shift : shift + len(want)] == want
            keep[own] = there.sum(axis=1) >= len(want) - most
        return rows[keep]


def edit_distance(item: np.ndarray, text: np.ndarray):
    """Least edit distance between the item and any stretch of the text, and the end of the first such."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item):
        new = row + 1
        np.minimum(new[1:], row[:-1] + (text != word), out=new[1:])
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def _matches(items: Items, words: np.ndarray, rows: np.ndarray):
    """The best place of each item in one text, of the candidates ``(item, begin)``."""
    best = {}
    for item, begin in rows.tolist():
        want, most = items.words[item], items.most[item]
        if item in best and best[item][0] == 0:
            continue
        if begin >= 0 and np.array_equal(words[begin : begin + len(want)], want):
            best[item] = (0, begin, begin + len(want))
            continue
        low, high = max(0, begin - most), min(len(words), begin + len(want) + most)
        near = words[low:high]
        if not most:
            continue
        distance, end = edit_distance(want, near)
        if distance <= most:
            _, back = edit_distance(want[::-1], near[:end][::-1])
            got = (distance, low + end - back, low + end)
            if item not in best or got < best[item]:
                best[item] = got
    return [(int(items.ids[k]), s, e - s, d) for k, (d, s, e) in sorted(best.items())]


def _blocks(benchmark: DataFrame, id: str, text: str, edits: float):
    """Items in blocks of bounded size, read one after another."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(column(id).cast("long"), column(text).cast("string")).where(column(id).isNotNull() & column(text).isNotNull())
    for item, words in rows.toLocalIterator():
        ids.append(item)
        texts.append(words)
        size += len(words) // 4 + 1
        if size >= BLOCK_WORDS:
            yield Items(ids, texts, edits)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, edits)


def with_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", edits: float = 0.2, into: str = "matches") -> DataFrame:
    """All columns and the benchmark items that each whole text holds.

    ``into`` is an array of (item_id, word, words, distance), one for each item whose
    least edit distance to a stretch of the text is at most ``edits`` of its words; words
    count from 0.  Null and empty texts, and items without words, match nothing; items
    with equal texts all match.  Each block of items is one pass over the documents.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch, name = Scratch(spark), free_name(docs, into)
    kind = "array<struct<item_id:long,word:int,words:int,distance:int>>"
    out = docs.withColumn(name, F.array().cast(kind))
    for k, block in enumerate(_blocks(benchmark, item_id, item_text, edits)):
        if not block.tables:
            continue
        held = spark.sparkContext.broadcast(block)

        @F.arrow_udf(kind)
        def found(texts, held=held):
            import pyarrow as pa

            items, out = held.value, []
            for start, stop in _stretches(texts):
                words, first = hash_words(*texts_of(texts.slice(start, stop - start)), PUNCTUATION)
                rows = items.candidates(words, first)
                cut = np.searchsorted(rows[:, 0], np.arange(len(first)))
                for d in range(len(first) - 1):
                    own = rows[cut[d] : cut[d + 1], 1:]
                    got = _matches(items, words[first[d] : first[d + 1]], own) if len(own) else []
                    out.append([dict(zip(("item_id", "word", "words", "distance"), x)) for x in got])
            made = pa.struct([("item_id", pa.int64()), ("word", pa.int32()), ("words", pa.int32()), ("distance", pa.int32())])
            return pa.array(out, pa.list_(made))

        if k:  # a written table between passes, so that one block is held at a time
            out = scratch.table(out)
        out = out.withColumn(name, F.concat(name, found(column(text).cast("string"))))
    return out


def _stretches(texts):
    """Ranges of texts with a bounded number of characters, at least one text each."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > _BATCH * 6:
            yield start, k
            start, held = k, 0
        held += int(size) + 1
    if len(sizes):
        yield start, len(sizes)
