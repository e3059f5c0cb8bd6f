"""Removes passages that stood in an earlier document, found by difference-cover anchors.

A set of places modulo a period is a difference cover if every difference modulo the period
is one of two places of the set; {0, 1, 3} modulo 7 is one.  Anchors are windows of ``length``
words that begin at a word whose number lies in the cover, modulo the period.  Let two
documents hold the same ``window`` words, at any two places: some shift below the period puts
both into the cover, so an anchor at that shift lies in both copies, and is the same, as long
as period + length = window + 1.  Three of seven windows are hashed, and nothing is missed.

1. Anchors are dealt into buckets by their hash; those that two documents share are found.
2. Each shared anchor is extended to both sides: the windows of ``window`` words that hold it
   are compared as a whole, by 64 bits within a bucket of an independent hash, and give way
   to the smallest id that has them.
3. Words that a window covers which a smaller id has too are removed.

Only anchors and windows move, packed into arrays for each bucket: a batch of documents first
settles what it can.  An anchor that it shares within itself is known as shared and only one
copy of it is compared further, the others go anywhere; a window with a smaller id in the
batch likewise.  So a passage in a third of all documents leaves a batch once for its bucket,
which sets no limit to how often it occurs.  The number of buckets grows with the text.

Texts are shuffled once: they meet their shared anchors and later their windows under the same
key and with the same columns, so that Spark reads the shuffled copy again.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import SPACE, U, byte_table, column, free_name, hash_words, mix, ship, texts_of

#: Bytes of text for each bucket; a worker holds the anchors of one.
BUCKET = 16 << 20
#: Bytes of text hashed at a time (one text at least), and anchors or windows settled together.
PART, TOGETHER = 1 << 20, 1 << 19

_EXACT = byte_table(fold=False)
#: Odd multipliers: of the anchors' hash and of the two halves of a window's.
_ANCHOR, _LOW, _HIGH = U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB)


def cover(period: int) -> list[int]:
    """Places such that every difference modulo ``period`` lies between two of them."""
    places = [0]
    lacking = set(range(1, period))
    while lacking:
        gains = lambda x: {d % period for y in places for d in (x - y, y - x)} & lacking
        best = max(range(1, period), key=lambda x: (len(gains(x)), -x))
        lacking -= gains(best)
        places.append(best)
    return sorted(places)


def shape(window: int) -> tuple[int, int, list[int]]:
    """Period, length of an anchor, and cover for windows of so many words."""
    period = (window + 1) // 2
    return period, window + 1 - period, cover(period)


def _hash(words: np.ndarray, at: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(length):
        out = out * base + words[at + k]
    return mix(out)


def _anchors(words: np.ndarray, first: np.ndarray, window: int):
    """Text number, word number and hash of each anchor of texts with a window."""
    period, length, places = shape(window)
    inside = np.zeros(period, dtype=bool)
    inside[places] = True
    counts = np.diff(first)
    own = np.where(counts >= window, counts - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), own)
    pos = np.arange(len(text)) - np.repeat(np.cumsum(own) - own, own)
    some = inside[pos % period]
    text, pos = text[some], pos[some]
    return text, pos, _hash(words, first[:-1][text] + pos, length, _ANCHOR)


def _groups(*keys: np.ndarray):
    """An order that brings equal keys together, and where each group begins in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


def _spread(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """A value for each group as one for each of its members."""
    return np.repeat(values, np.diff(np.append(first, n)))


def _shared(ids: np.ndarray, sure: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether another id has the same key, or a record with it is known to be shared."""
    out = np.zeros(len(ids), dtype=bool)
    if len(ids):
        order, first = _groups(*keys)
        low, high = (f.reduceat(ids[order], first) for f in (np.minimum, np.maximum))
        out[order] = _spread((low < high) | np.logical_or.reduceat(sure[order], first), first, len(ids))
    return out


def _later(ids: np.ndarray, sure: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether a smaller id has the same key, or had where it was dealt out."""
    out = sure.copy()
    if len(ids):
        order, first = _groups(*keys)
        out[order] |= ids[order] > _spread(np.minimum.reduceat(ids[order], first), first, len(ids))
    return out


def _blobs(values: np.ndarray, first: np.ndarray):
    """An Arrow array of binary values: the runs of ``values`` that begin at ``first``."""
    import pyarrow as pa

    values = np.ascontiguousarray(values)
    ends = (np.append(first, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _whole(table, name: str, dtype) -> np.ndarray:
    """The values of a binary column, one row's after the other's."""
    return np.frombuffer(b"".join(table[name].to_pylist()), dtype=dtype)


#: Columns of what a bucket receives, all binary.
_DEALT = ["ids", "hashes", "counts", "upper", "lower", "sure", "key"]


class _Batch:
    """Anchors or windows of some documents, settled among themselves and dealt into buckets.

    ``rule`` is :func:`_shared` or :func:`_later`.
    """

    def __init__(self, buckets: int, rule):
        self.buckets, self.rule = buckets, rule
        self.clear()

    def clear(self):
        self.documents, self.ids, self.hashes, self.rows, self.size = set(), [], [], [], 0

    def new(self, id: int, hash: int) -> bool:
        """Whether the document is not there yet: rows that repeat one add nothing."""
        if (id, hash) in self.documents:
            return False
        self.documents.add((id, hash))
        self.ids.append(id)
        self.hashes.append(hash)
        return True

    def add(self, text: np.ndarray, pos: np.ndarray, keys: list[np.ndarray]):
        self.rows.append((text, pos, *keys))
        self.size += len(text)

    def dealt(self):
        """The record batch of all that was added: a row for each bucket that gets any."""
        import pyarrow as pa

        text, pos, *keys = (np.concatenate(x) for x in zip(*self.rows))
        ids, hashes = np.array(self.ids, dtype=np.int64), np.array(self.hashes, dtype=np.int64)
        own = ids[text]
        sure = self.rule(own, np.zeros(len(own), dtype=bool), *keys)
        # by the upper half of the key; what is settled goes anywhere, but for one of each shared key
        bucket = ((keys[0] >> U(32)) * U(self.buckets)) >> U(32)
        free = sure.copy()
        if self.rule is _shared:
            order, first = _groups(*keys)
            free[order[first]] = False
        anywhere = mix(np.arange(len(text), dtype=np.uint64)) % U(self.buckets)
        bucket = np.where(free, anywhere, bucket).astype(np.int32)

        order = np.argsort(bucket, kind="stable")  # by document and place within
        bucket, text, pos, sure = bucket[order], text[order], pos[order], sure[order]
        # the lower half tells anchors of a bucket apart but for a few, which cost a comparison
        key = keys[0][order].astype(np.uint32) if self.rule is _shared else keys[1][order]
        turn = np.ones(len(text), dtype=bool)
        turn[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
        runs = np.flatnonzero(turn)
        counts = np.diff(np.append(runs, len(text))).astype(np.int32)
        begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        of = np.searchsorted(runs, begins)
        columns = [_blobs(x[text[runs]], of) for x in (ids, hashes)]
        # halves of the places apart: most upper ones are 0 and leave no trace in a compressed shuffle
        halves = [(pos >> 16).astype(np.uint16), pos.astype(np.uint16)]
        columns += [_blobs(counts, of), *[_blobs(x, begins) for x in (*halves, sure.view(np.uint8), key)]]
        out = pa.RecordBatch.from_arrays([pa.array(bucket[begins]), *columns], names=["bucket", *_DEALT])
        self.clear()
        return out


def _places(lists):
    """Text number and word number of each entry of a column of arrays; null is empty."""
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(counts)), counts), lists.flatten().to_numpy(zero_copy_only=False)


def _slices(batch, sizes: np.ndarray):
    """Parts of an Arrow batch with ``PART`` bytes of text, or a single row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + PART, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _words(batches, all: "_Batch", window: int, key_rows):
    """Runs ``key_rows`` over the words of each part of the batches, and deals out what it adds.

    Rows without an id, a text, or ``at`` where there is such a column, add nothing.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for name in [c for c in ("id", "text", "at") if c in batch.schema.names]:
            batch = batch.filter(pc.is_valid(batch[name]))
        sizes = np.diff(texts_of(batch["text"])[1])
        for part in _slices(batch, sizes):
            fresh = [k for k, (i, h) in enumerate(zip(part["id"].to_pylist(), part["hash"].to_pylist())) if all.new(i, h)]
            if not fresh:
                continue
            part = part.take(pa.array(fresh)) if len(fresh) < part.num_rows else part
            words, first = hash_words(*texts_of(part["text"]), SPACE, _EXACT)
            text, pos, keys = key_rows(words, first, part)
            all.add(text + len(all.ids) - part.num_rows, pos, keys)
            if all.size >= TOGETHER:
                yield all.dealt()
        if all.size == 0:
            all.clear()
    if all.size:
        yield all.dealt()


def _anchor_rows(window: int, buckets: int):
    def rows(words, first, part):
        text, pos, key = _anchors(words, first, window)
        return text, pos, [key]

    return lambda batches: _words(batches, _Batch(buckets, _shared), window, rows)


def _window_rows(window: int, buckets: int, place: int):
    """The windows around the shared anchors of each document, whose places are in ``at``.

    The text is the field of ``row`` at ``place``.
    """
    reach = shape(window)[0]

    def rows(words, first, part):
        starts = np.zeros(first[-1] + 1, dtype=np.int32)
        text, at = _places(part["at"])
        # a window holds an anchor that begins at one of its first words, as many as the period
        np.add.at(starts, first[text] + np.maximum(at - reach + 1, 0), 1)
        np.add.at(starts, np.minimum(first[text] + at, first[text + 1] - window) + 1, -1)
        at = np.flatnonzero(np.cumsum(starts)[:-1])
        text = np.searchsorted(first, at, side="right") - 1
        return text, at - first[text], [_hash(words, at, window, base) for base in (_LOW, _HIGH)]

    def unpacked(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            texts = pc.struct_field(batch["row"], [place])
            yield pa.RecordBatch.from_arrays([batch["id"], batch["hash"], texts, batch["at"]], names=["id", "hash", "text", "at"])

    return lambda batches: _words(unpacked(batches), _Batch(buckets, _later), window, rows)


def _settled(rule):
    """Of a bucket the records that the rule picks: places of each document."""

    def run(table):
        import pyarrow as pa

        counts = _whole(table, "counts", np.int32)
        document = np.repeat(np.arange(len(counts)), counts)
        ids, hashes = _whole(table, "ids", np.int64)[document], _whole(table, "hashes", np.int64)[document]
        pos = _whole(table, "upper", np.uint16).astype(np.int32) << 16 | _whole(table, "lower", np.uint16)
        some = rule(ids, _whole(table, "sure", bool), _whole(table, "key", np.uint32 if rule is _shared else np.uint64))
        ids, hashes, pos = ids[some], hashes[some], pos[some]
        order, first = _groups(ids, hashes, pos)
        return pa.table({c: x[order][first] for c, x in (("id", ids), ("hash", hashes), ("at", pos))})

    return run


def _met(rows: DataFrame, rule) -> DataFrame:
    """``(id, hash, at)``: all places of a document that the rule picks, in an array."""
    found = rows.groupBy("bucket").applyInArrow(_settled(rule), "id long, hash long, at int")
    return found.groupBy("id", "hash").agg(F.collect_list("at").alias("at"))


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``hash`` of the text, and a struct ``row`` of all columns, the text as a string."""
    own = column(text).cast("string")
    row = F.struct(*[own.alias(c) if c == text else column(c) for c in docs.columns])
    return docs.select(column(id).cast("long").alias("id"), F.xxhash64(own).alias("hash"), row.alias("row"))


def repeated_windows(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """``(id, hash, at)``: of each document the word numbers, from 0, at which windows begin that a smaller id has.

    ``hash`` is ``xxhash64`` of the text; ``at`` is an array in no order.  Rows of the same id
    and text are one document.
    """
    ship(docs.sparkSession)
    keyed = _keyed(docs, id, text)
    texts = keyed.select("id", "hash", F.col("row")[text].alias("text"))
    buckets = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET
    kind = ", ".join(["bucket int", *[f"{c} binary" for c in _DEALT]])
    anchors = texts.mapInArrow(_anchor_rows(window, buckets), kind)
    shared = _met(anchors, _shared)
    # all columns, and an outer join, to be the very shuffle that :func:`without_repeats` reads again
    near = keyed.join(shared, ["id", "hash"], "left").select("id", "hash", "row", "at")
    return _met(near.mapInArrow(_window_rows(window, buckets, docs.columns.index(text)), kind), _later)


def _kept(window: int):
    """Text without the words that the windows cover, joined by one space, and two counts."""

    def parts(texts, lists):
        buf, at = texts_of(texts)
        inside = ~SPACE[buf]
        begins = np.zeros(len(buf) + 1, dtype=bool)
        begins[at] = True
        starts = np.flatnonzero(inside & np.append(True, ~inside[:-1] | begins[1 : len(buf)])) if len(buf) else np.zeros(0, np.int64)
        stops = np.flatnonzero(inside & np.append(~inside[1:] | begins[1 : len(buf)], True)) + 1 if len(buf) else np.zeros(0, np.int64)
        first = np.searchsorted(starts, at)
        depth = np.zeros(len(starts) + 1, dtype=np.int32)
        text, gone = _places(lists)
        np.add.at(depth, first[text] + gone, 1)
        np.add.at(depth, first[text] + gone + window, -1)
        stays = np.cumsum(depth)[:-1] == 0
        total = np.concatenate(([0], np.cumsum(stays)))
        left = total[first[1:]] - total[first[:-1]]
        # a word goes out with the blank behind it, but for the last of its text
        last = np.zeros(len(starts), dtype=bool)
        kept = np.flatnonzero(stays)
        last[kept[(total[first[1:]] - 1)[left > 0]]] = True
        edges = np.zeros(len(buf) + 2, dtype=np.int8)
        edges[starts[kept]] += 1
        np.subtract.at(edges, stops[kept] + ~last[kept], 1)
        chosen = np.cumsum(edges[: len(buf)]) > 0
        out = np.where(inside, buf, np.uint8(32))[chosen]
        ends = np.concatenate(([0], np.cumsum(chosen)))[at]
        return out, ends, np.diff(first), np.diff(first) - left

    @F.arrow_udf("struct<kept: string, words: long, removed: long>")
    def run(texts, places):
        import pyarrow as pa

        made = []
        sizes = np.diff(texts_of(texts)[1])
        batch = pa.RecordBatch.from_arrays([texts, places], names=["text", "at"])
        for part in _slices(batch, sizes):
            out, ends, words, removed = parts(part["text"], part["at"])
            kept = pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(out))])
            made.append(pa.StructArray.from_arrays([kept, pa.array(words), pa.array(removed)], names=["kept", "words", "removed"]))
        kind = pa.struct([("kept", pa.string()), ("words", pa.int64()), ("removed", pa.int64())])
        return pa.concat_arrays(made) if made else pa.array([], kind)

    return run


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """All columns, the text as the words kept, joined by one space, and ``n_words, n_removed``.

    Words are what white space of ASCII separates, compared as they stand.  A word goes if a
    window of ``window`` words covers it whose words also stand, in a row, in a document with
    a smaller id; windows are judged on the texts as given.  So the smallest id keeps a
    passage, also where it holds it twice; rows that share an id take nothing from each other.

    Ids are whole numbers; a row with a null one keeps its words, and takes none.  A null text
    stays null with no words, one without words becomes empty.  Texts with fewer words than a
    window stay whole.  Windows are equal if two 64-bit hashes of their words' hashes are.
    Names that are taken get a leading underscore.
    """
    found = repeated_windows(docs, id, text, window)
    joined = _keyed(docs, id, text).join(found, ["id", "hash"], "left")
    made = joined.select("row", _kept(window)(F.coalesce(F.col("row")[text], F.lit("")), F.col("at")).alias("made"))
    cell = lambda c: F.col("row")[c]
    return made.select(
        *[F.when(cell(c).isNotNull(), F.col("made.kept")).alias(c) if c == text else cell(c).alias(c) for c in docs.columns],
        F.col("made.words").alias(free_name(docs, "n_words")),
        F.col("made.removed").alias(free_name(docs, "n_removed")),
    )
