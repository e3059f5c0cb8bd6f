"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  A line's evidence is linear in its own features and in those
of the line before and after; neighbouring labels are tied by two transition weights.
Forward-backward gives each line's probability of being good, and a document's score is
the mean of these, weighted by the lines' lengths.

The field is fitted by gradient ascent on a bounded, documented sample of labelled
documents, whose lines all carry the document's label.  Scoring covers every whole text.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import SPACE, U, column, free_name, hash_words, mix, ship, text_slices, texts_of

#: At most so many labelled documents are used to fit, chosen by a hash of their id.
MOST_DOCS = 8_000
#: While fitting, longer documents are cut into stretches of so many lines.
STRETCH = 64
#: Stretches of a document used to fit, chosen by a hash of their number; most documents have fewer.
MOST_STRETCHES = 8

_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[10] = True


def _bytes(*spans) -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    for a, b in spans:
        out[a : b + 1] = 1
    return out


_LOWER = _bytes((97, 122))
_UPPER = _bytes((65, 90))
_WIDE = _bytes((192, 255))  # first bytes of letters beyond ASCII
_DIGIT = _bytes((48, 57))
_STOP = _bytes((33, 33), (44, 44), (46, 46), (58, 59), (63, 63))
_MARK = _bytes((35, 38), (42, 43), (47, 47), (60, 62), (64, 64), (91, 96), (123, 123), (125, 126))
_CRY = _bytes((33, 33))
_BAR = _bytes((124, 124))
_CLASSES = (_LOWER, _UPPER, _WIDE, _DIGIT, _STOP, _MARK, _CRY, _BAR)
FEATURES = len(_CLASSES) + 5


def line_features(buf: np.ndarray, at: np.ndarray):
    """``(features, lengths, first)``: a row for each line that is not blank, text after text.

    A text without such a line has one row of zeros and weight one, so every text has a
    score.
    """
    n = len(buf)
    begins = np.zeros(n + 1, dtype=bool)
    begins[at] = True
    # a line starts at a text's start or after a newline
    cut = np.flatnonzero(np.concatenate(([True], buf[:-1] == 10)) | begins[:n]) if n else np.zeros(0, np.int64)
    stop = np.concatenate((cut[1:], [n])).astype(np.int64)
    counts = [np.add.reduceat(c[buf], cut, dtype=np.int32) for c in _CLASSES] if n else []
    blank = np.add.reduceat(SPACE.astype(np.uint8)[buf], cut, dtype=np.int32) if n else np.zeros(0, np.int32)
    size = stop - cut
    used = blank < size
    owner = np.searchsorted(at, cut, side="right") - 1
    words, _ = hash_words(buf, at)
    inside = ~SPACE[buf]
    edge = inside.copy()
    if n:
        edge[1:] &= ~inside[:-1] | begins[1:n]
    word_at = np.flatnonzero(edge)
    again = np.zeros(len(words), dtype=np.float64)
    again[1:] = words[1:] == words[:-1]
    first_word = np.searchsorted(word_at, cut)
    n_words = np.diff(np.concatenate((first_word, [len(words)])))
    sums = np.concatenate(([0.0], np.cumsum(again)))
    last_word = first_word + n_words
    repeats = np.where(n_words > 1, sums[last_word] - sums[np.minimum(first_word + 1, last_word)], 0)
    length = np.maximum(size, 1).astype(np.float64)
    told = [c / length for c in counts] + [
        np.log1p(length) / 8,
        np.log1p(n_words) / 6,
        repeats / np.maximum(n_words - 1, 1),
        n_words / length,
        np.minimum(length / np.maximum(n_words, 1), 40) / 40,
    ]
    told = np.stack(told, axis=1)[used] if n else np.zeros((0, FEATURES))
    owner, weight = owner[used], (size - blank)[used].astype(np.float64)
    lines = np.bincount(owner, minlength=len(at) - 1)
    empty = np.flatnonzero(lines == 0)
    if len(empty):
        order = np.argsort(np.concatenate((owner, empty)), kind="stable")
        told = np.concatenate((told, np.zeros((len(empty), FEATURES))))[order]
        weight = np.concatenate((weight, np.ones(len(empty))))[order]
        lines[empty] = 1
    return told, weight, np.concatenate(([0], np.cumsum(lines))).astype(np.int64)


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the line before and after it in its text, then one."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate((x, before, after, np.ones((len(x), 1))), axis=1)


def forward_backward(evidence: np.ndarray, first: np.ndarray, good: float, bad: float):
    """Log odds of each line being good: from the lines up to it, and from those after it.

    ``good`` and ``bad`` are the weights of staying at that label.  All texts move on
    together, a line at a time.
    """
    lines = np.diff(first)
    order = np.argsort(-lines, kind="stable")
    start, left = first[:-1][order], lines[order]
    ahead, behind = np.zeros(len(evidence)), np.zeros(len(evidence))
    live = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
    for t, n in enumerate(live):
        at = start[:n] + t
        if t:
            prior = ahead[at - 1]
            ahead[at] = evidence[at] + np.logaddexp(prior + good, 0) - np.logaddexp(prior, bad)
        else:
            ahead[at] = evidence[at]
    last = first[1:][order] - 1
    for t, n in enumerate(live):
        if t:
            at = last[:n] - t
            later = evidence[at + 1] + behind[at + 1]
            behind[at] = np.logaddexp(later + good, 0) - np.logaddexp(later, bad)
    return ahead, behind


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(x: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = 250, ridge: float = 2e-3) -> dict:
    """Weights of the field; ``labels`` has one label for each text."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = with_neighbours((x - mean) / spread, first)
    lines = np.diff(first)
    y = np.repeat(labels, lines).astype(np.float64)
    inner = np.ones(len(x), dtype=bool)
    inner[first[1:] - 1] = False  # lines that another one of the text follows
    pairs = np.flatnonzero(inner)
    weights, stay = np.zeros(z.shape[1]), np.zeros(2)
    if len(np.unique(labels)) < 2:  # one class, or nothing to learn from
        weights[-1] = 4.0 * (2 * labels[0] - 1) if len(labels) else 0.0
        return {"mean": mean, "spread": spread, "weights": weights, "stay": stay}
    m, v = np.zeros(len(weights) + 2), np.zeros(len(weights) + 2)
    for step in range(1, steps + 1):
        evidence = z @ weights
        ahead, behind = forward_backward(evidence, first, *stay)
        mu = _sigmoid(ahead + behind)
        later = evidence[pairs + 1] + behind[pairs + 1]
        joint = np.stack((ahead[pairs] + later + stay[0], ahead[pairs], later, np.full(len(pairs), stay[1])))
        joint = np.exp(joint - joint.max(axis=0))
        joint /= joint.sum(axis=0)
        both = np.array([(y[pairs] - joint[0]).sum(), ((1 - y[pairs]) - joint[3]).sum()])
        gradient = np.concatenate((z.T @ (y - mu), both)) / len(x) - ridge * np.concatenate((weights, stay))
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        weights, stay = weights + move[:-2], stay + move[-2:]
    return {"mean": mean, "spread": spread, "weights": weights, "stay": stay}


def text_scores(model: dict, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    x, weight, first = line_features(buf, at)
    z = with_neighbours((x - model["mean"]) / model["spread"], first)
    ahead, behind = forward_backward(z @ model["weights"], first, *model["stay"])
    good = _sigmoid(ahead + behind)
    if not len(first) - 1:
        return np.zeros(0)
    return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def held_out(id: Column) -> Column:
    """Whether a document's label is kept back: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(False))


def _stretches(x: np.ndarray) -> list[np.ndarray]:
    """Rows of the lines in stretches, at most ``MOST_STRETCHES``, in order."""
    count = -(-len(x) // STRETCH)
    chosen = np.sort(np.argsort(mix(np.arange(count, dtype=np.uint64) + U(1)), kind="stable")[:MOST_STRETCHES])
    return [x[k * STRETCH : (k + 1) * STRETCH] for k in chosen]


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST_DOCS) -> dict:
    """Fits the field on at most ``most`` labelled documents that are not held out.

    The sample goes by a hash of the id; of rows that repeat an id the greatest text counts.
    Only line features reach the driver, a few dozen bytes for each line, of at most
    ``MOST_STRETCHES`` stretches of a document: 8,000 documents of 512 lines and more are
    some 200 MB, however long they are.  Documents with contradicting labels take the lower
    one; labels without a document or a value are passed over.
    """
    ship(docs.sparkSession)
    known = labels.select(column(id).alias("id"), column(label).cast("int").alias("y")).where("id is not null and y is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg((F.min("y") > 0).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(most)
    # bounded by ``most`` rows of two numbers
    sample = docs.select(column(id).alias("id"), column(text).cast("string").alias("text")).join(F.broadcast(known), "id")
    sample = sample.groupBy("id", "y").agg(F.max("text").alias("text"))

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            for start, stop in text_slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                x, _, first = line_features(*texts_of(part.column(1)))
                rows = [b"".join(s.astype(np.float32).tobytes() for s in _stretches(x[a:b])) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(rows, pa.binary())], names=["id", "y", "x"])

    got = sample.select("id", "text", "y").mapInArrow(features, "id long, y int, x binary").toArrow()
    order = np.argsort(np.asarray(got["id"]), kind="stable") if got.num_rows else []
    xs, ys, sizes = [], [], []
    for k in order:
        x = np.frombuffer(got["x"][int(k)].as_py(), dtype=np.float32).reshape(-1, FEATURES).astype(np.float64)
        for s in range(0, len(x), STRETCH):
            xs.append(x[s : s + STRETCH])
            ys.append(got["y"][int(k)].as_py())
            sizes.append(len(xs[-1]))
    first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return fit(np.concatenate(xs) if xs else np.zeros((1, FEATURES)), first if xs else np.array([0, 1]), np.array(ys or [0]) if xs else np.zeros(0))


def scored(docs: DataFrame, model: dict, text: str = "text", into: str = "score") -> DataFrame:
    """All columns and the score of the whole text, 0 to 1; a null or blank text is one empty line."""
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        out = [text_scores(model, *texts_of(texts.slice(a, b - a))) for a, b in text_slices(texts)]
        return pa.array(np.concatenate([np.zeros(0), *out]))

    return docs.withColumn(free_name(docs, into), score(column(text).cast("string")))
