"""Counts the pieces of a unigram tokenizer without making them.

An Aho-Corasick automaton lists every vocabulary piece that occurs in a word; dynamic
programming over the ends carries the best score and the number of pieces of the best
path.  Ties go as in the tokenizer: starts are visited from left to right, at each start
shorter pieces first, and a later path replaces an earlier one only if its score is
greater.  A character that no piece covers alone costs the unknown score; neighbouring
unknown characters are one piece, or one for each byte with byte fallback.

Texts are cut before each space (written as U+2581), so a word's count depends on the
word alone; counts of distinct words are kept, in a table of bounded size.
"""

import hashlib
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import column, free_name, shared_file, ship

SPACE = "▁"
#: Taken from the least score for an unknown character, a fixed value of the tokenizer.
UNKNOWN_PENALTY = 10.0
#: Counts kept between batches; beyond it the younger half goes, as frequent words come early.
MOST_WORDS = 500_000
_LOADED: dict[str, "Counter"] = {}


def vocabulary(raw: bytes) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, in order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=raw)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        names = {piece for piece, _ in pieces}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        scores = {}
        for piece, score in pieces:  # of equal pieces the last id counts
            scores[piece] = score
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of one word.

        The automaton lists matches by their end; ordered by start, then length, they
        are met in the tokenizer's order, so that a path is replaced under the same rule.
        """
        n = len(word)
        starts: list[list] = [[] for _ in range(n)]
        for end, (size, score) in self.automaton.iter(word):
            starts[end - size + 1].append((size, score))
        best: list[float | None] = [None] * (n + 1)
        count, run = [0] * (n + 1), [0] * (n + 1)  # run: bytes of the unknown piece that ends here
        best[0] = 0.0
        for at, found in enumerate(starts):
            here = best[at]
            alone = False
            for size, score in sorted(found):
                alone = alone or size == 1
                to, total = at + size, here + score
                if best[to] is None or total > best[to]:
                    best[to], count[to], run[to] = total, count[at] + 1, 0
            if not alone:
                to, total = at + 1, here + self.unknown
                if best[to] is None or total > best[to]:
                    width = len(word[at].encode())
                    more = width if self.bytes else int(run[at] == 0)
                    best[to], count[to], run[to] = total, count[at] + more, run[at] + width
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        total, known, at = 0, self.known, 1 if text[0] == SPACE else 0
        # words of a long text are taken in stretches that end before a space
        while at <= len(text):
            stop = text.find(SPACE, at + (1 << 18)) if len(text) - at > 1 << 18 else -1
            stop = len(text) if stop < 0 else stop
            words = text[at:stop].split(SPACE)
            if new := {w for w in words if w not in known}:
                if len(known) > MOST_WORDS:
                    kept = dict(islice(known.items(), MOST_WORDS // 2))
                    known.clear()
                    known.update(kept)
                    new = {w for w in words if w not in known}
                for w in new:
                    known[w] = self.word(SPACE + w)
            total += sum(map(known.__getitem__, words))
            at = stop + 1
        return total


def counter(raw: bytes) -> Counter:
    key = hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Counter(vocabulary(raw))
    return _LOADED[key]


def counted(df: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """All columns and the number of pieces of the whole text as ``into``.

    The vocabulary file's pieces and scores are those of the unigram model.  A null or
    empty text has none.  A name that is taken gets a leading underscore.
    """
    spark = df.sparkSession
    ship(spark)
    held = shared_file(spark, path)

    @F.arrow_udf("long")
    def count(texts):
        import pyarrow as pa

        own = counter(held.value)
        return pa.array([own.text(x.as_py()) for x in texts], pa.int64())

    return df.withColumn(free_name(df, into), count(column(text).cast("string")))
