"""Byte-level BPE by depth-first traversal of a trie of the distinct words.

A sequence of tokens is what BPE produces exactly if each two neighbours are what BPE
produces for their joined bytes, and every text has one such sequence.  So the last token
of each prefix is determined: of the tokens that end the prefix, the one that may follow
the last token of what stands before it.  In the trie of the distinct words a node's last
token depends on its path alone.  Sorted words visit the trie depth first, with the nodes
of the path on a stack; a node is computed once for all words that share the prefix, and
a word's encoding is read back along the path from its last node.
"""

import hashlib
import json
import re
from array import array
from itertools import chain, filterfalse, islice

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.llm.common import column, free_name, shared_file, ship, text_slices

#: Fixed value: the published split pattern of this family of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept between batches in each of two tables, and half the pairs of tokens: some 200 MB in
#: all; beyond it the younger half of the words goes, as frequent words come early.
MOST_WORDS = 500_000
#: Characters of the texts whose new words are encoded together; a longer text is one by itself.
TOGETHER = 4_000_000
#: Bytes of text that go through a worker at a time, or one text.
SLICE = 4 << 20
#: The white space of the pattern but the space itself.
WHITE = "\t\n\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: ASCII punctuation but the apostrophe, which the pattern treats in its own way.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this are the same in all versions of Unicode at hand.
SETTLED = "\u0250"
_LOADED: dict = {}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, how each was merged, and the encodings of words met so far."""

    def __init__(self, raw: bytes):
        import regex

        self.most = MOST_WORDS
        spec = json.loads(raw)
        letters = byte_letters()
        read = lambda t: bytes(letters[c] for c in t)
        ids = {read(t): k for t, k in spec["model"]["vocab"].items()}
        self.bytes = {k: t for t, k in ids.items()}
        self.rank: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault((ids[read(a)], ids[read(b)]), r)
        # of each token that BPE makes of its own bytes, its last merge
        self.made: dict[int, tuple[int, int, int]] = {}
        self.ids = ids
        # trie of the tokens' bytes, last byte first: node << 8 | byte to node, and the token of each node
        self.back: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for t, k in ids.items():
            if (last := self._last_merge(t)) is None:
                continue
            self.made[k] = last
            node = 0
            for b in reversed(t):
                node = self.back.setdefault(node << 8 | b, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = k
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = added
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.split = regex.compile(PATTERN)
        self.pairs: dict[int, bool] = {}
        self.fresh()

    def fresh(self):
        # encodings as the bytes of 32-bit ids: of whole strings, and of strings with a
        # space before them
        self.plain: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def _last_merge(self, t: bytes):
        """``(rank, left, right)`` of the merge that completes the token; None if another encoding wins."""
        parts, last = [self.ids[t[k : k + 1]] for k in range(len(t))], (-1, -1, -1)
        want = self.ids[t]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                return None
            k = ranks.index(best)
            last = (best, parts[k], parts[k + 1])
            parts[k : k + 2] = [self.ids[self.bytes[parts[k]] + self.bytes[parts[k + 1]]]]
        return last if parts == [want] else None

    def follows(self, a: int, b: int) -> bool:
        """Whether BPE leaves the border between these tokens alone.

        Goes back in time: the piece that was merged last is taken apart again, and at
        each moment the two pieces at the border must not have had an earlier merge.  Of
        two equal merges the left one comes first.
        """
        x, y, limit, ok = a, b, 1 << 60, True
        while True:
            if self.rank.get((x, y), 1 << 60) < limit:
                ok = False
                break
            of_x, of_y = self.made[x], self.made[y]
            if of_x[0] > of_y[0]:
                limit, x = of_x[0], of_x[2]
            elif of_y[0] >= 0:
                limit, y = of_y[0] + 1, of_y[1]
            else:
                break
        if len(self.pairs) > 2 * self.most:
            self.pairs.clear()
        self.pairs[a << 32 | b] = ok
        return ok

    def walk(self, words) -> dict[str, bytes]:
        """Encodes pieces, depth first through their trie: sorted, with the path on a stack."""
        back, ends, follows, pairs, out = self.back, self.ends, self.follows, self.pairs, {}
        last, begin = [-1], [-1]  # for each depth: the last token of that prefix, and where it begins
        before = b""
        for data, word in sorted((w.encode(), w) for w in words):
            shared = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :]
            for i in range(shared, len(data)):
                node, j = 0, i
                while True:  # ends, as every text has an encoding
                    node = back[node << 8 | data[j]]
                    token = ends[node]
                    if token >= 0:
                        if not j:
                            break
                        ok = pairs.get(last[j] << 32 | token)
                        if ok or ok is None and follows(last[j], token):
                            break
                    j -= 1
                last.append(token)
                begin.append(j)
            tokens, at = [], len(data)
            while at:
                tokens.append(last[at])
                at = begin[at]
            out[word] = array("i", tokens[::-1]).tobytes()
            before = data
        return out

    def trim(self) -> None:
        for table in (self.plain, self.spaced):
            if len(table) > self.most:
                kept = dict(islice(table.items(), self.most // 2))
                table.clear()
                table.update(kept)

    def learn(self, plain, spaced) -> None:
        """Encodes strings that are not known yet, all at once.

        Letters are one piece, and so are the marks after them.  The pieces of longer strings
        are kept as strings of their own: the pattern takes a piece that stands alone as it
        took it among others.
        """
        cut, parts, words, new = self.split.findall, [], set(), set()
        for table, strings, lead in ((self.plain, plain, ""), (self.spaced, spaced, " ")):
            for s in strings:
                core = s.rstrip(MARKS)
                if not core.isalpha() or not core.isascii() and max(core) >= SETTLED:
                    found = cut(lead + s)
                elif len(core) == len(s):
                    new.add(lead + s)
                    continue
                else:
                    found = (lead + core, s[len(core) :])
                words.update(found)
                parts.append((table, s, found))
        pieces, own, after = {}, self.plain, self.spaced
        for x in words - new:
            known = after.get(x[1:]) if x[0] == " " and len(x) > 1 else own.get(x)
            if known is None:
                new.add(x)
            else:
                pieces[x] = known
        made = self.walk(new)
        for x, ids in made.items():
            if x[0] == " " and not x[1:2].isspace() and len(x) > 1:
                after[x[1:]] = ids
            else:
                own[x] = ids
        pieces.update(made)
        for table, s, found in parts:
            table[s] = b"".join([pieces[x] for x in found])

    def strings(self, text: str):
        """The text in strings that are encoded alone: ``(special id, strings, whether spaces stood between)``.

        Where every space stands between two characters that are no white space, the
        pattern begins a piece at each, so the text is cut there first; other texts are
        cut by the pattern.
        """
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                yield self.special[part], [], False
            elif not part:
                continue
            elif part[0].isspace() or part[-1].isspace() or "  " in part or any(w in part and (f" {w}" in part or f"{w} " in part) for w in WHITE):
                yield None, [m[0] for m in self.split.finditer(part)], False
            else:
                yield None, part.split(" "), True

    def encode_all(self, texts):
        """The ids of each text; the new words of a stretch of texts are encoded together."""
        stretch, size = [], 0
        for text in texts:
            if stretch and size + len(text) > TOGETHER:
                yield from self._encode(stretch)
                stretch, size = [], 0
            stretch.append(text)
            size += len(text)
        yield from self._encode(stretch)

    def _encode(self, texts):
        self.trim()
        plain, spaced, parts = set(), set(), []
        for text in texts:
            parts.append(list(self.strings(text)))
            for _, found, between in parts[-1]:
                if between:
                    plain.add(found[0])
                    spaced.update(filterfalse(self.spaced.__contains__, islice(found, 1, None)))
                else:
                    plain.update(found)
        self.learn({s for s in plain if s not in self.plain}, spaced)
        return map(self._join, parts)

    def _join(self, parts) -> np.ndarray:
        out = []
        for special, found, between in parts:
            if special is not None:
                out.append(np.int32(special).tobytes())
            elif between:
                out.append(b"".join(chain((self.plain[found[0]],), map(self.spaced.__getitem__, islice(found, 1, None)))))
            else:
                out.extend(map(self.plain.__getitem__, found))
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


class Reader:
    """The bytes of each token."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        letters = byte_letters()
        self.bytes = {k: bytes(letters[c] for c in t) for t, k in spec["model"]["vocab"].items()}
        self.bytes |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def loaded(raw: bytes, kind=Vocabulary):
    """A vocabulary or reader of this worker, made once."""
    key = kind.__name__ + hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        for other in [k for k in _LOADED if k.startswith(kind.__name__)]:
            del _LOADED[other]
        _LOADED[key] = kind(raw)
    return _LOADED[key]


def as_lists(got):
    """Arrays of ids as an Arrow column."""
    import pyarrow as pa

    at = np.concatenate(([0], np.cumsum([len(x) for x in got]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.int32), *got])))


def read_back(reader: Reader, lists):
    """The text of each list of an Arrow column."""
    import pyarrow as pa

    values = lists.values
    values = values.fill_null(-1) if values.null_count else values
    values, at = values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    return pa.array([reader.decode(values[s:e].tolist()) if ok else None for s, e, ok in zip(at[:-1], at[1:], valid)], pa.string())


def _ids(vocabulary: Vocabulary, texts):
    return as_lists(list(vocabulary.encode_all(t or "" for t in map(lambda x: x.as_py(), texts))))


def codec(spark: SparkSession, path: str):
    """``(encode, decode)``: functions from a string column to array<int>, and back.

    The first is marked as not deterministic: Spark may copy a deterministic expression into
    each of its uses, and a text would be encoded more than once.
    """
    ship(spark)
    held = shared_file(spark, path)

    @F.arrow_udf("array<int>")
    def encoded(texts):
        return _ids(loaded(held.value), texts)

    @F.arrow_udf("string")
    def decoded(lists):
        return read_back(loaded(held.value, Reader), lists)

    return encoded.asNondeterministic(), decoded


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """All columns and the token ids of the whole text as ``into`` (array<int>).

    Special strings in a text are their tokens; nothing is added, cut or padded.  A null
    or empty text has no ids.  A name that is taken gets a leading underscore.
    """
    encoded, _ = codec(df.sparkSession, path)
    return df.withColumn(free_name(df, into), encoded(column(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and the text of the ids as ``into``; null ids give null, none give an empty text.

    Bytes that are no UTF-8 become U+FFFD.  An unknown id is an error.
    """
    _, decoded = codec(df.sparkSession, path)
    return df.withColumn(free_name(df, into), decoded(column(ids)))


def round_trip(
    df: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    words: int = MOST_WORDS,
    size: int = SLICE,
) -> DataFrame:
    """``decode`` of ``encode``, in one Python worker: the ids do not travel between the two.

    A worker holds the ids and the decoded texts of ``size`` bytes of text, and hands them on;
    ``words`` bounds what it keeps between them.  Less of both takes less memory and more time.
    """
    spark = df.sparkSession
    ship(spark)
    held = shared_file(spark, path)
    place, names = df.columns.index(text), [free_name(df, ids), free_name(df, decoded)]
    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.ArrayType(T.IntegerType())), T.StructField(names[1], T.StringType())])

    def run(batches):
        import pyarrow as pa

        vocabulary, reader = loaded(held.value), loaded(held.value, Reader)
        vocabulary.most = words
        for batch in batches:
            for start, stop in text_slices(batch.column(place), size, size):
                part = batch.slice(start, stop - start)
                lists = _ids(vocabulary, part.column(place))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, read_back(reader, lists)], names=schema.names)

    return df.mapInArrow(run, schema)


def joined(ids: Column) -> Column:
    """Decimal ids, joined by commas."""
    return F.concat_ws(",", ids.cast("array<string>"))
