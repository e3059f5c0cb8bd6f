"""Deletes runs of lines that stood earlier in the corpus, found by winnowing.

From each line that is not blank a window reaches just so far that it holds ``words``
words.  Of the line hashes in a window the least one is its fingerprint, so any two equal
windows select the same line: a repeated run of that many words cannot be missed.

1. A position is kept once with all the windows that select it (they follow one another),
   so a text leaves one row for each fingerprint.  Most fingerprints are in one place only,
   and those rows are done.
2. Positions with a shared fingerprint are joined and the match is extended from there to
   both sides: each window around the position meets the earliest equal one.
3. Windows that occurred earlier (by id, then line) are deleted; those that touch or
   overlap join.

A match of ``words`` words begins with a window, so it is whole on its left.  On its right
it may go on by fewer than ``words`` words.  With ``grow`` the last window of each matched
run therefore grows line by line, as far as the window after it would reach, and what occurred
earlier too, wherever, is deleted.  A window whose next one is deleted needs no growth, as the next one
covers all lines that it could gain, unless blank lines lie between the two.  So all of every
equal run of that many words goes.

Only DataFrame operations; hashes and positions are shuffled, texts once, for the result.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, column, free_name

#: Fixed value: white space at the ends of a line that does not count.
EDGES = " \t\r"


def _lines(text):
    line = lambda raw: F.btrim(raw, F.lit(EDGES))
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    told = F.transform(
        F.split(text, "\n", -1),
        lambda raw, k: F.struct(k.alias("pos"), F.xxhash64(line(raw)).alias("hash"), F.when(line(raw) != "", blanks(line(raw)) + 1).otherwise(0).alias("words")),
    )
    return F.filter(told, lambda x: x["words"] > 0)


def _beyond(one, words: int):
    """The lines that a window may grow by, and some of its own, in order."""
    line = F.struct("pos", "hash")
    after = one.orderBy(F.col("before") + F.col("words"))
    near = F.collect_list(line).over(after.rangeBetween(0, words - 1))
    # a line of so many words is a window by itself, and grows by any one line
    next = F.lead(line).over(one.orderBy("before"))
    return F.when((F.size(near) > 1) | next.isNull(), near).otherwise(F.array(next))


def repeated_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 40, grow: bool = False) -> DataFrame:
    """``(id, text_hash, runs)`` for documents with lines to delete.

    ``runs`` is an array of (first, last) line numbers from 0, in order.  Rows of the
    same id and text are one document.  Null and empty texts have no runs.  Without
    ``grow`` only whole windows count.
    """
    scratch = Scratch(docs.sparkSession)
    told = docs.select(column(id).alias("id"), F.xxhash64(column(text)).alias("text_hash"), _lines(column(text)).alias("lines"))
    told = told.where(F.size("lines") > 0).groupBy("id", "text_hash").agg(F.first("lines").alias("lines"))
    told = told.select("id", "text_hash", F.inline("lines"))
    one = Window.partitionBy("id", "text_hash")
    told = told.withColumn("before", F.sum("words").over(one.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
    reach = one.orderBy("before").rangeBetween(0, words - 1)
    hashes = F.collect_list("hash").over(reach)
    windows = told.select(
        "id",
        "text_hash",
        "pos",
        F.max("pos").over(reach).alias("last"),
        F.lead("pos").over(one.orderBy("before")).alias("next"),
        F.min(F.struct("hash", "pos")).over(reach).alias("print"),
        F.xxhash64(hashes).alias("k1"),
        F.xxhash64(F.lit(1), hashes).alias("k2"),
        F.sum("words").over(reach).alias("held"),
        *([_beyond(one, words).alias("beyond")] if grow else []),
    ).where(F.col("held") >= words)
    window = ["pos", "last", "next", "k1", "k2"]
    if grow:
        windows = windows.withColumn("beyond", F.filter("beyond", lambda x: x["pos"] > F.col("last")))
        window.append("beyond")
    anchors = windows.groupBy("id", "text_hash", F.col("print.hash").alias("print"), F.col("print.pos").alias("at"))
    anchors = scratch.table(anchors.agg(F.collect_list(F.struct(*window)).alias("windows")))

    place = F.struct("id", "text_hash", "at")
    shared = anchors.groupBy("print").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high")
    near = scratch.table(anchors.join(shared.select("print"), "print").select("id", "text_hash", F.inline("windows")))
    place, key = F.struct("id", "pos", "text_hash"), ["k1", "k2"]

    def repeats(df, key):
        """Rows of which an earlier one has the same key."""
        origin = df.groupBy(*key).agg(F.min(place).alias("origin"), F.max(place).alias("end")).where("origin < end")
        return df.join(origin.select(*key, "origin"), key).where(place != F.col("origin"))

    later = repeats(near.select("id", "text_hash", *window[:5]), key).select("id", "text_hash", *window[:5])
    if grow:
        later = scratch.table(later)
        following = F.lead("pos").over(one.orderBy("pos"))
        last = ~F.col("following").eqNullSafe(F.col("next")) | (F.col("next") > F.col("last") + 1)
        ends = later.withColumn("following", following).where(last).select(*key).distinct()
        ends = near.where(F.size("beyond") > 0).join(ends, key, "left_semi").withColumn("hashes", F.col("beyond.hash"))
        grown = F.transform("beyond", lambda x, k: F.struct(x["pos"].alias("last"), F.xxhash64(F.slice("hashes", F.lit(1), k + 1)).alias("more")))
        ends = scratch.table(ends.select("id", "text_hash", "pos", *key, F.inline(grown)))
        later = later.select("id", "text_hash", "pos", "last").union(repeats(ends, [*key, "more"]).select("id", "text_hash", "pos", "last"))

    # windows that touch or overlap become one run
    seen = F.max("last").over(one.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("new", F.when(F.col("pos") <= seen + 1, 0).otherwise(1))
    later = later.withColumn("run", F.sum("new").over(one.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    runs = later.groupBy("id", "text_hash", "run").agg(F.min("pos").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 40, grow: bool = False) -> DataFrame:
    """All columns, the text without its repeated runs, and two counts more.

    ``n_lines`` counts all lines of the text, ``n_removed`` those deleted (blank lines
    inside a run too).  The first occurrence in order of id and line stays.  With ``grow``
    no line with words is left of a copy of an earlier document that holds ``words`` words;
    without it only whole windows go, so its last lines may stay.  A null text stays null
    with no lines.  Names that are taken get a leading underscore.
    """
    runs = repeated_runs(docs, id, text, words, grow)
    own_id, own_hash, own_runs = (free_name(docs, c) for c in ("own_id", "own_hash", "own_runs"))
    runs = runs.select(F.col("id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("runs").alias(own_runs))
    found = docs.join(runs, column(id).eqNullSafe(F.col(own_id)) & (F.xxhash64(column(text)) == F.col(own_hash)), "left")
    lines = F.split(column(text), "\n", -1)
    kept = F.filter(lines, lambda _, k: ~F.exists(own_runs, lambda r: (k >= r["first"]) & (k <= r["last"])))
    gone = F.aggregate(own_runs, F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    count, removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    new = F.when(F.col(own_runs).isNull(), column(text)).otherwise(F.array_join(kept, "\n"))
    return found.select(
        *[new.alias(c) if c == text else column(c) for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(count),
        F.coalesce(gone, F.lit(0)).cast("long").alias(removed),
    )
