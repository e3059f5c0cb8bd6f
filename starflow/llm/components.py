"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import Scratch


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of a link; the root is its component's least node.

    ``edges`` has columns ``u`` and ``v``.  Rounds of two steps, each an aggregate and
    an ordinary join, so a node with very many links is reduced before the shuffle and
    its join split by AQE: first every larger neighbour of a node is hung onto the least
    one, then every smaller one.  Rounds end when nothing changes; a component of size n
    takes about log n of them.  Each round is a written table.
    """
    ends = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = scratch.table(ends.distinct())
    before, mark = None, _mark(now)
    while mark != before and mark[0]:
        both = now.union(now.select("v", "u"))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.table(large.where("u != v").distinct())
        least = _least(large)
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = scratch.table(small.where("u != v").distinct())
        before, mark = mark, _mark(now)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
