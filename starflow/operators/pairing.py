"""Stored rows side by side with arrived ones: the join behind every merge."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matching(left: str, right: str, equal: Sequence[str], same: Sequence[str] = ()) -> Column:
    """Condition between two aliased frames: ``equal`` columns by ``=``, ``same`` ones null-safe."""
    parts = [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in equal]
    parts += [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in same]
    return reduce(and_, parts)


def pair_rows(
    stored: DataFrame, arrived: DataFrame, equal: Sequence[str], same: Sequence[str] = (), few: bool = False
) -> DataFrame:
    """Columns ``old`` and ``new``: each stored row with its partner, each arrived one without.

    ``stored`` has the key columns and ``old``, ``arrived`` the key columns and
    ``new``; a key occurs at most once on either side.

    A full outer join cannot broadcast, so it shuffles all that is stored.  With
    ``few`` the same pairs come from a left join and an anti join, in which the
    stored side stays where it is if Spark finds the arrived side small enough to
    broadcast.  Pass it with an ``arrived`` frame that is cached, so that its bytes
    are known; beyond the threshold both joins shuffle and the result is the same.
    """
    keys = [*equal, *same]
    s, a = stored.alias("s"), arrived.alias("a")
    if not few:
        return s.join(a, matching("s", "a", equal, same), "full_outer").select("old", "new")
    kept = s.join(a, matching("s", "a", equal, same), "left").select("old", "new")
    met = s.select(*keys).join(a.select(*keys).alias("a"), matching("s", "a", equal, same), "left_semi")
    added = a.join(met.alias("m"), matching("a", "m", equal, same), "left_anti")
    nothing = F.lit(None).cast(stored.schema["old"].dataType).alias("old")
    return kept.unionByName(added.select(nothing, "new"))
