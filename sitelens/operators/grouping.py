"""One row per group brought to the rows of the group, whatever their sizes."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to so many groups (a few numbers each) are broadcast, counted before.
BROADCAST_GROUPS = 100_000
# Of more groups, those with at least one of so many parts of all rows are hot.
HOT_PARTS = 1_000


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner", limit: int = BROADCAST_GROUPS) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row per
    ``keys``. A null key has no group. Columns of ``groups`` must not be in
    ``rows`` but for the keys.

    Up to ``limit`` groups are broadcast and no row moves. Beyond that, the
    groups with a thousandth of all rows or more (a thousand at most) are
    broadcast, so their rows stay where they are, and only the rows of other
    groups are shuffled, none of which is heavy. The sizes are counted
    map-side; both inputs are read more than once then."""
    keys = list(keys)
    groups = groups.checkpoint()
    if groups.count() <= limit:
        return rows.join(F.broadcast(groups), keys, how)
    known = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    nameless, rows = rows.filter(~known), rows.filter(known)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).checkpoint()
    least = (sizes.agg(F.sum("_size")).first()[0] or 0) / HOT_PARTS
    hot = sizes.filter(F.col("_size") >= max(2.0, least)).select(*keys)
    heavy = rows.join(F.broadcast(groups.join(F.broadcast(hot), keys, "left_semi")), keys, "inner")
    rest = rows.join(F.broadcast(hot), keys, "left_anti").join(groups.hint("merge"), keys, how)
    if how == "left":   # rows of hot keys without a group
        missing = rows.join(F.broadcast(hot.join(groups, keys, "left_anti")), keys, "left_semi")
        rest = rest.unionByName(missing, allowMissingColumns=True).unionByName(nameless, allowMissingColumns=True)
    return heavy.select(*rest.columns).unionByName(rest)
