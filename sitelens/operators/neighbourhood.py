"""Hybrid neighbourhoods (at most ``max_nn`` points within a radius) worked out
where the points lie. A pair table of a cloud has 30 to 100 rows per point, each
shuffled and joined several times; here only points move, to the spatial blocks
that may need them, and a block's pairs never leave its task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sitelens.operators.spatial import apart, spread

XYZ = ["x", "y", "z"]
BLOCK_RADII = 8            # side of a block, in radii
MAX_BLOCK_ROWS = 20_000    # blocks with more rows work on pair tables
TASK_ROWS = 20_000         # rows of blocks that a group holds together, on average
CANDIDATES = 500_000       # candidate pairs formed at a time


def near_pairs(block: np.ndarray, cell: np.ndarray, x: np.ndarray, ids: np.ndarray, own: np.ndarray, radius: float,
               max_nn: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, dist) by position: the neighbours of the ``own`` rows among the
    rows of their block, ordered by a, dist and id of b. Pairs of one a come
    together. ``cell``: the row's cell in its block (sides of a radius or more)."""
    key = ((block * 16 + cell[:, 0]) * 16 + cell[:, 1]) * 16 + cell[:, 2]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    asked = np.flatnonzero(own)
    centre = key[asked, None] + np.array([(i * 16 + j) * 16 for i in (-1, 0, 1) for j in (-1, 0, 1)])[None, :]
    lo, hi = np.searchsorted(ranked, centre - 1, "left"), np.searchsorted(ranked, centre + 1, "right")
    total = np.cumsum((hi - lo).sum(axis=1))
    start = 0
    while start < len(asked):
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + CANDIDATES, "right")))
        n = (hi[start:end] - lo[start:end]).ravel()
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[start:end].ravel(), n)
        a, b = np.repeat(np.repeat(asked[start:end], 9), n), order[at]
        sq = (x[a, 0] - x[b, 0]) * (x[a, 0] - x[b, 0])
        for i in (1, 2):
            sq = sq + (x[a, i] - x[b, i]) * (x[a, i] - x[b, i])
        hit = sq <= radius * radius
        a, b, dist = a[hit], b[hit], np.sqrt(sq[hit])
        by = np.lexsort((ids[b], dist, a))
        a, b, dist = a[by], b[by], dist[by]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, np.int64)
        rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
        keep = rank < max_nn
        yield a[keep], b[keep], dist[keep]
        start = end


def over_neighbours(points: DataFrame, radius: float, max_nn: int, by: Sequence[str], solve: Callable, schema: str,
                    by_pairs: Callable[[DataFrame], DataFrame], max_rows: int | None = None) -> DataFrame:
    """A row per point that has neighbours: ``by``, pt_id and the columns of
    ``schema``, which ``solve(rows, x, a, b, dist)`` gives for the pairs of some
    points (a column per name, a row per distinct a in order).

    Every point goes to the blocks within ``radius`` of it (one to eight). Blocks
    with more than ``max_rows`` rows, and tables whose ids are null, repeat or are
    no integers, go by pair tables: ``by_pairs(points)`` gives the same columns."""
    by, max_rows = list(by), max_rows or MAX_BLOCK_ROWS
    points = spread(points)
    kinds = {f.name: f.dataType for f in points.schema.fields}
    names = [c.split()[0] for c in schema.split(", ")]
    out = [*by, "pt_id", *names]
    if not isinstance(kinds["pt_id"], IntegralType) or not points.groupBy(*by, "pt_id").count().filter("count > 1 OR pt_id IS NULL").isEmpty():
        return by_pairs(points).select(*out)
    side, g = float(BLOCK_RADII * radius), [f"_g{c}" for c in XYZ]
    listed = points.dropna(subset=[*by, *XYZ]).filter(" AND ".join(f"NOT isnan({c})" for c in XYZ))
    for c, k in zip(XYZ, g):
        # a little wider than the radius: the exact distance decides
        reach = F.lit(radius * (1 + 1e-6)) + F.abs(F.col(c)) * F.lit(1e-12)
        listed = listed.withColumn(k, F.explode(F.sequence(F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side))))
    own = F.lit(True)
    for c, k in zip(XYZ, g):
        own = own & (F.col(k) == F.floor(F.col(c) / side))
    listed = listed.withColumn("_own", own)
    counts = listed.groupBy(*by, *g).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    sizes = counts.agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    hot = None
    if (sizes["most"] or 0) > max_rows:
        # fewer blocks than rows / max_rows
        hot = counts.filter(F.col("_n") > max_rows).select(*by, *g).checkpoint()
        small = listed.join(apart(hot), [*by, *g], "left_anti")
    else:
        small = listed
    width, step = side, radius * (1 + 1e-6)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        gs = pdf[g].to_numpy(np.int64)
        block = pdf.groupby([*by, *g], sort=False).ngroup().to_numpy()
        x = pdf[XYZ].to_numpy(np.float64)
        cell = np.clip(np.floor((x - gs * width) / step), -2, BLOCK_RADII + 1).astype(np.int64) + 3
        parts = []
        for a, b, dist in near_pairs(block, cell, x, pdf["pt_id"].to_numpy(), pdf["_own"].to_numpy(bool), radius, max_nn):
            if len(a):
                who, found = solve(pdf, x, a, b, dist)
                parts.append(pd.DataFrame({**{c: pdf[c].to_numpy()[who] for c in [*by, "pt_id"]}, **found}))
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in out})

    groups = max(1, (sizes["rows"] or 0) // TASK_ROWS)
    typed = ", ".join([*(f"{c} {kinds[c].simpleString()}" for c in [*by, "pt_id"]), schema])
    solved = small.withColumn("_t", F.pmod(F.xxhash64(*by, *g), F.lit(groups))).groupBy("_t").applyInPandas(run, typed)
    if hot is None:
        return solved
    dense = listed.join(apart(hot), [*by, *g], "left_semi").select(*by, "pt_id", "_own").groupBy(*by, "pt_id").agg(F.max("_own").alias("_own")).checkpoint()
    key = [*by, "pt_id"]
    rest = by_pairs(points.join(apart(dense.select(*key)), key, "left_semi"))
    return solved.unionByName(rest.join(apart(dense.filter("_own").select(*key)), key, "left_semi").select(*out))
