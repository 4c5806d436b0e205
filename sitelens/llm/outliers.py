"""Quality rules: multivariate outliers against robust estimates of location
and scatter, the minimum covariance determinant (MCD) per language and source.

Five statistics of a text are transformed to comparable scales. For every
language and source the MCD finds the SUPPORT share of the documents whose
covariance has the least determinant: starts come from a bounded sample of the
group, and concentration steps over all of its documents then improve
them until the determinant stands still. A document whose Mahalanobis distance
from its group's estimate is beyond the chi-square cutoff is rejected.

A concentration step is one aggregation: documents add their moments to bins of
equal distance (1 % wide), and the nearest bins make the next subset; the bin
at its edge enters with the share that is missing. So a group of any size is
combined map-side, and copies of a text weigh equally. FLOOR is added to the
scatter: differences that small are never unusual, and a statistic that is
the same in most documents doesn't make it singular.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.llm.common import attach_groups, binary_list, materialize, prepare
from sitelens.llm.wordids import Words, byte_set, gather, number_pairs

DIM = 5
# Standard deviations always granted: log words, log word length, and the
# logarithms of percentages (symbols, repeated lines, repeated words).
FLOOR = (0.25, 0.05, 0.6, 0.6, 0.6)
# Added to the whole that a percentage is of: one repeat in a short text is little.
PRIOR = {"word_chars": 100, "n_lines": 20, "n_words": 100}
SUPPORT = 0.75           # share of a group that the estimate rests on
LEVEL = 0.999            # share of regular documents within the cutoff
MIN_ROWS = 100           # smaller groups use their language's estimate, then that of all
START_ROWS = 500         # distinct vectors of a group that starts are drawn from
START_DRAWS = 60
STARTS = 3               # starts that go on to all documents
MAX_STEPS = 30
BINS = 64                # bins of distances per power of two
STATISTICS = ("doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, n_lines long")
_SUMS = [f"s{i}" for i in range(DIM)] + [f"s{i}{j}" for i in range(DIM) for j in range(i, DIM)]
_STATE = "key string, size long, means array<double>, inverses array<double>, logdets array<double>"
# Blanks between words, and the characters that count as symbols.
BLANKS = (0x20, *range(0x09, 0x0E))
SYMBOLS = b"#*$%&|<>"
_IN_WORD = ~byte_set(*BLANKS)
_IN_LINE = ~byte_set(0x0A)
_SYMBOL = byte_set(*SYMBOLS)


def text_statistics(docs: DataFrame) -> DataFrame:
    """STATISTICS of every row of ``docs`` (doc_id, lang, source, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gather(batches, 3):
            columns = [rows.column(i).combine_chunks() for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, _statistics(binary_list(rows.column(3))))],
                                             [f.split()[0] for f in STATISTICS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), "text").mapInArrow(run, STATISTICS)


def _statistics(texts: list[bytes]) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of each text."""
    n, each = len(texts), np.arange(len(texts))
    w = Words(texts, _IN_WORD, lower=False, kind=each)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    # code points begin at bytes that continue none
    begins = np.concatenate(([0], np.cumsum((w.bytes & 0xC0) != 0x80)))
    chars = np.bincount(w.row, begins[w.hi] - begins[w.lo], n)
    symbols = np.bincount(np.searchsorted(starts, np.flatnonzero(_SYMBOL[w.bytes]), "right") - 1, minlength=n)
    lines = Words(texts, _IN_LINE, lower=False, kind=each)
    filled = np.searchsorted(w.lo, lines.hi) > np.searchsorted(w.lo, lines.lo)
    again = np.ones(lines.n, bool)
    again[lines.of] = False
    # words are numbered per text, so equal windows lie in one text
    repeated = np.zeros(w.n, bool)
    window = np.flatnonzero(w.row[2:] == w.row[:-2]) if w.n > 2 else each[:0]
    if len(window):
        pair, of, _ = number_pairs(w.ids[window], w.ids[window + 1], len(w.of))
        triple, _, count = number_pairs(pair, w.ids[window + 2], len(w.of))
        twice = window[count[triple] > 1]
        for k in range(3):
            repeated[twice + k] = True
    out = [np.bincount(w.row, minlength=n), chars, symbols, np.bincount(lines.row[filled & again], minlength=n),
           np.bincount(w.row[repeated], minlength=n), np.bincount(lines.row[filled], minlength=n)]
    return [x.astype(np.int64) for x in out]


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _transformed() -> list[F.Column]:
    """The vector of a text with words, rounded so that equal statistics stay equal."""
    def percent(part: str, whole: str) -> F.Column:
        return F.log1p(100.0 * F.col(part) / (F.col(whole) + PRIOR[whole]))

    values = [F.log(F.col("n_words").cast("double")), F.log(F.col("word_chars") / F.col("n_words")), percent("n_symbols", "word_chars"),
              percent("n_dup_lines", "n_lines"), percent("n_repeat_words", "n_words")]
    return [F.round(v, 6).alias(f"x{i}") for i, v in enumerate(values)]


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for odd degrees of freedom."""
    total, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, freedom, 2):
        total -= term
        term *= x / (k + 2)
    return total


def chi_square_quantile(p: float, freedom: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, freedom) < p else (lo, mid)
    return hi


# makes the scatter of the nearest SUPPORT of normal data that of all of it
CONSISTENCY = SUPPORT / chi_square(chi_square_quantile(SUPPORT, DIM), DIM + 2)
CUTOFF = chi_square_quantile(LEVEL, DIM)


def distances(x: np.ndarray, mean: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    d = x - mean
    return np.einsum("ni,ij,nj->n", d, inverse, d)


def bins(d2: np.ndarray) -> np.ndarray:
    return np.floor(BINS * np.log2(d2 + 2.0 ** -20)).astype(np.int64)


def _estimate(n: float, s: np.ndarray, ss: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(mean, inverse scatter, log determinant) from sums of weights, values and products."""
    mean = s / n
    scatter = np.zeros((DIM, DIM))
    scatter[np.triu_indices(DIM)] = ss / n
    scatter = scatter + np.triu(scatter, 1).T - np.outer(mean, mean)
    scatter = CONSISTENCY * scatter + np.diag(np.square(FLOOR))
    return mean, np.linalg.inv(scatter), float(np.linalg.slogdet(scatter)[1])


def _products(x: np.ndarray) -> np.ndarray:
    i, j = np.triu_indices(DIM)
    return x[:, i] * x[:, j]


def concentrate(bin_no: np.ndarray, w: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The next estimate from the weights and sums of bins of distances."""
    order = np.argsort(bin_no, kind="stable")
    w, sums = w[order], sums[order]
    need = math.ceil(SUPPORT * w.sum())
    before = np.cumsum(w) - w
    share = np.clip((need - before) / w, 0, 1)
    total = share @ sums
    return _estimate(float(share @ w), total[:DIM], total[DIM:])


def _step(x: np.ndarray, w: np.ndarray, mean: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """A concentration step over a bounded sample."""
    b, at = np.unique(bins(distances(x, mean, inverse)), return_inverse=True)
    sums = np.zeros((len(b), len(_SUMS)))
    np.add.at(sums, at, w[:, None] * np.hstack([x, _products(x)]))
    return concentrate(b, np.bincount(at, w), sums)


def _starts(rows: pd.DataFrame) -> pd.DataFrame:
    """Up to STARTS estimates of one group from its sample: random elemental
    subsets take two steps, the best of them go on until they stand still."""
    rows = rows.sort_values([f"x{i}" for i in range(DIM)])
    x, w = rows[[f"x{i}" for i in range(DIM)]].to_numpy(float), rows["w"].to_numpy(float)
    draw = np.random.default_rng(len(rows))
    found = []
    for _ in range(START_DRAWS):
        pick = draw.choice(len(x), min(DIM + 1, len(x)), replace=False)
        state = _estimate(len(pick), x[pick].sum(axis=0), _products(x[pick]).sum(axis=0))
        for _ in range(2):
            state = _step(x, w, *state[:2])
        found.append(state)
    best = []
    for state in sorted(found, key=lambda s: s[2])[:2 * STARTS]:
        for _ in range(MAX_STEPS):
            new = _step(x, w, *state[:2])
            if new[2] > state[2] - 1e-9:
                break
            state = new
        if all(abs(state[2] - b[2]) > 1e-6 for b in best):
            best.append(state)
    return _state(rows["key"].iloc[0], rows["size"].iloc[0], sorted(best, key=lambda s: s[2])[:STARTS])


def _state(key: str, size: int, states: list) -> pd.DataFrame:
    return pd.DataFrame([{"key": key, "size": size, "means": np.concatenate([s[0] for s in states]),
                          "inverses": np.concatenate([s[1].ravel() for s in states]), "logdets": np.array([s[2] for s in states])}])


def _binned(points: DataFrame) -> DataFrame:
    """(key, size, start, bin, w, sums): the moments of the documents of a
    group by their distance from each of its estimates."""
    schema = "key string, size long, start int, bin long, w double, " + ", ".join(f"{s} double" for s in _SUMS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.to_pandas()
            x, w = t[[f"x{i}" for i in range(DIM)]].to_numpy(float), t["w"].to_numpy(float)
            moments = w[:, None] * np.hstack([x, _products(x)])
            out = []
            for key, at in t.groupby("key").indices.items():
                first = t.iloc[at[0]]
                for start in range(len(first["logdets"])):
                    mean = first["means"][start * DIM:(start + 1) * DIM]
                    inverse = first["inverses"][start * DIM * DIM:(start + 1) * DIM * DIM].reshape(DIM, DIM)
                    b, of = np.unique(bins(distances(x[at], mean, inverse)), return_inverse=True)
                    sums = np.zeros((len(b), len(_SUMS)))
                    np.add.at(sums, of, moments[at])
                    out.append((np.full(len(b), key), np.full(len(b), first["size"]), np.full(len(b), start), b, np.bincount(of, w[at]), sums))
            key, size, start, b, w, sums = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.string()), pa.array(size.astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(b), pa.array(w),
                 *[pa.array(np.ascontiguousarray(sums[:, i])) for i in range(sums.shape[1])]],
                ["key", "size", "start", "bin", "w", *_SUMS])

    rows = points.select("key", "size", *[f"x{i}" for i in range(DIM)], "w", "means", "inverses", "logdets").mapInArrow(run, schema)
    return rows.groupBy("key", "size", "start", "bin").agg(F.sum("w").alias("w"), *[F.sum(s).alias(s) for s in _SUMS])


def _next(rows: pd.DataFrame) -> pd.DataFrame:
    """The estimates of one group after a step, from its bins."""
    states = [concentrate(r["bin"].to_numpy(), r["w"].to_numpy(), r[_SUMS].to_numpy()) for _, r in rows.groupby("start")]
    return _state(rows["key"].iloc[0], rows["size"].iloc[0], states)


def fit(points: DataFrame, n_rows: int) -> DataFrame:
    """(key, size, means, inverses, logdets) with the MCD estimate of every group
    of ``points`` (key, size, x0.., w), a written table of distinct vectors."""
    xs = [f"x{i}" for i in range(DIM)]
    few = points.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64(*xs), *xs))).filter(F.col("_r") <= START_ROWS)
    state = materialize(few.select("key", "size", *xs, "w").groupBy("key").applyInPandas(_starts, _STATE), "outlier-state")
    for _ in range(MAX_STEPS):
        moved = _binned(attach_groups(points.drop("size"), state, "key", "size", n_rows))
        new = materialize(moved.groupBy("key").applyInPandas(_next, _STATE), "outlier-state")
        before = state.select("key", F.array_min("logdets").alias("_before"))
        falling = new.join(before, "key").filter(F.array_min("logdets") < F.col("_before") - 1e-6)
        state = new
        if falling.isEmpty():
            break
    best = F.array_position("logdets", F.array_min("logdets")).cast("int") - 1
    return materialize(state.select("key", "size", F.slice("means", best * DIM + 1, F.lit(DIM)).alias("mean"),
                                    F.slice("inverses", best * DIM * DIM + 1, F.lit(DIM * DIM)).alias("inverse"),
                                    F.array_min("logdets").alias("logdet")), "outlier-fit")


def _key(*names: str) -> F.Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def _pools(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, points): the passing rows of ``stats`` with the key of the pool that judges
    them (null: too few rows anywhere), and the weighted distinct vectors of
    every pool that judges any."""
    xs = [f"x{i}" for i in range(DIM)]
    rows = stats.filter(~base_failed()).select("doc_id", "_at", _key("lang", "source").alias("own"), _key("lang").alias("wide"), *_transformed())
    rows = materialize(rows, "outlier-rows")
    n_rows = rows.count()
    own = rows.groupBy("own").agg(F.first("wide").alias("wide"), F.count(F.lit(1)).alias("n"))
    wide = own.groupBy("wide").agg(F.sum("n").alias("n_wide"))
    every = F.lit("all") if n_rows >= MIN_ROWS else F.lit(None).cast("string")
    chosen = own.join(wide, "wide").select("own", "n", F.when(F.col("n") >= MIN_ROWS, F.col("own"))
                                           .when(F.col("n_wide") >= MIN_ROWS, F.col("wide")).otherwise(every).alias("key"))
    chosen = materialize(chosen, "outlier-pools")
    rows = materialize(attach_groups(rows, chosen, "own", "n", n_rows), "outlier-rows")
    used = chosen.filter("key IS NOT NULL").select("key").distinct()
    vectors = rows.groupBy("own", "wide", *xs).agg(F.count(F.lit(1)).cast("double").alias("w"))
    vectors = materialize(vectors, "outlier-vectors")
    levels = [vectors.select(k.alias("key"), *xs, "w") for k in (F.col("own"), F.col("wide"), F.lit("all"))]
    sizes = levels[0].unionByName(levels[1]).unionByName(levels[2]).groupBy("key").agg(F.sum("w").cast("long").alias("size"))
    sizes = materialize(sizes.join(used, "key"), "outlier-sizes")
    points = [materialize(attach_groups(v.groupBy("key", *xs).agg(F.sum("w").alias("w")) if i else v, sizes, "key", "size", n_rows), "outlier-points")
              for i, v in enumerate(levels)]
    return rows, points[0].unionByName(points[1]).unionByName(points[2])


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and distance (null if no estimate judged the row), per input row.

    Documents that fail the base rules (fewer than 50 words, or more than half
    of the words in repeated windows of three) are not kept and take no part in
    the estimates. A language and source with fewer than MIN_ROWS passing documents is
    judged by its language, that by all; with fewer in all nothing more is
    rejected. A null language or source is a group of its own. Null, empty and
    blank texts have no words and fail. Rows that repeat an id or a text are
    judged each, alike if their texts, languages and sources are. An empty
    table gives no rows; other columns are not read."""
    prepare(docs.sparkSession)
    stats = materialize(text_statistics(docs).withColumn("_at", F.monotonically_increasing_id()), "outlier-statistics")
    rows, points = _pools(stats)
    n_rows = rows.count()
    estimates = fit(points, n_rows)
    xs = F.array(*[f"x{i}" for i in range(DIM)])
    judged = attach_groups(rows.filter("key IS NOT NULL"), estimates, "key", "size", n_rows)
    delta = F.zip_with(xs, "mean", lambda a, b: a - b)
    judged = judged.withColumn("_d", delta)
    square = sum((F.col("_d")[i] * F.col("_d")[j] * F.col("inverse")[i * DIM + j] for i in range(DIM) for j in range(DIM)), F.lit(0.0))
    judged = materialize(judged.select("_at", square.alias("distance")), "outlier-distances")
    out = stats.withColumn("base_failed", base_failed()).join(judged, "_at", "left")
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUTOFF)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
