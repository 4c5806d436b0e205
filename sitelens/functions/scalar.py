"""Scalar column helpers for venue tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six product price columns of the venue table, and the
# product labels the UI shows for them (label -> column).
PRICE_COLS = [
    "price_turkey_shawarma_pita",
    "price_cow_shawarma_pita",
    "price_turkey_shawarma_laffa",
    "price_cow_shawarma_laffa",
    "price_falafel_pita",
    "price_falafel_laffa",
]
PRICE_LABELS = {
    "Turkey Shawarma – Pita": "price_turkey_shawarma_pita",
    "Cow Shawarma – Pita": "price_cow_shawarma_pita",
    "Turkey Shawarma – Laffa": "price_turkey_shawarma_laffa",
    "Cow Shawarma – Laffa": "price_cow_shawarma_laffa",
    "Falafel – Pita": "price_falafel_pita",
    "Falafel – Laffa": "price_falafel_laffa",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# What counts as a number in text: decimal digits with an optional sign,
# fraction and exponent. Casts alone would also read '12d' and '5f'.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def to_double(c) -> Column:
    """Text to double; anything that isn't a finite number becomes null."""
    text = F.trim(_c(c).cast("string"))
    v = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def row_mean(cols: list) -> Column:
    """Mean of the non-null values of several columns; null when all are null."""
    cs = [_c(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    count = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cs])
    return F.when(count > 0, total / count)


def text_to_bool(c) -> Column:
    """'True' -> true, 'False' -> false, anything else -> null."""
    c = _c(c).cast("string")
    return F.when(c == "True", F.lit(True)).when(c == "False", F.lit(False))


def deviation_color(dist, max_dist: float = 0.2) -> list[Column]:
    """Green-to-red colour of a distance: t = clip(d / max, 0, 1) -> (t, 1 - t, 0)."""
    t = F.least(F.greatest(_c(dist) / F.lit(float(max_dist)), F.lit(0.0)), F.lit(1.0))
    return [t.alias("r"), (F.lit(1.0) - t).alias("g"), F.lit(0.0).alias("b")]
