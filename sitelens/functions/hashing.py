"""Seeded, layout-independent pseudo-random numbers.

``rand()`` depends on partitioning, so repeatable sampling, splitting and
synthetic points use a hash of (id, seed) instead: the first 8 hex digits of
md5("<id>:<seed>") as an unsigned 32-bit number. DuckDB computes the same value
(see ``unit_hash_sql``), which keeps every sampled query oracle-checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash32(id_col, seed: int | str = 42) -> Column:
    """Unsigned 32-bit hash of (id, seed) as bigint."""
    key = F.concat(_c(id_col).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def unit_hash(id_col, seed: int | str = 42) -> Column:
    """Seeded hash mapped to [0, 1)."""
    return hash32(id_col, seed) / F.lit(TWO_32)


def hash32_sql(id_expr: str, seed: int | str = 42) -> str:
    return (f"CAST(concat('0x', substr(md5(concat(CAST({id_expr} AS VARCHAR), ':{seed}')), 1, 8))"
            f" AS BIGINT)")


def unit_hash_sql(id_expr: str, seed: int | str = 42) -> str:
    return f"({hash32_sql(id_expr, seed)} / {TWO_32!r})"
