"""Registry of plans (name -> Spark callable) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register a plan, with its oracle SQL when SQL can express it."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def add(name: str, fn: Callable[[SparkSession, str], DataFrame], oracle: str | None = None) -> None:
    QUERIES[name] = fn
    if oracle is not None:
        ORACLES[name] = oracle


def load_all() -> None:
    """Import every plan module so its registrations run."""
    from sitelens.plans import catalog  # noqa: F401
