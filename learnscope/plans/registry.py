"""Registry of named queries (one per operator family of the inventory) and
their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables (via
the fixture views). Float columns are rounded to 6 places in both engines so
results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.common import round_floats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None, floats: tuple[str, ...] = ()):
    """Register ``fn`` under ``key``; ``oracle`` is DuckDB SQL (None: no SQL
    form). ``floats`` names the oracle's float columns to round."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_floats(fn(spark, sf_dir), 6)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            sql = oracle.strip().rstrip(";")
            if floats:
                rep = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in floats)
                sql = f"SELECT * REPLACE ({rep}) FROM ({sql}) AS oracle_result"
            ORACLES[key] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module (they register on import)."""
    from . import q_features, q_markov, q_ml, q_segment, q_sources, q_stats  # noqa: F401
