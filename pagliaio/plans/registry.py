"""Registers named queries with their DuckDB SQL, and the views both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagliaio.tables import current_state, load


class Plan:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def put(f):
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return put


#: SQL of the current state of the listings: one row per key, the state fetched last. Goes behind WITH.
LISTINGS = """l AS (
  SELECT source || '/' || source_id AS rec, * FROM listings WHERE source IS NOT NULL AND source_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source, source_id ORDER BY TRY_CAST(fetched_at AS TIMESTAMPTZ) DESC NULLS LAST) = 1)"""


def listings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The current state of the listings: rec, source, source_id and ``columns``."""
    wanted = [c for c in columns if c not in ("rec", "source", "source_id")]
    return current_state(load(spark, sf_dir, "listings"), wanted or ["url"])


def half_up(x: Column, digits: int = 1) -> Column:
    """Rounding that both engines do alike: floor of the scaled double plus one half."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def half_up_sql(x: str, digits: int = 1) -> str:
    scale = f"{10**digits}e0"
    return f"floor(({x}) * {scale} + 0.5e0) / {scale}"
