"""Table access and the rules every query applies to its input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a dimension side may be broadcast. Above it the join shuffles.
BROADCAST_ROWS = 200_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rec_name(prefix: str = "") -> Column:
    """``source/source_id``: the name of a listing."""
    return F.concat(F.col(f"{prefix}source"), F.lit("/"), F.col(f"{prefix}source_id"))


def instant(col: Column) -> Column:
    """ISO text of any precision -> timestamp; text without an offset is UTC; junk gives NULL."""
    text = F.trim(col)
    zoned = text.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})$")
    text = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(zoned, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp")


def utc_date_text(ts: Column) -> Column:
    """``YYYY-MM-DD`` of an instant in UTC, whatever the session's time zone."""
    days = F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyy-MM-dd")


def current_state(listings: DataFrame, columns: list[str]) -> DataFrame:
    """One row per (source, source_id): the state fetched last.

    Repeated rows and older states collapse in a partial aggregation, so a key
    that holds a large share of the rows costs no more than its map-side
    partials. Ties on ``fetched_at`` fall to the greatest row, so the result is
    the same on every run. Rows without source or source_id name no listing and
    are left out.
    """
    payload = F.struct(*[F.col(c) for c in columns])
    return (
        listings.where(F.col("source").isNotNull() & F.col("source_id").isNotNull())
        .select("source", "source_id", F.struct(instant(F.col("fetched_at")).alias("at"), payload.alias("row")).alias("state"))
        .groupBy("source", "source_id")
        .agg(F.max("state").alias("state"))
        .select(rec_name().alias("rec"), "source", "source_id", "state.row.*")
    )


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; stops counting beyond it."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if small_enough(df, limit) else df
