"""Queries of the general data operators: unit conversion and snapshot comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagliaio.operators.snapshots import snapshot_changes
from pagliaio.operators.units import convert_prices, convert_surfaces
from pagliaio.tables import current_state, instant, load, utc_date_text

_TEXTS = ["surface_raw", "mq", "mq_commercial", "description", "caption", "title"]


def _surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_surfaces(current_state(load(spark, sf_dir, "listings"), _TEXTS))


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in ("comune", "zona_code", "tipologia", "stato", "semester")])
    bounds = F.explode(F.array(*[F.struct(F.lit(f"{side}_eur_m2").alias("figure"), F.col(f"{side}_converted").alias("amount")) for side in ("min", "max")]))
    return (
        convert_prices(load(spark, sf_dir, "omi_bands"))
        .select(item.alias("item"), "factor", bounds.alias("b"))
        .select("item", "b.figure", "b.amount", "factor")
        .where(F.col("amount").isNotNull())
    )


def _whole(amount):
    return F.floor(amount + F.lit(0.5)).cast("long")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures stated in another unit than square metres or euro per square metre."""
    # A surface equals its text's figure only when the unit is m²; the parser tells "centiara" from it.
    listings = _surfaces(spark, sf_dir).where((F.col("unit") != "m²"))
    bands = _bands(spark, sf_dir).where(F.col("factor") != 1.0)
    both = listings.select(F.col("rec").alias("item"), "figure", _whole(F.col("amount")).alias("amount")).unionByName(
        bands.select("item", "figure", _whole(F.col("amount")).alias("amount"))
    )
    return both.distinct()


def p3_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every figure of both tables in common units, with the unit it was stated in."""
    listings = _surfaces(spark, sf_dir).select(F.col("rec").alias("item"), "figure", "amount", F.col("unit").alias("stated_unit"))
    bands = _bands(spark, sf_dir).select("item", "figure", "amount", F.format_string("1/%.6f", F.col("factor")).alias("stated_unit"))
    return listings.unionByName(bands).distinct()


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = instant(F.col("seen_at"))
    return load(spark, sf_dir, "price_history").select("source", "source_id", "price", at.alias("at"), utc_date_text(at).alias("run_date"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings added, removed or changed in price between one run and the next."""
    return snapshot_changes(_sightings(spark, sf_dir), ["source", "source_id"], ["price"], "run_date", "at")


QUERIES = {"p3_found": p3_found, "p3_converted": p3_converted, "p6_found": p6_found}

SQL = {
    "p6_found": """
        WITH s AS (
          SELECT source, source_id, price,
                 CASE WHEN regexp_matches(trim(seen_at), '(Z|z|[+-][0-9]{2}:?[0-9]{2})$') THEN trim(seen_at) ELSE trim(seen_at) || 'Z' END AS t
          FROM price_history),
        i AS (SELECT source, source_id, price, epoch_us(TRY_CAST(t AS TIMESTAMPTZ)) AS us FROM s),
        d AS (SELECT source, source_id, price, us, strftime(DATE '1970-01-01' + CAST(us // 86400000000 AS INTEGER), '%Y-%m-%d') AS run FROM i WHERE us IS NOT NULL),
        l AS (SELECT source, source_id, run, price FROM d
              QUALIFY row_number() OVER (PARTITION BY source, source_id, run ORDER BY us DESC, price DESC NULLS LAST) = 1),
        c AS (SELECT run, lead(run) OVER (ORDER BY run) AS nxt FROM (SELECT DISTINCT run FROM l)),
        b AS (SELECT l.source, l.source_id, c.nxt AS run, l.price FROM l JOIN c USING (run) WHERE c.nxt IS NOT NULL),
        a AS (SELECT * FROM l WHERE run > (SELECT min(run) FROM l))
        SELECT coalesce(a.source, b.source) AS source, coalesce(a.source_id, b.source_id) AS source_id,
               coalesce(a.run, b.run) AS run_date,
               CASE WHEN b.run IS NULL THEN 'added' WHEN a.run IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
        FROM a FULL OUTER JOIN b ON a.source = b.source AND a.source_id = b.source_id AND a.run = b.run
        WHERE a.run IS NULL OR b.run IS NULL OR a.price IS DISTINCT FROM b.price""",
}
