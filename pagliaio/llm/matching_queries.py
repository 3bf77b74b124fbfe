"""Queries of the record problems: addresses, cross-source matches and personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagliaio.llm.addresses import same_address_pairs
from pagliaio.llm.matching import match_pages
from pagliaio.llm.personal import find_personal
from pagliaio.tables import current_state, load, rec_name

#: Least confidence of a reported match, and of one worth listing.
CONFIDENCE, POSSIBLE = 0.5, 0.05


def _matches(spark: SparkSession, sf_dir: str, least_confidence: float) -> DataFrame:
    columns = ["comune", "typology", "typology_raw", "price", "mq", "mq_commercial", "surface_raw", "address_raw", "title", "caption", "description", "zona_raw", "vani"]
    listings = current_state(load(spark, sf_dir, "listings"), columns)
    harvest = load(spark, sf_dir, "agency_site_listings").where(F.col("url").isNotNull())
    state = F.struct("harvested_on", F.struct("is_rent", "price", "mq", "comune", "comune_raw", "title").alias("row"))
    pages = harvest.groupBy("url").agg(F.max(state).alias("s")).select("url", "s.row.*").where(F.coalesce(F.col("is_rent"), F.lit(0)) == 0)
    links = load(spark, sf_dir, "url_alt").select(rec_name().alias("rec"), F.col("url_alt").alias("url"))
    return match_pages(listings, pages, links, least_confidence)


def p2_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings and agency pages that may be one property for sale, with BM25, agreement, gap and confidence."""
    return _matches(spark, sf_dir, POSSIBLE)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing and an agency page that offer the same property for sale."""
    return _matches(spark, sf_dir, CONFIDENCE).select("rec", "url")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of listings whose addresses denote the same street, house number and comune."""
    return same_address_pairs(current_state(load(spark, sf_dir, "listings"), ["comune", "address_raw", "zona_raw", "title", "caption"]))


def p7_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing's description and address with typed placeholders for personal data."""
    return find_personal(current_state(load(spark, sf_dir, "listings"), ["comune", "description", "address_raw", "agency_name"])).select("rec", "description", "address_raw", F.size("found").alias("n_found"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of personal data with its field, kind and first character."""
    found = find_personal(current_state(load(spark, sf_dir, "listings"), ["comune", "description", "address_raw", "agency_name"]))
    return found.select("rec", F.explode("found").alias("f")).select("rec", "f.field", "f.kind", "f.span_start")


QUERIES = {"p2_found": p2_found, "p2_matches": p2_matches, "p5_found": p5_found, "p7_found": p7_found, "p7_redacted": p7_redacted}

SQL: dict[str, str] = {}
