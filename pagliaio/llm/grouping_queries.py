"""Queries of problem 1: one group name for all records linked directly or indirectly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagliaio.llm.grouping import connected_groups, small_key_links, star_links
from pagliaio.tables import load, rec_name

#: A picture that more listings show is an advert or a stock image and links none.
LARGEST_SHARED_PICTURE = 3


def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``u, v``: links of listings by picture, by agency page and by a confirmed verdict."""
    photos = load(spark, sf_dir, "photo_hashes").select(F.lower(F.trim("dhash")).alias("key"), rec_name().alias("rec")).where(F.col("key") != "")
    pages = load(spark, sf_dir, "url_alt").select(F.col("url_alt").alias("key"), rec_name().alias("rec"))
    verdicts = (
        load(spark, sf_dir, "verified_clusters")
        .where(F.col("verdict") == "confirmed")
        .select(F.col("ord").alias("key"), F.explode(F.array_except("ids", F.coalesce("drop_ids", F.array().cast("array<string>")))).alias("rec"))
    )
    return (
        small_key_links(photos, "key", "rec", LARGEST_SHARED_PICTURE)
        .unionByName(star_links(pages, "key", "rec"))
        .unionByName(star_links(verdicts, "key", "rec"))
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing of a group of two or more, with the group's smallest rec."""
    return connected_groups(listing_links(spark, sf_dir)).select(F.col("member").alias("rec"), F.col("group_id").alias("group_rec"))


QUERIES = {"p1_found": p1_found}

SQL = {
    "p1_found": """
        WITH RECURSIVE
        ph AS (SELECT DISTINCT lower(trim(dhash)) AS k, source || '/' || source_id AS rec FROM photo_hashes WHERE trim(dhash) <> ''),
        ok AS (SELECT k FROM ph GROUP BY k HAVING count(*) BETWEEN 2 AND 3),
        ua AS (SELECT DISTINCT url_alt AS k, source || '/' || source_id AS rec FROM url_alt WHERE url_alt IS NOT NULL),
        vc AS (SELECT DISTINCT ord AS k, unnest(list_filter(ids, lambda x: NOT list_contains(coalesce(drop_ids, []), x))) AS rec
               FROM verified_clusters WHERE verdict = 'confirmed'),
        e AS (SELECT a.rec AS u, b.rec AS v FROM ph a JOIN ok USING (k) JOIN ph b USING (k) WHERE a.rec <> b.rec
              UNION SELECT a.rec, b.rec FROM ua a JOIN ua b USING (k) WHERE a.rec <> b.rec
              UNION SELECT a.rec, b.rec FROM vc a JOIN vc b USING (k) WHERE a.rec <> b.rec),
        r AS (SELECT DISTINCT u AS rec, u AS lab FROM e
              UNION SELECT e.v, r.lab FROM r JOIN e ON e.u = r.rec WHERE r.lab < e.v)
        SELECT rec, min(lab) AS group_rec FROM r GROUP BY rec""",
}
