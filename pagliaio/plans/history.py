"""Change capture, rankings, set operations and keyed writes over the price history."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagliaio.operators.changes import insert_absent, observed_changes, upsert
from pagliaio.plans.offers import AREA
from pagliaio.functions.text import area_key
from pagliaio.plans.registry import LISTINGS, Plan, listings
from pagliaio.tables import instant, load, rec_name, utc_date_text

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql

#: One sighting per key and instant, the greatest price of copies.
SEEN = """s AS (SELECT source || '/' || source_id AS rec, us, max(price) AS price FROM (
  SELECT source, source_id, price, epoch_us(TRY_CAST(CASE WHEN regexp_matches(trim(seen_at), '(Z|z|[+-][0-9]{2}:?[0-9]{2})$') THEN trim(seen_at) ELSE trim(seen_at) || 'Z' END AS TIMESTAMPTZ)) AS us FROM price_history)
  WHERE us IS NOT NULL GROUP BY ALL)"""
DAY = "strftime(DATE '1970-01-01' + CAST(us // 86400000000 AS INTEGER), '%Y-%m-%d')"


def seen(spark, d):
    raw = load(spark, d, "price_history").select(rec_name().alias("rec"), instant(F.col("seen_at")).alias("at"), "price").where("at IS NOT NULL")
    return raw.groupBy("rec", "at").agg(F.max("price").alias("price")).withColumn("us", F.unix_micros("at"))


@plan.query("cdc_01", f"WITH {SEEN}, e AS (SELECT rec, us, price, lag(price) OVER w AS prev, row_number() OVER w AS n FROM s WINDOW w AS (PARTITION BY rec ORDER BY us)) SELECT rec, us, price, prev AS previous, CASE WHEN n = 1 THEN 'new' ELSE 'change' END AS event FROM e WHERE n = 1 OR (price IS NOT NULL AND prev IS NOT NULL AND price <> prev)")
def cdc_01(spark, d):
    """Observe before upsert: new keys and price changes; a price that appears or disappears is no change."""
    return observed_changes(seen(spark, d), ["rec"], "price", "us").where("event <> 'unchanged'").select("rec", "us", "price", "previous", "event")


@plan.query("cdc_02", f"WITH {SEEN} SELECT rec, arg_max(struct_pack(price := price), us).price AS price, min(us) AS first_seen, max(us) AS last_seen FROM s GROUP BY rec")
def cdc_02(spark, d):
    """Current state from the history."""
    g = seen(spark, d).groupBy("rec").agg(F.max_by(F.struct("price"), "us").alias("x"), F.min("us").alias("first_seen"), F.max("us").alias("last_seen"))
    return g.select("rec", "x.price", "first_seen", "last_seen")


@plan.query("cdc_03", f"WITH {SEEN}, x AS (SELECT rec, max({DAY}) AS last_run FROM s GROUP BY rec) SELECT rec, last_run FROM x WHERE last_run < (SELECT max(last_run) FROM x)")
def cdc_03(spark, d):
    """Listings that the latest run no longer has."""
    x = seen(spark, d).groupBy("rec").agg(F.max(utc_date_text(F.col("at"))).alias("last_run"))
    return x.where(F.col("last_run") < x.agg(F.max("last_run").alias("m")).scalar())


@plan.query("cdc_04", f"WITH {SEEN}, e AS (SELECT rec, us, price, lag(price) OVER (PARTITION BY rec ORDER BY us) AS prev FROM s) SELECT rec, us, price - prev AS step FROM e WHERE price <> prev AND us >= 1769900000000000")
def cdc_04(spark, d):
    """Price changes since an instant, newest first."""
    e = observed_changes(seen(spark, d), ["rec"], "price", "us").where("event = 'change' AND us >= 1769900000000000")
    return e.select("rec", "us", (F.col("price") - F.col("previous")).alias("step")).orderBy(F.col("us").desc(), "rec")


@plan.query("cdc_06", f"WITH {SEEN}, e AS (SELECT rec, {DAY} AS run, price, lag(price) OVER w AS prev, row_number() OVER w AS n FROM s WINDOW w AS (PARTITION BY rec ORDER BY us)) SELECT run, count(*) FILTER (n = 1) AS new, count(*) FILTER (n > 1 AND coalesce(price <> prev, FALSE)) AS changed, count(*) FILTER (n > 1 AND NOT coalesce(price <> prev, FALSE)) AS unchanged FROM e GROUP BY run")
def cdc_06(spark, d):
    """Tally of each run."""
    e = observed_changes(seen(spark, d), ["rec"], "price", "us")
    run = utc_date_text(F.timestamp_micros("us"))
    return e.groupBy(run.alias("run")).agg(F.count_if(F.col("event") == "new").alias("new"), F.count_if(F.col("event") == "change").alias("changed"), F.count_if(F.col("event") == "unchanged").alias("unchanged"))


@plan.query(
    "cdc_07",
    f"""WITH {SEEN}, k AS (SELECT DISTINCT rec, {DAY} AS run FROM s), c AS (SELECT run, row_number() OVER (ORDER BY run) AS no FROM (SELECT DISTINCT run FROM k)),
    x AS (SELECT rec, max(no) AS last_no, count(*) AS runs FROM k JOIN c USING (run) GROUP BY rec)
    SELECT rec, runs, (SELECT max(no) FROM c) - last_no AS missed, CASE WHEN last_no = (SELECT max(no) FROM c) THEN 'active' WHEN (SELECT max(no) FROM c) - last_no = 1 THEN 'absent' WHEN (SELECT max(no) FROM c) - last_no < 4 THEN 'delisted' ELSE 'archived' END AS state FROM x""",
)
def cdc_07(spark, d):
    """Extension: lifecycle by the number of runs missed."""
    k = seen(spark, d).select("rec", utc_date_text(F.col("at")).alias("run")).distinct()
    c = k.select("run").distinct().withColumn("no", F.row_number().over(W.orderBy("run")).cast("long"))  # one row a run
    x = k.join(F.broadcast(c), "run").groupBy("rec").agg(F.max("no").alias("last_no"), F.count("*").alias("runs"))
    x = x.withColumn("m", c.agg(F.max("no").alias("m")).scalar())
    missed = F.col("m") - F.col("last_no")
    return x.select("rec", "runs", missed.alias("missed"), F.when(missed == 0, "active").when(missed == 1, "absent").when(missed < 4, "delisted").otherwise("archived").alias("state"))


@plan.query("cdc_08", f"WITH {SEEN}, r AS (SELECT split_part(rec, '/', 1) AS source, {DAY} AS run, count(DISTINCT rec) AS n FROM s GROUP BY ALL) SELECT source, run, n, lag(n) OVER (PARTITION BY source ORDER BY run) AS before, coalesce(n < 0.5 * lag(n) OVER (PARTITION BY source ORDER BY run), FALSE) AS alert FROM r")
def cdc_08(spark, d):
    """Extension: alert where a run brings less than half of the run before."""
    r = seen(spark, d).groupBy(F.split_part("rec", F.lit("/"), F.lit(1)).alias("source"), utc_date_text(F.col("at")).alias("run")).agg(F.countDistinct("rec").alias("n"))
    before = F.lag("n").over(W.partitionBy("source").orderBy("run"))
    return r.withColumn("before", before).select("source", "run", "n", "before", F.coalesce(F.col("n") < F.lit(0.5) * F.col("before"), F.lit(False)).alias("alert"))


@plan.query("cdc_09", f"WITH {LISTINGS} SELECT count(*) AS n, count(*) FILTER (typology IS DISTINCT FROM CASE WHEN typology IS NULL AND regexp_matches(lower(coalesce(typology_raw, '')), 'locale|appart') THEN 'appartamento' ELSE typology END) AS repaired FROM l")
def cdc_09(spark, d):
    """Idempotent repair: types recomputed, the difference counted."""
    fixed = F.when(F.col("typology").isNull() & F.lower(F.coalesce("typology_raw", F.lit(""))).rlike("locale|appart"), "appartamento").otherwise(F.col("typology"))
    return listings(spark, d, "typology", "typology_raw").agg(F.count("*").alias("n"), F.count_if(~F.col("typology").eqNullSafe(fixed)).alias("repaired"))


@plan.query("cdc_10", f"WITH {LISTINGS}, p AS (SELECT url, max(price) AS price FROM agency_site_listings WHERE coalesce(is_rent, 0) = 0 GROUP BY url) SELECT source, source_id, url, price FROM l UNION ALL SELECT 'pages', 'u' || left(sha1(url), 10), url, price FROM p")
def cdc_10(spark, d):
    """Promotion of side-table rows into the main table."""
    p = load(spark, d, "agency_site_listings").where("coalesce(is_rent, 0) = 0").groupBy("url").agg(F.max("price").alias("price"))
    promoted = p.select(F.lit("pages").alias("source"), F.concat(F.lit("u"), F.left(F.sha1("url"), F.lit(10))).alias("source_id"), "url", "price")
    return listings(spark, d, "url", "price").select("source", "source_id", "url", "price").unionByName(promoted)


@plan.query("snk_04", f"WITH {LISTINGS}, i AS (SELECT source, source_id, price FROM (SELECT source, source_id, price, row_number() OVER (PARTITION BY source, source_id ORDER BY seen_at DESC NULLS LAST, price DESC NULLS LAST) AS k FROM price_history) WHERE k = 1) SELECT coalesce(l.source, i.source) AS source, coalesce(l.source_id, i.source_id) AS source_id, CASE WHEN i.source IS NULL THEN l.price ELSE i.price END AS price, CASE WHEN i.source IS NULL THEN l.url END AS url FROM l FULL JOIN i ON l.source = i.source AND l.source_id = i.source_id")
def snk_04(spark, d):
    """Keyed upsert: a whole row is replaced, columns that don't arrive become NULL."""
    incoming = load(spark, d, "price_history").select("source", "source_id", "price", "seen_at")
    now = listings(spark, d, "price", "url").select("source", "source_id", "price", "url")
    return upsert(now, incoming, ["source", "source_id"], [F.col("seen_at"), F.col("price")]).select("source", "source_id", "price", "url")


@plan.query("snk_05", f"WITH {LISTINGS}, i AS (SELECT DISTINCT site AS source, url AS source_id FROM agency_site_listings UNION SELECT DISTINCT source, source_id FROM price_history) SELECT source, source_id FROM l UNION SELECT source, source_id FROM i")
def snk_05(spark, d):
    """Insert where the key is absent, the first writer wins: sightings and agency pages beside all listings."""
    now = listings(spark, d).select("source", "source_id")
    pages = load(spark, d, "agency_site_listings").select(F.col("site").alias("source"), F.col("url").alias("source_id"), F.col("harvested_on").alias("seen_at"))
    incoming = load(spark, d, "price_history").select("source", "source_id", "seen_at").unionByName(pages)
    return insert_absent(now, incoming, ["source", "source_id"], [F.col("seen_at")]).select("source", "source_id")


@plan.query("snk_09", f"WITH {LISTINGS} SELECT url, coalesce(max(left(last_seen, 10)), (SELECT left(max(fetched_at), 10) FROM l)) AS lastmod FROM l GROUP BY url")
def snk_09(spark, d):
    """Sitemap rows: unique sorted links with the row's date, else the corpus date."""
    rows = listings(spark, d, "url", "last_seen", "fetched_at")
    corpus = rows.agg(F.left(F.max("fetched_at"), F.lit(10)).alias("c")).scalar()
    per = rows.groupBy("url").agg(F.max(F.left("last_seen", F.lit(10))).alias("m"))
    return per.select("url", F.coalesce("m", corpus).alias("lastmod")).orderBy("url")


@plan.query("win_01", f"WITH {LISTINGS} SELECT rec, price FROM l WHERE price > 0 ORDER BY price DESC, rec LIMIT 10")
def win_01(spark, d):
    """Top ten."""
    return listings(spark, d, "price").where("price > 0").select("rec", "price").orderBy(F.col("price").desc(), "rec").limit(10)


@plan.query("win_03", f"WITH {SEEN} SELECT rec, us, price, lag(price) OVER (PARTITION BY rec ORDER BY us) AS prev FROM s")
def win_03(spark, d):
    """The price before."""
    return seen(spark, d).select("rec", "us", "price", F.lag("price").over(W.partitionBy("rec").orderBy("us")).alias("prev"))


@plan.query("win_04", f"WITH {SEEN} SELECT rec, min(us) AS first_us, max(us) AS last_us, count(*) AS n FROM s GROUP BY rec")
def win_04(spark, d):
    return seen(spark, d).groupBy("rec").agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.count("*").alias("n"))


@plan.query("win_05", f"WITH {SEEN}, r AS (SELECT DISTINCT {DAY} AS run FROM s) SELECT run, lead(run) OVER (ORDER BY run) AS nxt FROM r")
def win_05(spark, d):
    """The run behind each run."""
    r = seen(spark, d).select(utc_date_text(F.col("at")).alias("run")).distinct()
    return r.withColumn("nxt", F.lead("run").over(W.orderBy("run")))  # one row a run


@plan.query("win_06", "SELECT url, title, price FROM (SELECT url, title, price, row_number() OVER (PARTITION BY url ORDER BY coalesce(title, '') = '', title, price NULLS LAST) AS k FROM (SELECT DISTINCT url, title, price FROM agency_site_listings)) WHERE k = 1")
def win_06(spark, d):
    """One answer per link, rows with a title first."""
    w = W.partitionBy("url").orderBy(F.coalesce("title", F.lit("")) == "", "title", F.col("price").asc_nulls_last())
    return load(spark, d, "agency_site_listings").select("url", "title", "price").distinct().withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


@plan.query("win_07", "SELECT url_alt, source, source_id, count(*) OVER (PARTITION BY url_alt) AS per_page, count(*) OVER (PARTITION BY source, source_id) AS per_listing FROM (SELECT DISTINCT url_alt, source, source_id FROM url_alt)")
def win_07(spark, d):
    """Ambiguity on both sides of a link."""
    u = load(spark, d, "url_alt").select("url_alt", "source", "source_id").distinct()
    return u.withColumn("per_page", F.count("*").over(W.partitionBy("url_alt"))).withColumn("per_listing", F.count("*").over(W.partitionBy("source", "source_id")))


@plan.query("win_08", f"WITH {LISTINGS} SELECT rec, count(*) OVER (PARTITION BY {AREA('comune')}, price) AS same_price FROM l WHERE price > 0")
def win_08(spark, d):
    """How rare a price is in its area."""
    from pagliaio.functions.text import area_key

    rows = listings(spark, d, "comune", "price").where("price > 0").withColumn("area", area_key(F.col("comune")))
    return rows.select("rec", F.count("*").over(W.partitionBy("area", "price")).alias("same_price"))


@plan.query("win_12", f"WITH {LISTINGS}, a AS (SELECT {AREA('comune')} AS area, count(*) AS n FROM l GROUP BY 1), p AS (SELECT area, row_number() OVER (ORDER BY n DESC, area) - 1 AS priority FROM a) SELECT rec, priority FROM l JOIN p ON p.area = {AREA('comune')}")
def win_12(spark, d):
    """Harvest order by area, the largest first."""
    rows = listings(spark, d, "comune").select("rec", area_key(F.col("comune")).alias("area"))
    # One row an area is ranked, not the listings.
    order = rows.groupBy("area").agg(F.count("*").alias("n")).select("area", (F.row_number().over(W.orderBy(F.desc("n"), "area")) - 1).alias("priority"))
    return rows.join(order, "area").select("rec", F.col("priority").cast("long").alias("priority")).orderBy("priority", "rec")


@plan.query("win_13", f"WITH {SEEN}, r AS (SELECT DISTINCT us FROM s), n AS (SELECT us, row_number() OVER (ORDER BY us) - 1 AS i, count(*) OVER () AS c FROM r) SELECT us FROM n WHERE i IN (SELECT CAST(floor(k * (SELECT max(c) FROM n) / 20.0) AS BIGINT) FROM range(20) t(k))")
def win_13(spark, d):
    """Even sample of an ordered list: twenty places at equal steps.

    The global order comes from a range-partitioned sort with per-partition counts,
    not from one window over all rows.
    """
    r = seen(spark, d).select("us").distinct()
    ordered = r.repartitionByRange("us").sortWithinPartitions("us").select("us", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"))
    ordered = ordered.withColumn("i", F.col("m") - (F.col("p").cast("long") * F.lit(1 << 33)))
    from pagliaio.session import cut_lineage

    ordered = cut_lineage(ordered)
    sizes = ordered.groupBy("p").agg(F.count("*").alias("n"))
    starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(W.orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("c", F.sum("n").over(W.partitionBy()))
    spots = starts.select("p", "start", "n", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("k"), "c").withColumn("at", F.floor(F.col("k") * F.col("c") / F.lit(20.0)).cast("long"))
    wanted = spots.where("at >= start AND at < start + n").select("p", (F.col("at") - F.col("start")).alias("i"))
    return ordered.join(F.broadcast(wanted), ["p", "i"], "left_semi").select("us")  # twenty rows


@plan.query("win_15", f"WITH {LISTINGS} SELECT {AREA('comune')} AS area, rec FROM l WHERE dom_est IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {AREA('comune')} ORDER BY dom_est DESC, rec) <= 60")
def win_15(spark, d):
    """The sixty oldest of each area (a report)."""
    from pagliaio.functions.text import area_key

    rows = listings(spark, d, "comune", "dom_est").where("dom_est IS NOT NULL").withColumn("area", area_key(F.col("comune")))
    return rows.withColumn("k", F.row_number().over(W.partitionBy("area").orderBy(F.col("dom_est").desc(), "rec"))).where("k <= 60").select("area", "rec")


@plan.query("set_01", "WITH e AS (SELECT source || '/' || source_id AS rec, 'page' AS route FROM url_alt UNION SELECT unnest(ids), 'verdict' FROM verified_clusters UNION SELECT source || '/' || source_id, 'picture' FROM photo_hashes) SELECT rec, list_aggregate(list_sort(list(DISTINCT route)), 'string_agg', '+') AS evidence FROM e GROUP BY rec")
def set_01(spark, d):
    """Union of evidence routes, merged by record."""
    e = (
        load(spark, d, "url_alt").select(rec_name().alias("rec"), F.lit("page").alias("route"))
        .unionByName(load(spark, d, "verified_clusters").select(F.explode("ids").alias("rec"), F.lit("verdict").alias("route")))
        .unionByName(load(spark, d, "photo_hashes").select(rec_name().alias("rec"), F.lit("picture").alias("route")))
    )
    return e.groupBy("rec").agg(F.array_join(F.array_sort(F.collect_set("route")), "+").alias("evidence"))  # at most three routes a record


@plan.query("set_02", "SELECT DISTINCT url FROM agency_site_listings EXCEPT SELECT url_alt FROM url_alt")
def set_02(spark, d):
    """Links not seen before."""
    return load(spark, d, "agency_site_listings").select("url").distinct().join(load(spark, d, "url_alt").select(F.col("url_alt").alias("url")), "url", "left_anti")


@plan.query("set_03", "SELECT a.ord AS inner_ord, b.ord AS outer_ord FROM verified_clusters a JOIN verified_clusters b ON a.ord <> b.ord AND list_has_all(b.ids, a.ids)")
def set_03(spark, d):
    """Sets contained in other sets; they meet on a shared member, not in a cross join."""
    v = load(spark, d, "verified_clusters").select("ord", F.array_distinct("ids").alias("ids"))
    e = v.select("ord", F.explode("ids").alias("m"), F.size("ids").alias("n"))
    shared = e.alias("a").join(e.alias("b"), F.col("a.m") == F.col("b.m")).where("a.ord <> b.ord").groupBy(F.col("a.ord").alias("inner_ord"), F.col("b.ord").alias("outer_ord")).agg(F.count("*").alias("k"), F.first("a.n").alias("n"))
    return shared.where("k = n").select("inner_ord", "outer_ord")


@plan.query("set_04", "WITH b AS (SELECT url_alt AS url, min(matched_on) AS day FROM url_alt GROUP BY 1), i AS (SELECT url, min(harvested_on) AS day FROM agency_site_listings GROUP BY 1) SELECT url, day FROM b UNION ALL SELECT url, day FROM i WHERE url NOT IN (SELECT url FROM b)")
def set_04(spark, d):
    """Merge by key, existing rows win."""
    b = load(spark, d, "url_alt").groupBy(F.col("url_alt").alias("url")).agg(F.min("matched_on").alias("day"))
    i = load(spark, d, "agency_site_listings").groupBy("url").agg(F.min("harvested_on").alias("day"))
    return insert_absent(b, i, ["url"], [F.col("day")])


@plan.query("set_05", "SELECT 'listing' AS kind, count(*) AS n FROM listings UNION ALL SELECT 'page', count(*) FROM agency_site_listings")
def set_05(spark, d):
    """Several loads in one table."""
    rows = load(spark, d, "listings").select(F.lit("listing").alias("kind")).unionByName(load(spark, d, "agency_site_listings").select(F.lit("page").alias("kind")))
    return rows.groupBy("kind").agg(F.count("*").alias("n"))


@plan.query("set_06", "SELECT url FROM listings WHERE url IS NOT NULL UNION SELECT url FROM agency_site_listings WHERE url IS NOT NULL")
def set_06(spark, d):
    """Distinct links over all generators, sorted."""
    both = load(spark, d, "listings").select("url").unionByName(load(spark, d, "agency_site_listings").select("url"))
    return both.where("url IS NOT NULL").distinct().orderBy("url")


@plan.query("set_07", "SELECT ord, len(list_intersect(ids, coalesce(drop_ids, []))) > 0 AS touches FROM verified_clusters")
def set_07(spark, d):
    """Whether two sets share a member."""
    return load(spark, d, "verified_clusters").select("ord", F.arrays_overlap("ids", F.coalesce("drop_ids", F.array().cast("array<string>"))).alias("touches"))


@plan.query("gate_08", f"WITH {LISTINGS} SELECT count(*) AS n, count(*) FILTER (price > 0 AND mq > 0) AS usable, count(*) FILTER (price > 0 AND mq > 0) < 30 OR count(*) FILTER (price > 0 AND mq > 0)::DOUBLE / count(*) < 0.4 AS warning FROM l")
def gate_08(spark, d):
    usable = F.count_if((F.col("price") > 0) & (F.col("mq") > 0))
    return listings(spark, d, "price", "mq").agg(F.count("*").alias("n"), usable.alias("usable"), ((usable < 30) | (usable.cast("double") / F.count("*") < 0.4)).alias("warning"))
