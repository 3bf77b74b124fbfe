"""Joins and entity resolution over listings, bands, pages, pictures and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagliaio.functions.text import area_key, hash_bits, plain_url, street_joined
from pagliaio.operators.graph import components
from pagliaio.operators.quantiles import quantiles
from pagliaio.operators.similarity import near_hashes
from pagliaio.plans.offers import AREA, FOLD, URL
from pagliaio.plans.registry import LISTINGS, Plan, half_up, half_up_sql, listings
from pagliaio.session import cut_lineage
from pagliaio.tables import broadcast_if_small, load, rec_name

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql

# Which types of the official bands stand for which types of listings.
BAND_TYPES = {"Abitazioni civili": ["appartamento", "terratetto"], "Abitazioni di tipo economico": ["appartamento", "terratetto"], "Ville e Villini": ["villa", "rustico"], "Abitazioni signorili": ["appartamento", "villa"]}
SEMESTER = "2025-S2"
_MAP = ", ".join(f"('{t}', '{x}')" for t, xs in BAND_TYPES.items() for x in xs)
BANDS = f"b AS (SELECT DISTINCT {AREA('comune')} AS area, zona_code, tipologia, min_eur_m2 AS lo, max_eur_m2 AS hi FROM omi_bands WHERE semester = '{SEMESTER}' AND min_eur_m2 IS NOT NULL AND max_eur_m2 IS NOT NULL)"
_STREET2 = f"nullif(list_aggregate(list_filter(regexp_split_to_array(regexp_replace(lower({FOLD('address_raw')}), '[^a-z0-9 ]', '', 'g'), ' +'), lambda w: w <> '' AND NOT regexp_matches(w, '^[0-9]+$')), 'string_agg', ''), '')"


def bands(spark, d):
    raw = load(spark, d, "omi_bands").where(f"semester = '{SEMESTER}' AND min_eur_m2 IS NOT NULL AND max_eur_m2 IS NOT NULL")
    return raw.select(area_key(F.col("comune")).alias("area"), "zona_code", "tipologia", F.col("min_eur_m2").alias("lo"), F.col("max_eur_m2").alias("hi")).distinct()


@plan.query("joi_01", f"WITH {LISTINGS}, {BANDS}, n AS (SELECT area, count(*) AS n_bands FROM b GROUP BY area), a AS (SELECT {AREA('comune')} AS area, count(*) AS n_listings FROM l GROUP BY 1) SELECT area, n_listings, coalesce(n_bands, 0) AS n_bands FROM a LEFT JOIN n USING (area)")
def joi_01(spark, d):
    """Listings and reference bands by area; areas without bands show up with none."""
    per_area = listings(spark, d, "comune").groupBy(area_key(F.col("comune")).alias("area")).agg(F.count("*").alias("n_listings"))
    n = bands(spark, d).groupBy("area").agg(F.count("*").alias("n_bands"))
    return per_area.join(broadcast_if_small(n), "area", "left").select("area", "n_listings", F.coalesce("n_bands", F.lit(0)).alias("n_bands"))


def _cascade(spark, d, typology):
    """First non-empty of: mapped types, then all dwellings; within it exact zone, then zone letter, then area."""
    rows = listings(spark, d, "comune", "typology", "zona_poly").select("rec", area_key(F.col("comune")).alias("area"), typology.alias("typ"), F.coalesce("zona_poly", F.lit("")).alias("zone"))
    mapping = spark.createDataFrame([(t, x) for t, xs in BAND_TYPES.items() for x in xs], "tipologia string, typ string")
    b = bands(spark, d)
    typed = b.join(F.broadcast(mapping), "tipologia").select("*", F.lit(0).alias("fallback"))  # seven fixed rows
    any_home = b.where("tipologia <> 'Box'").select("*", F.lit(1).alias("fallback"))
    pairs = rows.join(broadcast_if_small(typed.select("area", "typ", "zona_code", "lo", "hi", "fallback")), ["area", "typ"]).unionByName(rows.join(broadcast_if_small(any_home.drop("tipologia")), "area").select("area", "typ", "rec", "zone", "zona_code", "lo", "hi", "fallback"))
    levels = F.array_compact(F.array(F.when(F.col("zone") == F.col("zona_code"), 0), F.when(F.left("zone", F.lit(1)) == F.left("zona_code", F.lit(1)), 1), F.lit(2)))
    per_level = pairs.withColumn("level", F.explode(levels)).groupBy("rec", "fallback", "level").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    best = per_level.groupBy("rec").agg(F.min(F.struct("fallback", "level", "lo", "hi")).alias("x"))
    how = F.concat(F.when(F.col("x.fallback") == 0, "typology").otherwise("residential-fallback"), F.lit("+"), F.when(F.col("x.level") == 0, "zone-exact").when(F.col("x.level") == 1, "zone").otherwise("area"))
    return best.select("rec", "x.lo", "x.hi", how.alias("how"))


def _cascade_sql(typ):
    return f"""WITH {LISTINGS}, {BANDS}, m(tipologia, typ) AS (VALUES {_MAP}),
    r AS (SELECT rec, {AREA('comune')} AS area, {typ} AS typ, coalesce(zona_poly, '') AS zone FROM l),
    p AS (SELECT rec, zone, zona_code, lo, hi, 0 AS fallback FROM r JOIN b USING (area) JOIN m USING (tipologia, typ)
          UNION ALL SELECT rec, zone, zona_code, lo, hi, 1 FROM r JOIN b USING (area) WHERE tipologia <> 'Box'),
    v AS (SELECT rec, fallback, 0 AS level, lo, hi FROM p WHERE zone = zona_code UNION ALL SELECT rec, fallback, 1, lo, hi FROM p WHERE left(zone, 1) = left(zona_code, 1) UNION ALL SELECT rec, fallback, 2, lo, hi FROM p),
    g AS (SELECT rec, fallback, level, min(lo) AS lo, max(hi) AS hi FROM v GROUP BY ALL)
    SELECT rec, lo, hi, CASE fallback WHEN 0 THEN 'typology' ELSE 'residential-fallback' END || '+' || CASE level WHEN 0 THEN 'zone-exact' WHEN 1 THEN 'zone' ELSE 'area' END AS how
    FROM g QUALIFY row_number() OVER (PARTITION BY rec ORDER BY fallback, level) = 1"""


@plan.query("joi_02", _cascade_sql("typology"))
def joi_02(spark, d):
    """Cascading match of listings with reference bands."""
    return _cascade(spark, d, F.col("typology"))


@plan.query("joi_03", _cascade_sql("CASE typology WHEN 'rustico' THEN 'appartamento' ELSE typology END"))
def joi_03(spark, d):
    """The same match with another reading of one type."""
    return _cascade(spark, d, F.when(F.col("typology") == "rustico", "appartamento").otherwise(F.col("typology")))


_OFFERS = f"""{LISTINGS}, o AS (SELECT rec, {AREA('comune')} AS area, price, mq, coalesce(agency_name, source) AS seller, {_STREET2} AS street, ltrim(lower(agency_ref), '0') AS ref FROM l)"""


def offers(spark, d):
    return listings(spark, d, "comune", "price", "mq", "agency_name", "address_raw", "agency_ref").select(
        "rec", area_key(F.col("comune")).alias("area"), "price", "mq", F.coalesce("agency_name", "source").alias("seller"), street_joined(F.col("address_raw")).alias("street"), F.ltrim(F.lower("agency_ref"), F.lit("0")).alias("ref")
    )


def close_pairs(o):
    """``rec_a, rec_b`` of ``offers``: equal area and price, sizes within 15 per cent, streets that don't contradict."""
    o = o.where("price > 0").drop("ref")
    rare = o.groupBy("area", "price").agg(F.count("*").alias("k"))
    o = o.where("mq > 0").join(rare, ["area", "price"]).withColumn("band", F.floor(F.log("mq") / F.log(F.lit(1.16))))
    a, b = o.alias("a"), o.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).alias("b")
    x = lambda side, c: F.col(f"{side}.{c}")
    close = (F.greatest("a.mq", "b.mq") - F.least("a.mq", "b.mq")).cast("double") / F.least("a.mq", "b.mq") <= 0.15
    street = F.when(x("a", "street").isNull() | x("b", "street").isNull(), x("a", "k") <= 2).otherwise(F.contains("a.street", "b.street") | F.contains("b.street", "a.street"))
    on = (x("a", "area") == x("b", "area")) & (x("a", "price") == x("b", "price")) & (x("a", "band") == x("b", "band")) & (x("a", "rec") < x("b", "rec")) & (x("a", "seller") != x("b", "seller"))
    return a.join(b, on).where(close & street).select(x("a", "rec").alias("rec_a"), x("b", "rec").alias("rec_b"))


_PRICE_GROUPS = "g AS (SELECT area, price, count(*) AS n, count(DISTINCT seller) AS sellers, min(rec) AS first_rec FROM o WHERE price > 0 AND price % 1000 <> 0 GROUP BY area, price HAVING count(DISTINCT seller) >= 2)"


@plan.query("joi_04", f"WITH {_OFFERS}, {_PRICE_GROUPS} SELECT * FROM g")
def joi_04(spark, d):
    """Exact-price groups of several sellers; round prices don't count."""
    o = offers(spark, d).where("price > 0 AND price % 1000 <> 0")
    return o.groupBy("area", "price").agg(F.count("*").alias("n"), F.countDistinct("seller").alias("sellers"), F.min("rec").alias("first_rec")).where("sellers >= 2")


@plan.query(
    "joi_05",
    f"""WITH {_OFFERS}, p AS (SELECT *, count(*) OVER (PARTITION BY area, price) AS k FROM o WHERE price > 0)
    SELECT a.rec AS rec_a, b.rec AS rec_b FROM p a JOIN p b ON a.area = b.area AND a.price = b.price AND a.rec < b.rec AND a.seller <> b.seller
    WHERE a.mq > 0 AND b.mq > 0 AND (greatest(a.mq, b.mq) - least(a.mq, b.mq))::DOUBLE / least(a.mq, b.mq) <= 0.15
      AND CASE WHEN a.street IS NULL OR b.street IS NULL THEN a.k <= 2 ELSE contains(a.street, b.street) OR contains(b.street, a.street) END""",
)
def joi_05(spark, d):
    """Equal price and close size by different sellers; streets must not contradict, or the price must be rare.

    Sizes within 15 per cent lie in one band of that width or in neighbouring ones, so
    the band joins the key: a common price is not compared all against all.
    """
    return close_pairs(offers(spark, d))


@plan.query(
    "joi_06",
    f"""WITH {_OFFERS}, r AS (SELECT area, ref, count(*) AS n, count(DISTINCT seller) AS sellers, sum(price) AS total, bit_xor(hash(rec)) AS x FROM o WHERE ref <> '' GROUP BY area, ref HAVING count(DISTINCT seller) >= 2),
    {_PRICE_GROUPS.replace("min(rec) AS first_rec", "bit_xor(hash(rec)) AS x")}
    SELECT r.area, r.ref, r.n, EXISTS (SELECT 1 FROM g WHERE g.area = r.area AND g.x = r.x AND g.n = r.n) AS corroborates FROM r""",
)
def joi_06(spark, d):
    """References shared by sellers, and whether they confirm exactly the members of a price group."""
    o = offers(spark, d)
    # Sets are compared by the sum and the exclusive or of two different hashes of their members, and their number.
    members = F.concat_ws("/", F.bit_xor(F.xxhash64("rec")), F.sum(F.xxhash64(F.lit(1), F.col("rec")).cast("decimal(38,0)")))
    refs = o.where("ref <> ''").groupBy("area", "ref").agg(F.count("*").alias("n"), F.countDistinct("seller").alias("sellers"), members.alias("x")).where("sellers >= 2")
    groups = o.where("price > 0 AND price % 1000 <> 0").groupBy("area", "price").agg(F.count("*").alias("n"), F.countDistinct("seller").alias("sellers"), members.alias("x")).where("sellers >= 2").select("area", "n", "x", F.lit(True).alias("hit")).distinct()
    return refs.join(groups, ["area", "n", "x"], "left").select("area", "ref", "n", F.coalesce("hit", F.lit(False)).alias("corroborates"))


_PICTURES = "ph AS (SELECT DISTINCT source || '/' || source_id AS rec, ('0x' || lower(trim(dhash)))::UBIGINT AS h FROM photo_hashes WHERE trim(dhash) <> ''), k AS (SELECT h FROM ph GROUP BY h HAVING count(*) <= 3), q AS (SELECT rec, h FROM ph JOIN k USING (h))"


def pictures(spark, d, most=3):
    """Distinct (rec, h) without pictures that more than ``most`` listings show."""
    ph = load(spark, d, "photo_hashes").where("trim(dhash) <> ''").select(rec_name().alias("rec"), hash_bits(F.trim("dhash")).alias("h")).distinct()
    shared = ph.groupBy("h").agg(F.count("*").alias("n"))
    # A hash above the limit is dropped by an anti-join; such hashes are few.
    return ph.join(broadcast_if_small(shared.where(F.col("n") > most).select("h")), "h", "left_anti")


@plan.query("joi_07", f"WITH {_PICTURES} SELECT a.rec AS rec_a, b.rec AS rec_b, count(DISTINCT a.h) AS shared FROM q a JOIN q b ON a.rec < b.rec AND bit_count(xor(a.h, b.h)) <= 5 GROUP BY ALL")
def joi_07(spark, d):
    """Listings with pictures within five bits, and how many of the first one's."""
    q = pictures(spark, d)
    near = near_hashes(q, "h", 5).select("h1", "h2")
    reach = near.unionByName(near.select(F.col("h2").alias("h1"), F.col("h1").alias("h2"))).unionByName(q.select(F.col("h").alias("h1"), F.col("h").alias("h2")).distinct())
    a = q.select(F.col("rec").alias("rec_a"), F.col("h").alias("h1"))
    b = q.select(F.col("rec").alias("rec_b"), F.col("h").alias("h2"))
    return a.join(reach, "h1").join(b, "h2").where("rec_a < rec_b").groupBy("rec_a", "rec_b").agg(F.countDistinct("h1").alias("shared"))


_CLAIMS = f"""s AS (SELECT DISTINCT site, url, lower(trim(ref)) AS ref, {AREA('comune')} AS area, price, mq FROM agency_site_listings WHERE coalesce(is_rent, 0) = 0),
    w AS (SELECT source, lower(trim(agency_ref)) AS ref, min(rec) AS rec FROM l WHERE trim(agency_ref) <> '' GROUP BY ALL HAVING count(*) = 1),
    rr AS (SELECT DISTINCT s.url, w.rec FROM s JOIN w ON w.source = 'ag-' || split_part(s.site, '.', 1) AND w.ref = s.ref),
    c AS (SELECT DISTINCT s.url, o.rec, s.mq AS m1, o.mq AS m2 FROM s JOIN o ON s.price = o.price AND s.price > 0 AND (s.area = o.area OR s.area = '' OR o.area = '') WHERE o.rec NOT IN (SELECT rec FROM rr)),
    e AS (SELECT url, rec, CASE WHEN m1 > 0 AND m2 > 0 THEN CASE WHEN abs(m1 - m2) <= 0.15 * greatest(m1, m2) THEN 'price+surface+comune' END
            WHEN count(*) OVER (PARTITION BY url) = 1 AND count(*) OVER (PARTITION BY rec) = 1 THEN 'price+comune' END AS route, coalesce(m1 = m2, FALSE) AS exact FROM c),
    f AS (SELECT *, count(*) OVER (PARTITION BY url) AS nu, count(*) OVER (PARTITION BY rec) AS nr, count(*) FILTER (exact) OVER (PARTITION BY url) AS xu, count(*) FILTER (exact) OVER (PARTITION BY rec) AS xr FROM e WHERE route IS NOT NULL)"""


@plan.query("joi_09", f"WITH {_OFFERS}, {_CLAIMS} SELECT url, rec, route FROM f WHERE (nu = 1 AND nr = 1) OR (exact AND xu = 1 AND xr = 1) UNION ALL SELECT url, rec, 'ref' FROM rr")
def joi_09(spark, d):
    """Pages and listings by the site's own reference where one listing has it, else by price, area and size.

    A side that is claimed twice drops out unless one exact pair stands out. Prices meet inside an area; only
    rows without an area meet those of every area.
    """
    o = offers(spark, d).select("rec", F.col("area").alias("o_area"), "price", F.col("mq").alias("m2"))
    site = load(spark, d, "agency_site_listings").where("coalesce(is_rent, 0) = 0")
    own = listings(spark, d, "agency_ref").where("trim(agency_ref) <> ''").groupBy("source", F.lower(F.trim("agency_ref")).alias("ref")).agg(F.count("*").alias("n"), F.min("rec").alias("rec")).where("n = 1")
    named = site.select("url", F.concat(F.lit("ag-"), F.split_part("site", F.lit("."), F.lit(1))).alias("source"), F.lower(F.trim("ref")).alias("ref"))
    by_ref = cut_lineage(named.join(own, ["source", "ref"]).select("url", "rec", F.lit("ref").alias("route")).distinct())
    s = site.where("price > 0").select("url", area_key(F.col("comune")).alias("area"), "price", F.col("mq").alias("m1")).distinct()
    o = o.where("price > 0").join(by_ref.select("rec").distinct(), "rec", "left_anti")
    placed = s.where("area <> ''").join(o.withColumn("area", F.col("o_area")).where("o_area <> ''"), ["area", "price"])
    loose = s.where("area = ''").join(o, "price").unionByName(s.where("area <> ''").join(o.where("o_area = ''"), "price"))
    c = placed.select("url", "rec", "m1", "m2").unionByName(loose.select("url", "rec", "m1", "m2")).distinct()
    by_url, by_rec = W.partitionBy("url"), W.partitionBy("rec")
    sized = (F.col("m1") > 0) & (F.col("m2") > 0)
    close = F.when(F.abs(F.col("m1") - F.col("m2")) <= F.lit(0.15) * F.greatest("m1", "m2"), "price+surface+comune")
    route = F.when(F.coalesce(sized, F.lit(False)), close).when((F.count("*").over(by_url) == 1) & (F.count("*").over(by_rec) == 1), "price+comune")
    e = c.select("url", "rec", route.alias("route"), F.coalesce(F.col("m1") == F.col("m2"), F.lit(False)).alias("exact")).where("route IS NOT NULL")
    one = lambda w: F.count("*").over(w) == 1
    single = lambda w: F.count_if("exact").over(w) == 1
    f = e.select("url", "rec", "route", ((one(by_url) & one(by_rec)) | (F.col("exact") & single(by_url) & single(by_rec))).alias("keep"))
    return f.where("keep").select("url", "rec", "route").unionByName(by_ref)


@plan.query(
    "joi_10",
    f"""WITH {LISTINGS}, o AS (SELECT rec, {AREA('comune')} AS area, {_STREET2} AS street, price::DOUBLE AS p, mq::DOUBLE AS m, vani, typology, floor FROM l),
    s AS (SELECT a.rec AS rec_a, b.rec AS rec_b,
      CASE WHEN a.p > 0 AND b.p > 0 THEN CASE WHEN abs(a.p - b.p) / greatest(a.p, b.p) < 0.005 THEN 3 WHEN abs(a.p - b.p) / greatest(a.p, b.p) < 0.05 THEN 1 ELSE 0 END ELSE 0 END
      + CASE WHEN a.m > 0 AND b.m > 0 THEN CASE WHEN abs(a.m - b.m) / greatest(a.m, b.m) <= 0.03 THEN 2 WHEN abs(a.m - b.m) / greatest(a.m, b.m) <= 0.15 THEN 1 ELSE -1 END ELSE 0 END
      + coalesce((a.vani = b.vani)::INT, 0) + coalesce((a.typology = b.typology)::INT, 0) + coalesce((a.floor = b.floor)::INT, 0) AS score
      FROM o a JOIN o b ON a.area = b.area AND a.street = b.street AND a.rec < b.rec)
    SELECT * FROM s WHERE score >= 3""",
)
def joi_10(spark, d):
    """Score match inside one street: price, size, rooms, type and floor add up to three or more.

    Rooms, type and floor alone reach three only together; every other pair of that score is near in price (within
    5 per cent) or size (within 15), so pairs meet in bands of these, or in equal rooms, type and floor.
    """
    o = listings(spark, d, "comune", "address_raw", "price", "mq", "vani", "typology", "floor").select("rec", area_key(F.col("comune")).alias("area"), street_joined(F.col("address_raw")).alias("street"), F.col("price").cast("double").alias("p"), F.col("mq").cast("double").alias("m"), "vani", "typology", "floor")
    # Spark may work out a ratio that is used twice before it asks whether both values are there: zeros must not divide.
    rel = lambda c: F.try_divide(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")), F.greatest(f"a.{c}", f"b.{c}"))
    both = lambda c: (F.col(f"a.{c}") > 0) & (F.col(f"b.{c}") > 0)
    same = lambda c: F.coalesce((F.col(f"a.{c}") == F.col(f"b.{c}")).cast("int"), F.lit(0))
    score = F.when(both("p") & (rel("p") < 0.005), 3).when(both("p") & (rel("p") < 0.05), 1).otherwise(0) + F.when(both("m") & (rel("m") <= 0.03), 2).when(both("m") & (rel("m") <= 0.15), 1).when(both("m"), -1).otherwise(0) + same("vani") + same("typology") + same("floor")
    band = lambda c, width, sides: F.when(F.col(c) > 0, F.transform(F.array(*[F.lit(s) for s in sides]), lambda s: F.concat(F.lit(f"{c}:"), (F.floor(F.log(c) / F.lit(width)) + s).cast("string"))))
    none = F.array().cast("array<string>")
    alike = F.when(F.col("vani").isNotNull() & F.col("typology").isNotNull() & F.col("floor").isNotNull(), F.array(F.concat_ws("/", F.lit("t"), F.col("vani").cast("string"), "typology", "floor")))
    keyed = lambda sides: o.withColumn("key", F.explode(F.concat(F.coalesce(band("p", 0.0513, sides), none), F.coalesce(band("m", 0.1626, sides), none), F.coalesce(alike, none))))
    a, b = keyed((0,)).alias("a"), keyed((-1, 0, 1)).alias("b")
    on = (F.col("a.area") == F.col("b.area")) & (F.col("a.street") == F.col("b.street")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.rec") < F.col("b.rec"))
    return a.join(b, on).select(F.col("a.rec").alias("rec_a"), F.col("b.rec").alias("rec_b"), score.alias("score")).where("score >= 3").distinct()


#: Zones of the query joi_11: code, order, outer ring and holes as corners (x, y).
ZONES = [("Z1", 1, [(3.05, 41.1), (3.25, 41.1), (3.25, 41.35), (3.05, 41.35)], [[(3.1, 41.15), (3.2, 41.15), (3.15, 41.3)]]), ("Z2", 2, [(3.0, 41.2), (3.4, 41.2), (3.2, 41.8)], []), ("Z3", 3, [(2.5, 40.5), (4.0, 40.5), (4.0, 42.5), (2.5, 42.5)], [[(3.3, 41.0), (3.6, 41.0), (3.6, 41.4), (3.3, 41.4)]])]


def zone_of(points: DataFrame, zones: DataFrame) -> DataFrame:
    """``key, zone``: the first zone (by ord) that holds the point; ``points`` has key, area, lat and lon.

    ``zones`` is what ``read_zones`` gives: comune, ord, zone_code, outer_ring, holes. A zone with a comune holds
    points of that area only; holes are outside. Rays are cast at all rings alike, after the boxes have pruned.
    """
    corners = F.transform(F.concat(F.array("outer_ring"), F.coalesce("holes", F.array().cast("array<array<struct<x:double,y:double>>>"))), lambda ring: F.zip_with(ring, F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1)), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))))
    of = lambda c: F.transform("outer_ring", lambda p: p[c])
    box = zones.where("size(outer_ring) > 2").select(F.col("zona_code").alias("code"), "ord", F.nullif(area_key(F.col("comune")), F.lit("")).alias("z_area"), F.flatten(corners).alias("edges"), F.array_min(of("x")).alias("xa"), F.array_max(of("x")).alias("xb"), F.array_min(of("y")).alias("ya"), F.array_max(of("y")).alias("yb"))
    crosses = lambda e: ((e["y1"] > F.col("lat")) != (e["y2"] > F.col("lat"))) & F.coalesce(F.col("lon") < F.try_divide((e["x2"] - e["x1"]) * (F.col("lat") - e["y1"]), e["y2"] - e["y1"]) + e["x1"], F.lit(False))
    inside = F.aggregate("edges", F.lit(False), lambda acc, e: acc != crosses(e))
    near = F.col("lon").between(F.col("xa"), F.col("xb")) & F.col("lat").between(F.col("ya"), F.col("yb")) & (F.col("z_area").isNull() | (F.col("z_area") == F.col("area")))
    hits = points.where("lat IS NOT NULL AND lon IS NOT NULL").join(broadcast_if_small(box), near).where(inside)
    return hits.groupBy("key").agg(F.min_by("code", "ord").alias("zone"))


@plan.query(
    "joi_11",
    f"""WITH {LISTINGS}, e(code, ord, x1, y1, x2, y2) AS (VALUES {", ".join(f"('{c}', {o}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for c, o, outer, holes in ZONES for ring in [outer, *holes] for a, b in zip(ring, ring[1:] + ring[:1]))}),
    h AS (SELECT rec, code, ord, count(*) FILTER ((y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1) % 2 AS odd FROM l, e WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY ALL)
    SELECT rec, min_by(code, ord) AS zone FROM h WHERE odd = 1 GROUP BY rec""",
)
def joi_11(spark, d):
    """Point in polygon by ray casting; of several zones the first counts, holes are outside."""
    corner = lambda ring: [{"x": float(x), "y": float(y)} for x, y in ring]
    zones = spark.createDataFrame([(None, o, c, corner(outer), [corner(h) for h in holes]) for c, o, outer, holes in ZONES], "comune string, ord int, zona_code string, outer_ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>")
    points = listings(spark, d, "lat", "lon", "comune").select(F.col("rec").alias("key"), area_key(F.col("comune")).alias("area"), "lat", "lon")
    return zone_of(points, zones).withColumnRenamed("key", "rec")


#: Anchors of the query joi_12: a number and the day (since 1970) on which it was given out.
ANCHORS = [(100_100_000, 19000), (100_300_000, 19200), (100_420_000, 19230), (100_700_000, 19800), (100_900_000, 20000)]
#: Days that no estimate lies before, and spans of numbers from which on an estimate is no longer of high confidence.
FIRST_DAY, WIDE_GAP = 12_784, 8_000_000


def dated_ids(ids: DataFrame, anchors: DataFrame, as_of: int, wide_gap: int = WIDE_GAP, first_day: int = FIRST_DAY) -> DataFrame:
    """``ids`` with day and confidence: between two anchors (id, day) on the line, cut to [first_day, as_of], high or medium
    by the gap; up to the first and from the last only a bound is known. With fewer than two anchors neither."""
    order = W.orderBy("id")  # a hand-kept list
    known = anchors.groupBy("id").agg(F.min("day").alias("day"))
    spans = known.select(F.col("id").alias("x0"), F.col("day").alias("d0"), F.lead("id").over(order).alias("x1"), F.lead("day").over(order).alias("d1"), F.row_number().over(order).alias("k"))
    # Before the first anchor lies a span of its own.
    before = known.agg(F.lit(-(1 << 63)).cast("long").alias("x0"), F.lit(None).cast("int").alias("d0"), F.min("id").alias("x1"), F.min_by("day", "id").alias("d1"), F.lit(0).alias("k"), F.count("*").alias("all")).where("all > 1").drop("all")
    spans = spans.unionByName(before)
    j = ids.join(broadcast_if_small(spans), (F.col("id") >= F.col("x0")) & (F.col("x1").isNull() | (F.col("id") < F.col("x1"))), "left")
    line = F.floor(F.col("d0") + (F.col("id") - F.col("x0")).cast("double") * (F.col("d1") - F.col("d0")) / (F.col("x1") - F.col("x0"))).cast("int")
    lone = F.col("k").isNull() | ((F.col("k") == 1) & F.col("x1").isNull())  # fewer than two anchors
    early, first, last = F.col("k") == 0, (F.col("k") == 1) & (F.col("id") == F.col("x0")), F.col("x1").isNull()
    day = F.when(lone, None).when(early, F.col("d1")).when(first | last, F.col("d0")).otherwise(F.greatest(F.least(line, F.lit(as_of)), F.lit(first_day)))
    sure = F.when(lone, "none").when(early | first, "bound_old").when(last, "bound_new").when(F.col("x1") - F.col("x0") < wide_gap, "high").otherwise("medium")
    return j.select(*ids.columns, day.alias("day"), sure.alias("confidence"))


#: As-of day and gap of the query: the numbers of the test tables lie close together.
AS_OF, CLOSE_GAP = 19_900, 200_000


@plan.query(
    "joi_12",
    f"""WITH {LISTINGS}, a(id, day) AS (VALUES {", ".join(f"({i}, {x})" for i, x in ANCHORS)}), n AS (SELECT id, day, lead(id) OVER (ORDER BY id) AS id2, lead(day) OVER (ORDER BY id) AS day2 FROM a),
    q AS (SELECT rec, TRY_CAST(source_id AS BIGINT) AS id FROM l WHERE TRY_CAST(source_id AS BIGINT) IS NOT NULL)
    SELECT rec, CASE WHEN n.id IS NULL OR q.id = {ANCHORS[0][0]} THEN {ANCHORS[0][1]} WHEN n.id2 IS NULL THEN {ANCHORS[-1][1]} ELSE greatest(least(CAST(floor(n.day + (q.id - n.id)::DOUBLE * (n.day2 - n.day) / (n.id2 - n.id)) AS INTEGER), {AS_OF}), {FIRST_DAY}) END AS day,
      CASE WHEN n.id IS NULL OR q.id = {ANCHORS[0][0]} THEN 'bound_old' WHEN n.id2 IS NULL THEN 'bound_new' WHEN n.id2 - n.id < {CLOSE_GAP} THEN 'high' ELSE 'medium' END AS confidence
    FROM q ASOF LEFT JOIN n ON q.id >= n.id""",
)
def joi_12(spark, d):
    """Bracketing as-of with linear interpolation between anchors; outside them only a bound is known."""
    ids = listings(spark, d).select("rec", F.col("source_id").try_cast("long").alias("id")).where("id IS NOT NULL")
    return dated_ids(ids, spark.createDataFrame(ANCHORS, "id long, day int"), AS_OF, CLOSE_GAP).select("rec", "day", "confidence")


_CLUSTERS = "k AS (SELECT url_alt AS cluster, list_sort(list(DISTINCT source || '/' || source_id)) AS members FROM url_alt GROUP BY url_alt)"


def clusters(spark, d):
    """``cluster, rec``: the listings linked to one page; never collected, however many they are."""
    return load(spark, d, "url_alt").select(F.col("url_alt").alias("cluster"), rec_name().alias("rec")).distinct()


@plan.query(
    "joi_13",
    f"""WITH {_CLUSTERS}, m AS (SELECT k.cluster, v.ord, v.verdict, list_filter(k.members, lambda x: NOT list_contains(coalesce(v.drop_ids, []), x)) AS kept FROM k JOIN verified_clusters v
      ON (list_has_all(v.ids, k.members) OR (v.verdict <> 'confirmed' AND list_has_all(k.members, v.ids))))
    SELECT cluster, min_by(verdict, ord) AS verdict, min_by(len(kept), ord) AS kept FROM m GROUP BY cluster""",
)
def joi_13(spark, d):
    """Verdicts laid over clusters: containment either way rejects, only a whole cluster is confirmed; the first entry wins."""
    k = clusters(spark, d)
    v = load(spark, d, "verified_clusters").select("ord", "verdict", F.array_distinct("ids").alias("ids"), F.coalesce("drop_ids", F.array().cast("array<string>")).alias("drop_ids"))
    # Sets that contain each other share a member: they meet on it, and the shared members are counted.
    e = v.select("ord", "verdict", F.size("ids").alias("n_ids"), F.explode("ids").alias("rec"), F.array_contains("drop_ids", F.col("rec")).alias("drop"))
    sizes = k.groupBy("cluster").agg(F.count("*").alias("n"))
    shared = k.join(e, "rec").groupBy("cluster", "ord", "verdict", "n_ids").agg(F.count("*").alias("both"), F.count_if("drop").alias("dropped")).join(sizes, "cluster")
    hit = (F.col("both") == F.col("n")) | ((F.col("verdict") != "confirmed") & (F.col("both") == F.col("n_ids")))
    return shared.where(hit).groupBy("cluster").agg(F.min_by("verdict", "ord").alias("verdict"), F.min_by((F.col("n") - F.col("dropped")).cast("int"), "ord").alias("kept"))


@plan.query("joi_14", f"WITH {LISTINGS}, f AS (SELECT DISTINCT unnest(ids) AS rec FROM verified_clusters WHERE verdict = 'confirmed'), c AS (SELECT DISTINCT source || '/' || source_id AS rec FROM url_alt) SELECT rec, CASE WHEN rec IN (SELECT rec FROM f) THEN 'member' WHEN rec IN (SELECT rec FROM c) THEN 'candidate' ELSE 'none' END AS role FROM l")
def joi_14(spark, d):
    """Member of a finding, else candidate, else none."""
    f = load(spark, d, "verified_clusters").where("verdict = 'confirmed'").select(F.explode("ids").alias("rec")).distinct().withColumn("f", F.lit(True))
    c = load(spark, d, "url_alt").select(rec_name().alias("rec")).distinct().withColumn("c", F.lit(True))
    return listings(spark, d).select("rec").join(f, "rec", "left").join(c, "rec", "left").select("rec", F.when(F.col("f"), "member").when(F.col("c"), "candidate").otherwise("none").alias("role"))


@plan.query("joi_15", f"WITH {LISTINGS}, u AS (SELECT source, source_id, min(url_alt) AS own FROM url_alt GROUP BY ALL) SELECT l.rec, u.own FROM l LEFT JOIN u USING (source, source_id)")
def joi_15(spark, d):
    u = load(spark, d, "url_alt").groupBy("source", "source_id").agg(F.min("url_alt").alias("own"))
    return listings(spark, d).join(u, ["source", "source_id"], "left").select("rec", "own")


@plan.query(
    "joi_16",
    f"""WITH {LISTINGS}, o AS (SELECT rec, {AREA('comune')} AS area, typology AS typ, mq, row_number() OVER (PARTITION BY {AREA('comune')}, typology ORDER BY mq, rec) AS pos FROM l WHERE mq > 0 AND typology IS NOT NULL)
    SELECT a.rec, b.rec AS near, abs(a.mq - b.mq) AS diff FROM o a JOIN o b ON a.area = b.area AND a.typ = b.typ AND a.rec <> b.rec AND abs(a.mq - b.mq)::DOUBLE / a.mq <= 0.25
    QUALIFY row_number() OVER (PARTITION BY a.rec ORDER BY abs(a.mq - b.mq), abs(a.pos - b.pos), b.pos) <= 5""",
)
def joi_16(spark, d):
    """Five nearest comparables by size in the same area and type.

    In size order the five nearest stand among the five before and the five after, so
    one sort replaces the self-join. A quarter's difference stays within one band of
    the logarithm, so each band is sorted with its two neighbours as context and an
    area with most of the listings is no single task.
    """
    o = listings(spark, d, "comune", "typology", "mq").where("mq > 0 AND typology IS NOT NULL").select("rec", area_key(F.col("comune")).alias("area"), F.col("typology").alias("typ"), "mq")
    o = o.withColumn("own", F.floor(F.log("mq") / F.lit(0.29))).withColumn("band", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    w = W.partitionBy("area", "typ", "band").orderBy("mq", "rec")
    near = F.array(*[F.struct(f("rec", k).over(w).alias("near"), f("mq", k).over(w).alias("m2"), F.lit(k).alias("step"), F.lit(s * k).alias("side")) for k in range(1, 6) for f, s in ((F.lag, -1), (F.lead, 1))])
    c = o.withColumn("near", near).where("band = own").select("rec", "mq", F.explode("near").alias("n")).select("rec", "mq", "n.*").where("near IS NOT NULL").withColumn("diff", F.abs(F.col("mq") - F.col("m2"))).where(F.col("diff").cast("double") / F.col("mq") <= 0.25)
    rank = F.row_number().over(W.partitionBy("rec").orderBy("diff", "step", "side"))
    return c.withColumn("rank", rank).where("rank <= 5").select("rec", "near", "diff")


_TAIL = lambda c: f"regexp_extract(regexp_replace({URL(c)}, '[.](html?|php|aspx)$', ''), '(?:^|[-_/])([0-9]{{3,9}})$', 1)"


@plan.query(
    "joi_17",
    f"WITH p AS (SELECT DISTINCT url, {URL('url')} AS a, {_TAIL('url')} AS t FROM agency_site_listings), u AS (SELECT DISTINCT source_id, {URL('url_alt')} AS b, {_TAIL('url_alt')} AS r FROM url_alt) SELECT DISTINCT u.source_id, p.url FROM u JOIN p ON contains(p.a, u.b) OR contains(u.b, p.a) OR (p.t <> '' AND p.t = u.r)",
)
def joi_17(spark, d):
    """Lookup: one plain address contains the other, or both end in the same reference.

    Plain addresses begin with their host, so one contains the other where it opens with it: the longer one's openings,
    as long as addresses that the other table has on its host, meet the shorter one. They are many times the rows that
    they come from, of which the optimizer knows nothing: these joins are never broadcast.
    """
    tail = lambda c: F.regexp_extract(F.regexp_replace(plain_url(c), "[.](html?|php|aspx)$", ""), "(?:^|[-_/])([0-9]{3,9})$", 1)
    host = lambda c: F.split_part(c, F.lit("/"), F.lit(1))
    p = load(spark, d, "agency_site_listings").where("url IS NOT NULL").select("url").distinct().select("url", plain_url(F.col("url")).alias("a"), tail(F.col("url")).alias("t"))
    u = load(spark, d, "url_alt").where("url_alt IS NOT NULL").select("source_id", "url_alt").distinct().select("source_id", plain_url(F.col("url_alt")).alias("b"), tail(F.col("url_alt")).alias("r")).distinct()
    p, u = cut_lineage(p), cut_lineage(u)

    def opens(shorter, short, longer, long):
        lengths = cut_lineage(shorter.groupBy(host(F.col(short)).alias("host")).agg(F.collect_set(F.length(short)).alias("lengths")))
        placed = longer.where(F.col(long) != "").withColumn("host", host(F.col(long))).join(broadcast_if_small(lengths, 1_000), "host")
        openings = placed.withColumn("n", F.explode(F.filter("lengths", lambda n: n <= F.length(long)))).drop("host", "lengths", "t", "r").withColumn("key", F.xxhash64(F.left(long, F.col("n")))).drop("n")
        return openings.hint("merge").join(shorter.withColumn("key", F.xxhash64(short)), "key").where(F.startswith(F.col(long), F.col(short))).select("source_id", "url")

    by_ref = u.join(p, (F.col("t") == F.col("r")) & (F.col("t") != "")).select("source_id", "url")
    return by_ref.unionByName(opens(u, "b", p, "a")).unionByName(opens(p, "a", u, "b")).distinct()


@plan.query("joi_18", f"WITH {LISTINGS} SELECT a.rec, b.rec AS hit FROM l a JOIN l b ON regexp_extract(a.url, '([0-9]{{6,}})', 1) = b.source_id")
def joi_18(spark, d):
    """Lookup by the first run of six or more digits."""
    rows = listings(spark, d, "url")
    a = rows.select("rec", F.regexp_extract("url", "([0-9]{6,})", 1).alias("id"))
    return a.join(rows.select(F.col("source_id").alias("id"), F.col("rec").alias("hit")), "id").select("rec", "hit")


@plan.query("joi_19", f"WITH {LISTINGS} SELECT lower(address_raw) AS address, count(*) AS n, count(DISTINCT source) AS sources FROM l WHERE address_raw <> '' GROUP BY 1 HAVING count(DISTINCT source) > 1")
def joi_19(spark, d):
    rows = listings(spark, d, "address_raw").where("address_raw <> ''")
    return rows.groupBy(F.lower("address_raw").alias("address")).agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources")).where("sources > 1")


@plan.query("joi_20", f"WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, unnest(members) AS rec FROM k) SELECT cluster, rec, price, row_number() OVER (PARTITION BY cluster ORDER BY coalesce(price, 0) DESC, rec) AS place FROM m JOIN l USING (rec)")
def joi_20(spark, d):
    """Members of each cluster with their details, dearest first."""
    m = clusters(spark, d).join(listings(spark, d, "price"), "rec")
    return m.select("cluster", "rec", "price", F.row_number().over(W.partitionBy("cluster").orderBy(F.coalesce("price", F.lit(0)).desc(), "rec")).alias("place"))


_EDGES = "ph AS (SELECT DISTINCT lower(trim(dhash)) AS k, source || '/' || source_id AS rec FROM photo_hashes WHERE trim(dhash) <> ''), ok AS (SELECT k FROM ph GROUP BY k HAVING count(*) BETWEEN 2 AND 3), e AS (SELECT a.rec AS u, b.rec AS v FROM ph a JOIN ok USING (k) JOIN ph b USING (k) WHERE a.rec <> b.rec)"


def picture_edges(spark, d):
    q = pictures(spark, d)
    least = q.groupBy("h").agg(F.count("*").alias("n"), F.min("rec").alias("u")).where("n > 1")
    return q.join(least, "h").select("u", F.col("rec").alias("v"))


@plan.query("grf_01", f"WITH RECURSIVE {_EDGES}, r AS (SELECT DISTINCT u AS rec, u AS lab FROM e UNION SELECT e.v, r.lab FROM r JOIN e ON e.u = r.rec WHERE r.lab < e.v) SELECT rec AS member, min(lab) AS component FROM r GROUP BY rec")
def grf_01(spark, d):
    """Components over shared pictures."""
    return components(picture_edges(spark, d))


@plan.query(
    "grf_02",
    f"""WITH RECURSIVE {_EDGES}, g AS (SELECT u, v FROM e UNION SELECT a.source || '/' || a.source_id, b.source || '/' || b.source_id FROM url_alt a JOIN url_alt b USING (url_alt)),
    r AS (SELECT DISTINCT u AS rec, u AS lab FROM g WHERE u <> v UNION SELECT g.v, r.lab FROM r JOIN g ON g.u = r.rec WHERE r.lab < g.v), c AS (SELECT rec, min(lab) AS component FROM r GROUP BY rec)
    SELECT component, count(*) AS n FROM c GROUP BY component""",
)
def grf_02(spark, d):
    """Components over all evidence, pictures and pages, with their sizes."""
    pages = load(spark, d, "url_alt").select("url_alt", rec_name().alias("v"))
    least = pages.groupBy("url_alt").agg(F.min("v").alias("u"))
    both = picture_edges(spark, d).unionByName(pages.join(least, "url_alt").select("u", "v"))
    return components(both).groupBy("component").agg(F.count("*").alias("n"))


@plan.query(
    "grf_03",
    f"""WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, rec, mq, coalesce(agency_name, source) AS seller FROM (SELECT cluster, unnest(members) AS rec FROM k) JOIN l USING (rec)),
    a AS (SELECT cluster, count(*) AS n, count(DISTINCT seller) AS sellers, list_sort(list(mq) FILTER (mq > 0)) AS s FROM m GROUP BY cluster)
    SELECT cluster, n, sellers, n <= sellers + 1 AND (coalesce(len(s), 0) <= 2 OR (s[len(s)]::DOUBLE / s[len(s) // 2 + 1] <= 1.35 AND s[len(s) // 2 + 1]::DOUBLE / s[1] <= 1.35)) AS coherent FROM a""",
)
def grf_03(spark, d):
    """Coherence of a cluster: sizes near the upper median, hardly more members than sellers."""
    m = clusters(spark, d).join(listings(spark, d, "mq", "agency_name"), "rec")
    size = F.when(F.col("mq") > 0, F.col("mq").cast("double"))
    # The upper median is the discrete median from above.
    a = m.withColumn("s", size).groupBy("cluster").agg(
        F.count("*").alias("n"), F.countDistinct(F.coalesce("agency_name", "source")).alias("sellers"), F.count("s").alias("sized"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY s DESC)").alias("med")
    )
    near = (F.col("hi") / F.col("med") <= 1.35) & (F.col("med") / F.col("lo") <= 1.35)
    return a.select("cluster", "n", "sellers", ((F.col("n") <= F.col("sellers") + 1) & F.when(F.col("sized") <= 2, True).otherwise(near)).alias("coherent"))


@plan.query(
    "grf_04",
    """WITH p AS (SELECT DISTINCT source || '/' || source_id AS rec, photo_id, ('0x' || lower(trim(dhash)))::UBIGINT AS h FROM photo_hashes WHERE trim(dhash) <> ''),
    g AS (SELECT rec, list([h] ORDER BY photo_id, CASE WHEN h >= 9223372036854775808 THEN 0 ELSE 1 END, h) AS hs FROM p GROUP BY rec)
    SELECT rec, len(hs)::INTEGER AS pictures, len(list_reduce(hs, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: bit_count(xor(k, x[1])) <= 2)) > 0 THEN acc ELSE list_concat(acc, x) END))::INTEGER AS kept FROM g""",
)
def grf_04(spark, d):
    """Pictures kept per listing: a picture within two bits of one kept before is dropped, in picture order."""
    ph = load(spark, d, "photo_hashes").where("trim(dhash) <> ''").select(rec_name().alias("rec"), "photo_id", hash_bits(F.trim("dhash")).alias("h")).distinct()
    per = ph.groupBy("rec").agg(F.transform(F.array_sort(F.collect_list(F.struct("photo_id", "h"))), lambda x: x["h"]).alias("hs"))
    kept = F.aggregate("hs", F.array().cast("array<bigint>"), lambda acc, h: F.when(F.exists(acc, lambda k: F.bit_count(k.bitwiseXOR(h)) <= 2), acc).otherwise(F.concat(acc, F.array(h))))
    return per.select("rec", F.size("hs").alias("pictures"), F.size(kept).alias("kept"))


@plan.query("grf_05", "SELECT lower(trim(dhash)) AS dhash, count(DISTINCT source || '/' || source_id) AS listings FROM photo_hashes GROUP BY 1 HAVING count(DISTINCT source || '/' || source_id) > 3")
def grf_05(spark, d):
    """Pictures that more than three listings show."""
    distinct = load(spark, d, "photo_hashes").select(F.lower(F.trim("dhash")).alias("dhash"), rec_name().alias("rec")).distinct()
    return distinct.groupBy("dhash").agg(F.count("rec").alias("listings")).where("listings > 3")


@plan.query("grf_07", f"WITH {_OFFERS} SELECT price, street, count(*) AS n, min(rec) AS first_rec FROM o WHERE price > 0 AND mq > 0 AND street IS NOT NULL GROUP BY price, street HAVING count(*) > 1")
def grf_07(spark, d):
    """Duplicate candidates: equal price and street."""
    o = offers(spark, d).where("price > 0 AND mq > 0 AND street IS NOT NULL")
    return o.groupBy("price", "street").agg(F.count("*").alias("n"), F.min("rec").alias("first_rec")).where("n > 1")


@plan.query("grf_08", f"WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, unnest(members) AS rec FROM k), f AS (SELECT cluster, rec, (price IS NOT NULL)::INT + (mq IS NOT NULL)::INT + (vani IS NOT NULL)::INT + (address_raw IS NOT NULL)::INT + (floor IS NOT NULL)::INT AS filled FROM m JOIN l USING (rec)) SELECT cluster, rec AS canonical, filled FROM f QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY filled DESC, rec) = 1")
def grf_08(spark, d):
    """The most complete record of each cluster, ties by name."""
    m = clusters(spark, d).join(listings(spark, d, "price", "mq", "vani", "address_raw", "floor"), "rec")
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("price", "mq", "vani", "address_raw", "floor")), F.lit(0))
    best = m.groupBy("cluster").agg(F.min(F.struct((-filled).alias("k"), "rec")).alias("b"))
    return best.select("cluster", F.col("b.rec").alias("canonical"), (-F.col("b.k")).alias("filled"))


@plan.query("grf_09", f"WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, coalesce(lower(agency_name), '__' || source) AS seller, price, mq, typology FROM (SELECT cluster, unnest(members) AS rec FROM k) JOIN l USING (rec)) SELECT cluster, seller, count(*) AS n, count(DISTINCT price) > 1 AS price_conflict, count(DISTINCT mq) > 1 AS size_conflict, count(DISTINCT typology) > 1 AS type_conflict FROM m GROUP BY ALL")
def grf_09(spark, d):
    """Sellers of a cluster and where they contradict themselves."""
    m = clusters(spark, d).join(listings(spark, d, "agency_name", "price", "mq", "typology"), "rec")
    seller = F.coalesce(F.lower("agency_name"), F.concat(F.lit("__"), "source"))
    distinct = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    return m.groupBy("cluster", seller.alias("seller")).agg(F.count("*").alias("n"), distinct("price").alias("price_conflict"), distinct("mq").alias("size_conflict"), distinct("typology").alias("type_conflict"))


@plan.query("grf_10", f"WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, rec, coalesce(lower(agency_name), '__' || source) AS seller, price FROM (SELECT cluster, unnest(members) AS rec FROM k) JOIN l USING (rec)), c AS (SELECT cluster, seller, count(DISTINCT price) > 1 AS split FROM m GROUP BY ALL) SELECT DISTINCT m.cluster, CASE WHEN split THEN m.seller || ':' || m.rec ELSE m.seller END AS claim, CASE WHEN split THEN m.price ELSE max(m.price) OVER (PARTITION BY m.cluster, m.seller) END AS price FROM m JOIN c USING (cluster, seller)")
def grf_10(spark, d):
    """One claim per seller; a seller that contradicts itself is split by listing."""
    m = clusters(spark, d).join(listings(spark, d, "agency_name", "price"), "rec").withColumn("seller", F.coalesce(F.lower("agency_name"), F.concat(F.lit("__"), "source")))
    w = W.partitionBy("cluster", "seller")
    split = F.coalesce(F.min("price").over(w) != F.max("price").over(w), F.lit(False))
    return m.select("cluster", F.when(split, F.concat("seller", F.lit(":"), "rec")).otherwise(F.col("seller")).alias("claim"), F.when(split, F.col("price")).otherwise(F.max("price").over(w)).alias("price")).distinct()


@plan.query("grf_11", f"WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, coalesce(agency_name, source) AS seller FROM (SELECT cluster, unnest(members) AS rec FROM k) JOIN l USING (rec)) SELECT cluster, count(*) <> count(DISTINCT seller) AS same_seller_twice FROM m GROUP BY cluster")
def grf_11(spark, d):
    m = clusters(spark, d).join(listings(spark, d, "agency_name"), "rec")
    return m.groupBy("cluster").agg((F.count("*") != F.countDistinct(F.coalesce("agency_name", "source"))).alias("same_seller_twice"))


@plan.query("agg_13", f"WITH {_OFFERS}, u AS (SELECT price::DOUBLE / mq AS x, row_number() OVER (PARTITION BY price, street ORDER BY rec) AS k, street FROM o WHERE price > 0 AND mq > 0) SELECT {half_up_sql('median(x)')} AS before, {half_up_sql('median(x) FILTER (k = 1 OR street IS NULL)')} AS after FROM u")
def agg_13(spark, d):
    """Median unit price before and after keeping one of each duplicate group."""
    o = offers(spark, d).where("price > 0 AND mq > 0").select((F.col("price").cast("double") / F.col("mq")).alias("x"), "street", F.row_number().over(W.partitionBy("price", "street").orderBy("rec")).alias("k"))
    kept = F.when((F.col("k") == 1) | F.col("street").isNull(), F.col("x"))
    sides = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("x").alias("v")), F.struct(F.lit("after").alias("side"), kept.alias("v"))))
    g = quantiles(o.select(sides.alias("s")).select("s.*"), ["side"], "v", {"m": 0.5})
    return g.agg(*[half_up(F.max(F.when(F.col("side") == side, F.col("m")))).alias(side) for side in ("before", "after")])
