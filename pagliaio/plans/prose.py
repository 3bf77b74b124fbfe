"""Text mining of descriptions, and what else is scored inside bounded blocks."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagliaio.functions.prose import size_conflict, stated_sizes, stated_types, type_conflict, unescaped
from pagliaio.functions.text import area_key, hash_bits, street_joined, type_class
from pagliaio.operators.clustering import first_fit, one_to_one
from pagliaio.plans.joins import ANCHORS, _CLUSTERS, clusters, joi_12, joi_07
from pagliaio.plans.joins import SQL as JOIN_SQL
from pagliaio.plans.offers import AREA, FOLD
from pagliaio.plans.registry import LISTINGS, Plan, half_up, half_up_sql, listings
from pagliaio.session import cut_lineage
from pagliaio.tables import load, rec_name

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql


@plan.query("txt_01")
def txt_01(spark, d):
    """All sizes that a description states for the dwelling."""
    return listings(spark, d, "description").where("length(description) >= 25").select("rec", stated_sizes("description").alias("sizes"))


@plan.query("txt_01_plain", rf"WITH {LISTINGS} SELECT rec, len(regexp_extract_all(description, '[0-9]+ (mq|m²)')) AS mentions FROM l WHERE length(description) >= 25")
def txt_01_plain(spark, d):
    """How often a size with its unit is written."""
    return listings(spark, d, "description").where("length(description) >= 25").select("rec", F.size(F.regexp_extract_all("description", F.lit("[0-9]+ (mq|m²)"), F.lit(0))).alias("mentions"))


@plan.query("txt_02")
def txt_02(spark, d):
    """Types that a description names."""
    return listings(spark, d, "description").where("length(description) >= 25").select("rec", stated_types("description").alias("types"))


@plan.query(
    "txt_03",
    f"""WITH {LISTINGS}, s AS (SELECT rec, mq, list_transform(regexp_extract_all(description, '(?:circa|di) ([0-9]+) (?:mq|m²)', 1), lambda x: CAST(x AS INTEGER)) AS said FROM l WHERE mq > 0 AND description IS NOT NULL)
    SELECT rec, mq, list_max(list_transform(said, lambda v: abs(v - mq))) AS farthest FROM s
    WHERE len(said) > 0 AND NOT list_bool_or(list_transform(said, lambda v: abs(v - mq) <= 0.1 * mq))
      AND NOT coalesce(list_bool_or(flatten(list_transform(said, lambda a, i: list_transform(said[i + 1:], lambda b: abs(a + b - mq) <= 0.1 * mq)))), FALSE)
      AND NOT (len(said) > 2 AND abs(list_sum(said) - mq) <= 0.1 * mq)""",
)
def txt_03(spark, d):
    """Sizes in prose that contradict the field, whichever way they are added up."""
    said = F.transform(F.regexp_extract_all("description", F.lit("(?:circa|di) ([0-9]+) (?:mq|m²)"), F.lit(1)), lambda x: x.cast("int"))
    s = listings(spark, d, "description", "mq").where("mq > 0 AND description IS NOT NULL").select("rec", "mq", said.alias("said"))
    worst = size_conflict(F.col("mq"), F.col("said"))
    return s.withColumn("w", worst).where("w IS NOT NULL").select("rec", "mq", F.abs(F.col("w") - F.col("mq")).alias("farthest"))


@plan.query("txt_05")
def txt_05(spark, d):
    """Listings whose text contradicts their own size or type."""
    s = listings(spark, d, "description", "mq", "typology").where("length(description) >= 25")
    s = s.select("rec", "mq", type_class(F.col("typology")).alias("type"), stated_sizes("description").alias("sizes"), stated_types("description").alias("types"))
    out = s.select("rec", "mq", "type", size_conflict(F.col("mq"), F.col("sizes")).alias("said_size"), type_conflict(F.col("type"), F.col("types")).alias("said_type"))
    return out.where("said_size IS NOT NULL OR said_type IS NOT NULL")


# Words that tell no streets apart in the loosest key.
_NOISE = ("via", "viale", "piazza", "strada", "vicolo", "largo", "corso", "localita", "loc", "frazione", "fraz", "nn", "comunale", "provinciale", "statale")


@plan.query("str_04", f"SELECT DISTINCT address_raw, coalesce(list_aggregate(list_filter(regexp_split_to_array(regexp_replace(lower({FOLD('address_raw')}), '[^a-z0-9]+', ' ', 'g'), ' +'), lambda w: w <> '' AND w NOT IN ({', '.join(f'{chr(39)}{w}{chr(39)}' for w in _NOISE)}) AND NOT regexp_matches(w, '^[0-9]+$')), 'string_agg', ' '), '') AS street FROM listings WHERE address_raw IS NOT NULL")
def str_04(spark, d):
    """Street key that keeps spaces and drops noise words and numbers."""
    from pagliaio.functions.text import fold_accents

    words = F.filter(F.split(F.regexp_replace(F.lower(fold_accents(F.col("address_raw"))), "[^a-z0-9]+", " "), " +"), lambda w: (w != "") & ~w.isin(*_NOISE) & ~w.rlike("^[0-9]+$"))
    return load(spark, d, "listings").where(F.col("address_raw").isNotNull()).select("address_raw", F.array_join(words, " ").alias("street")).distinct()


@plan.query("str_22")
def str_22(spark, d):
    """Texts with their HTML entities resolved."""
    return load(spark, d, "documents").select("doc_id", unescaped("text").alias("text"))


@plan.query("num_07", f"WITH {LISTINGS}, b AS (SELECT {AREA('comune')} AS area, min(min_eur_m2) AS lo, max(max_eur_m2) AS hi FROM omi_bands WHERE max_eur_m2 BETWEEN 100 AND 5000 GROUP BY 1) SELECT rec, {half_up_sql('(price::DOUBLE / mq - hi) / hi * 100')} AS over_ceiling, {half_up_sql('(price::DOUBLE / mq - (lo + hi) / 2) / ((lo + hi) / 2) * 100')} AS over_middle FROM l JOIN b ON b.area = {AREA('l.comune')} WHERE price > 0 AND mq > 0")
def num_07(spark, d):
    """Unit price against the ceiling and the middle of the area's range."""
    b = load(spark, d, "omi_bands").where("max_eur_m2 BETWEEN 100 AND 5000").groupBy(area_key(F.col("comune")).alias("area")).agg(F.min("min_eur_m2").alias("lo"), F.max("max_eur_m2").alias("hi"))
    rows = listings(spark, d, "comune", "price", "mq").where("price > 0 AND mq > 0").withColumn("area", area_key(F.col("comune"))).join(b, "area")
    unit, middle = F.col("price").cast("double") / F.col("mq"), (F.col("lo") + F.col("hi")) / 2
    return rows.select("rec", half_up((unit - F.col("hi")) / F.col("hi") * 100).alias("over_ceiling"), half_up((unit - middle) / middle * 100).alias("over_middle"))


@plan.query("dat_01", f"SELECT rec, {ANCHORS[-1][1] + 100} - day AS age, confidence FROM ({JOIN_SQL['joi_12']})")
def dat_01(spark, d):
    """Age from the interpolated day, as of a given day."""
    return joi_12(spark, d).select("rec", (F.lit(ANCHORS[-1][1] + 100) - F.col("day")).alias("age"), "confidence")


@plan.query("dat_03", f"WITH {LISTINGS}, c AS (SELECT rec, dom_est, regexp_extract(dom_method, '([^:]*)$', 1) AS conf FROM l) SELECT rec, CASE WHEN dom_est IS NULL THEN NULL WHEN conf = 'bound_old' THEN CASE WHEN dom_est >= 1460 THEN 4 END WHEN conf = 'bound_new' THEN CASE WHEN dom_est < 180 THEN 0 END WHEN dom_est < 180 THEN 0 WHEN dom_est < 365 THEN 1 WHEN dom_est < 730 THEN 2 WHEN dom_est < 1460 THEN 3 ELSE 4 END AS bucket FROM c")
def dat_03(spark, d):
    """Half-open age buckets; a bound counts only where it lies in one bucket whole."""
    x, conf = F.col("dom_est"), F.regexp_extract("dom_method", "([^:]*)$", 1)
    plain = F.when(x < 180, 0).when(x < 365, 1).when(x < 730, 2).when(x < 1460, 3).otherwise(4)
    bucket = F.when(x.isNull(), None).when(conf == "bound_old", F.when(x >= 1460, 4)).when(conf == "bound_new", F.when(x < 180, 0)).otherwise(plain)
    return listings(spark, d, "dom_est", "dom_method").select("rec", bucket.alias("bucket"))


@plan.query("dat_04", "SELECT DISTINCT dom_method, CASE regexp_extract(dom_method, '([^:]*)$', 1) WHEN 'bound_old' THEN 'floor' WHEN 'bound_new' THEN 'ceiling' END AS bound FROM listings")
def dat_04(spark, d):
    conf = F.regexp_extract("dom_method", "([^:]*)$", 1)
    return load(spark, d, "listings").select("dom_method", F.when(conf == "bound_old", "floor").when(conf == "bound_new", "ceiling").alias("bound")).distinct()


@plan.query("win_10", f"WITH {LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, unnest(members) AS rec FROM k) SELECT cluster, rec, row_number() OVER (PARTITION BY cluster ORDER BY coalesce(price, 0) DESC, coalesce(agency_name, source), rec) AS place FROM m JOIN l USING (rec)")
def win_10(spark, d):
    """Member order: dearest first, then seller, then name."""
    m = clusters(spark, d).join(listings(spark, d, "price", "agency_name"), "rec")
    w = W.partitionBy("cluster").orderBy(F.coalesce("price", F.lit(0)).desc(), F.coalesce("agency_name", "source"), "rec")
    return m.select("cluster", "rec", F.row_number().over(w).alias("place"))


@plan.query("joi_08")
def joi_08(spark, d):
    """Deep pass: pictures of candidate pairs matched one to one in list order."""
    ph = load(spark, d, "photo_hashes").where("trim(dhash) <> ''").select(rec_name().alias("rec"), "photo_id", hash_bits(F.trim("dhash")).alias("h")).distinct()
    per = ph.groupBy("rec").agg(F.transform(F.array_sort(F.collect_list(F.struct("photo_id", "h"))), lambda x: x["h"]).alias("hs"))  # a listing's own pictures
    pairs = joi_07(spark, d).select(F.col("rec_a").alias("a"), F.col("rec_b").alias("b"))
    both = pairs.join(per.select(F.col("rec").alias("a"), F.col("hs").alias("hashes_a")), "a").join(per.select(F.col("rec").alias("b"), F.col("hs").alias("hashes_b")), "b")
    return one_to_one(both, 5)


@plan.query("grf_06")
def grf_06(spark, d):
    """First-fit clustering against each group's first row, inside one street."""
    rows = listings(spark, d, "comune", "address_raw", "price", "mq", "vani").select(F.col("rec").alias("id"), area_key(F.col("comune")).alias("area"), street_joined(F.col("address_raw")).alias("street"), F.col("price").cast("double").alias("price"), F.col("mq").cast("double").alias("mq"), "vani")
    return first_fit(rows.where("street IS NOT NULL"), ["area", "street"], ["id"], {"price": 0.05, "mq": 0.03, "vani": 0.0}, 2)


@plan.query("ext_05", f"WITH {LISTINGS} SELECT coalesce(typology, '-') AS typology, count(*) FILTER (dom_est < 365) AS young, count(*) FILTER (dom_est >= 365) AS old FROM l GROUP BY 1")
def ext_05(spark, d):
    """Extension: mix of types by age."""
    return listings(spark, d, "typology", "dom_est").groupBy(F.coalesce("typology", F.lit("-")).alias("typology")).agg(F.count_if(F.col("dom_est") < 365).alias("young"), F.count_if(F.col("dom_est") >= 365).alias("old"))


@plan.query("ext_07", "WITH p AS (SELECT DISTINCT lower(trim(dhash)) AS h, source || '/' || source_id AS rec FROM photo_hashes), n AS (SELECT count(DISTINCT rec) AS n FROM p) SELECT h AS dhash, count(*) AS listings FROM p, n GROUP BY h, n.n HAVING count(*)::DOUBLE / n.n > 0.001")
def ext_07(spark, d):
    """Extension: pictures shown by more than a thousandth of all listings, whatever their number."""
    p = load(spark, d, "photo_hashes").select(F.lower(F.trim("dhash")).alias("h"), rec_name().alias("rec")).distinct()
    n = p.agg(F.countDistinct("rec").alias("n"))
    return p.groupBy(F.col("h").alias("dhash")).agg(F.count("*").alias("listings")).join(F.broadcast(n), F.col("listings").cast("double") / F.col("n") > 0.001).select("dhash", "listings")  # one row


#: Draws of the bootstrap.
DRAWS = 2_000


@plan.query("ext_01")
def ext_01(spark, d):
    """Extension: bootstrap of the median unit price, 2,000 seeded draws, percentile interval.

    Poisson weights by hash make every draw a pass of independent rows: no resampling
    step, no collected sample, the same result on every run. A draw's median is sought
    among the rows within eight standard errors of the plain one; the others are counted.
    """
    u = listings(spark, d, "price", "mq").where("price > 0 AND mq > 0").select("rec", (F.col("price").cast("double") / F.col("mq")).alias("x"))
    u = cut_lineage(u.repartition(4 * spark.sparkContext.defaultParallelism, "rec"))
    n = u.count()
    near = min(0.5, 4 / max(n, 1) ** 0.5)
    low, high = u.agg(F.expr(f"percentile(x, {0.5 - near})"), F.expr(f"percentile(x, {0.5 + near})")).first()
    draws = u.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(DRAWS))))
    z = F.pmod(F.xxhash64("rec", "draw"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    weight = F.when(z < 0.36787944, 0).when(z < 0.73575888, 1).when(z < 0.9196986, 2).when(z < 0.98101184, 3).when(z < 0.99634015, 4).otherwise(5)
    draws = draws.withColumn("w", weight).where("w > 0")
    # Places of the two middle rows of a draw, counted from 0.
    totals = draws.groupBy("draw").agg(F.sum("w").alias("n"), F.coalesce(F.sum(F.when(F.col("x") < F.lit(low), F.col("w"))), F.lit(0)).alias("below"))
    totals = totals.select("draw", "below", F.expr("(n - 1) div 2").alias("a"), F.expr("n div 2").alias("b"))
    middle = draws.where(F.col("x").between(F.lit(low), F.lit(high))).groupBy("draw", "x").agg(F.sum("w").alias("w"))
    ends = F.col("below") + F.sum("w").over(W.partitionBy("draw").orderBy("x"))
    placed = middle.join(totals, "draw").withColumn("end", ends)
    at = lambda k: F.max(F.when((F.col(k) >= F.col("end") - F.col("w")) & (F.col(k) < F.col("end")), F.col("x")))
    found = placed.groupBy("draw").agg(at("a").alias("a"), at("b").alias("b"))
    outside = F.raise_error(F.lit("a draw's median lies beyond eight standard errors")).cast("double")
    medians = found.select("draw", F.coalesce((F.col("a") + F.col("b")) / 2, outside).alias("m"))
    return medians.agg(F.count("*").alias("draws"), half_up(F.percentile("m", 0.025)).alias("low"), half_up(F.percentile("m", 0.5)).alias("middle"), half_up(F.percentile("m", 0.975)).alias("high"))
