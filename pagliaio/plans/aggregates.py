"""Aggregations over listings, bands, clusters and pictures."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagliaio.functions.text import area_key, fold_accents, public_street
from pagliaio.operators.quantiles import quantiles
from pagliaio.plans.joins import _CLUSTERS, _cascade, _cascade_sql, clusters
from pagliaio.plans.offers import _STREET6, AREA, AUCTION, FOLD
from pagliaio.plans.registry import LISTINGS, Plan, half_up, half_up_sql, listings
from pagliaio.tables import load, rec_name

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql

_UNIT = f"{LISTINGS}, u AS (SELECT rec, {AREA('comune')} AS area, typology AS typ, source, price::DOUBLE / mq AS x, price::DOUBLE / nullif(mq_commercial, 0) AS y, price::DOUBLE AS price, mq::DOUBLE AS mq, mq_commercial::DOUBLE AS mqc, dom_est FROM l WHERE price > 0 AND mq > 0)"


def units(spark, d):
    rows = listings(spark, d, "comune", "typology", "price", "mq", "mq_commercial", "dom_est").where("price > 0 AND mq > 0")
    p = F.col("price").cast("double")
    return rows.select("rec", area_key(F.col("comune")).alias("area"), F.col("typology").alias("typ"), "source", (p / F.col("mq")).alias("x"), (p / F.nullif("mq_commercial", F.lit(0))).alias("y"), p.alias("price"), F.col("mq").cast("double").alias("mq"), F.col("mq_commercial").cast("double").alias("mqc"), "dom_est")


_Q = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90"))


@plan.query("agg_01", f"WITH {_UNIT} SELECT area, typ, grouping(area)::INT AS all_areas, grouping(typ)::INT AS all_types, count(*) AS n, " + ", ".join(f"{half_up_sql(f'quantile_cont(x, {q})')} AS {a}" for q, a in _Q) + " FROM u GROUP BY GROUPING SETS ((), (area), (typ), (area, typ))")
def agg_01(spark, d):
    """Quartiles and ninth decile of the unit price, over all, by area, by type and by both: every row counts in four groups."""
    sets = F.explode(F.array(*[F.struct((F.col("area") if by_area else F.lit(None).cast("string")).alias("area"), (F.col("typ") if by_type else F.lit(None).cast("string")).alias("typ"), F.lit(1 - by_area).alias("all_areas"), F.lit(1 - by_type).alias("all_types")) for by_area in (0, 1) for by_type in (0, 1)]))
    g = quantiles(units(spark, d).select("x", sets.alias("s")).select("x", "s.*"), ["area", "typ", "all_areas", "all_types"], "x", {a: q for q, a in _Q})
    return g.select("area", "typ", "all_areas", "all_types", "n", *[half_up(F.col(a)).alias(a) for _, a in _Q])


@plan.query("agg_02", f"WITH {_UNIT} SELECT area, count(*) AS n, count(y) AS n_weighted, {half_up_sql('median(x)')} AS net, {half_up_sql('median(y)')} AS weighted FROM u GROUP BY area")
def agg_02(spark, d):
    """Both size bases side by side."""
    sides = F.explode(F.array(F.struct(F.lit("net").alias("side"), F.col("x").alias("v")), F.struct(F.lit("weighted").alias("side"), F.col("y").alias("v"))))
    g = quantiles(units(spark, d).select("area", sides.alias("s")).select("area", "s.*"), ["area", "side"], "v", {"m": 0.5})
    one = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return g.groupBy("area").agg(one("net", "n").alias("n"), one("weighted", "n").alias("n_weighted"), half_up(one("net", "m")).alias("net"), half_up(one("weighted", "m")).alias("weighted"))


@plan.query("agg_03", f"WITH {_UNIT} SELECT area, {half_up_sql('avg((x > 1000)::INT) * 100')} AS share FROM u GROUP BY area")
def agg_03(spark, d):
    """Share above a threshold."""
    return units(spark, d).groupBy("area").agg(half_up(F.avg((F.col("x") > 1000).cast("int")) * 100).alias("share"))


_IV = f"{_UNIT}, v AS (SELECT area, source, {half_up_sql('price / nullif(mqc, 0)')} AS lo, x AS hi FROM u WHERE mqc >= mq)"


@plan.query("agg_04", f"WITH {_IV}, g AS (SELECT area, count(*) AS n, count(DISTINCT source) AS sellers, quantile_cont(lo, 0.25) AS l25, quantile_cont(lo, 0.5) AS l50, quantile_cont(lo, 0.75) AS l75, quantile_cont(hi, 0.5) AS h50 FROM v GROUP BY area) SELECT area, n, sellers, {half_up_sql('l50')} AS p50_lo, {half_up_sql('h50')} AS p50_hi, {half_up_sql('(h50 - l50) / ((h50 + l50) / 2) * 100')} AS width, {half_up_sql('(l75 - l25) / l50 * 100')} AS spread FROM g")
def agg_04(spark, d):
    """Interval band of an area: quantiles of lower and upper bounds on their own."""
    v = units(spark, d).where("mqc >= mq").select("area", "source", half_up(F.col("price") / F.nullif("mqc", F.lit(0.0))).alias("lo"), F.col("x").alias("hi"))
    g = v.groupBy("area").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sellers"), F.percentile("lo", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("l"), F.median("hi").alias("h50"))
    l25, l50, l75, h50 = F.col("l")[0], F.col("l")[1], F.col("l")[2], F.col("h50")
    return g.select("area", "n", "sellers", half_up(l50).alias("p50_lo"), half_up(h50).alias("p50_hi"), half_up((h50 - l50) / ((h50 + l50) / 2) * 100).alias("width"), half_up((l75 - l25) / l50 * 100).alias("spread"))


_BUCKET = "CASE WHEN dom_est < 180 THEN 0 WHEN dom_est < 365 THEN 1 WHEN dom_est < 730 THEN 2 WHEN dom_est < 1460 THEN 3 ELSE 4 END"


@plan.query("agg_06", f"WITH {_UNIT}, b AS (SELECT area, {_BUCKET} AS ord, median(x) AS m FROM u WHERE dom_est IS NOT NULL GROUP BY ALL) SELECT area, count(*) AS buckets, CASE WHEN count(*) >= 2 THEN {half_up_sql('max_by(m, ord) - min_by(m, ord)')} END AS gradient FROM b GROUP BY area")
def agg_06(spark, d):
    """Gradient over age: last bucket's median less the first's."""
    o = F.when(F.col("dom_est") < 180, 0).when(F.col("dom_est") < 365, 1).when(F.col("dom_est") < 730, 2).when(F.col("dom_est") < 1460, 3).otherwise(4)
    b = units(spark, d).where("dom_est IS NOT NULL").groupBy("area", o.alias("ord")).agg(F.median("x").alias("m"))
    return b.groupBy("area").agg(F.count("*").alias("buckets"), F.when(F.count("*") >= 2, half_up(F.max_by("m", "ord") - F.min_by("m", "ord"))).alias("gradient"))


@plan.query("agg_10", f"WITH {_UNIT} SELECT count(*) AS n, {half_up_sql('median((mqc - mq) / mq * 100)')} AS p50, {half_up_sql('quantile_cont((mqc - mq) / mq * 100, 0.9)')} AS p90 FROM u WHERE mqc IS NOT NULL")
def agg_10(spark, d):
    """How far the weighted size lies above the net one."""
    gap = (F.col("mqc") - F.col("mq")) / F.col("mq") * 100
    g = quantiles(units(spark, d).where("mqc IS NOT NULL").select(gap.alias("gap")), [], "gap", {"p50": 0.5, "p90": 0.9})
    return g.select("n", half_up(F.col("p50")).alias("p50"), half_up(F.col("p90")).alias("p90"))


@plan.query("agg_11", f"SELECT how, count(*) AS n FROM ({_cascade_sql('typology')}) GROUP BY how")
def agg_11(spark, d):
    """Histogram of the match method."""
    return _cascade(spark, d, F.col("typology")).groupBy("how").agg(F.count("*").alias("n"))


_FIELDS = ["price", "mq", "comune", "typology", "address_raw", "lat", "epc", "floor"]


@plan.query("agg_12", f"WITH {LISTINGS} SELECT source, count(*) AS n, " + ", ".join(f"count({c}) AS {c}" for c in _FIELDS) + " FROM l GROUP BY source")
def agg_12(spark, d):
    """Yield of each field by source."""
    return listings(spark, d, *_FIELDS).groupBy("source").agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in _FIELDS])


_MEMBERS = f"{LISTINGS}, {_CLUSTERS}, m AS (SELECT cluster, l.* FROM (SELECT cluster, unnest(members) AS rec FROM k) JOIN l USING (rec))"
_DIFF = f"{_MEMBERS}, x AS (SELECT cluster, count(*) AS n, min(price) FILTER (price > 0) AS p_lo, max(price) FILTER (price > 0) AS p_hi, min(mq) FILTER (mq > 0) AS m_lo, max(mq) FILTER (mq > 0) AS m_hi, count(DISTINCT typology) AS types, count(DISTINCT {AREA('comune')}) AS areas, count(*) FILTER (price_withheld = 1) AS withheld FROM m GROUP BY cluster)"


def members(spark, d, *columns):
    return clusters(spark, d).join(listings(spark, d, *columns), "rec")


def differences(spark, d):
    m = members(spark, d, "price", "mq", "typology", "comune", "price_withheld")
    pos = lambda c: F.when(F.col(c) > 0, F.col(c))
    return m.groupBy("cluster").agg(F.count("*").alias("n"), F.min(pos("price")).alias("p_lo"), F.max(pos("price")).alias("p_hi"), F.min(pos("mq")).alias("m_lo"), F.max(pos("mq")).alias("m_hi"), F.countDistinct("typology").alias("types"), F.countDistinct(area_key(F.col("comune"))).alias("areas"), F.count_if(F.col("price_withheld") == 1).alias("withheld"))


@plan.query("agg_15", f"WITH {_DIFF} SELECT count(*) AS clusters, count(*) FILTER (p_hi > p_lo) AS by_price, count(*) FILTER (m_hi > m_lo) AS by_size, count(*) FILTER (types > 1) AS by_type, {half_up_sql('median((p_hi - p_lo)::DOUBLE / p_lo * 100) FILTER (p_hi > p_lo)')} AS p50_spread, sum(withheld)::BIGINT AS withheld FROM x")
def agg_15(spark, d):
    """Disagreements summed up by axis."""
    x = differences(spark, d)
    spread = F.when(F.col("p_hi") > F.col("p_lo"), (F.col("p_hi") - F.col("p_lo")).cast("double") / F.col("p_lo") * 100)
    middle = quantiles(x.select(spread.alias("spread")), [], "spread", {"p50": 0.5}).select(half_up(F.col("p50")).alias("p50_spread"))
    counts = x.agg(F.count("*").alias("clusters"), F.count_if(F.col("p_hi") > F.col("p_lo")).alias("by_price"), F.count_if(F.col("m_hi") > F.col("m_lo")).alias("by_size"), F.count_if(F.col("types") > 1).alias("by_type"), F.sum("withheld").alias("withheld"))
    both = counts.unionByName(middle, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@plan.query("agg_16", f"WITH {_DIFF} SELECT *, CASE WHEN p_hi > p_lo THEN {half_up_sql('(p_hi - p_lo)::DOUBLE / p_lo * 100')} END AS price_pct, CASE WHEN m_hi > m_lo THEN {half_up_sql('(m_hi - m_lo)::DOUBLE / m_lo * 100')} END AS size_pct FROM x")
def agg_16(spark, d):
    """Per cluster: ranges of price and size, numbers of types and areas, withheld prices."""
    pct = lambda lo, hi: F.when(F.col(hi) > F.col(lo), half_up((F.col(hi) - F.col(lo)).cast("double") / F.col(lo) * 100))
    return differences(spark, d).select("*", pct("p_lo", "p_hi").alias("price_pct"), pct("m_lo", "m_hi").alias("size_pct"))


@plan.query("agg_17", f"WITH {LISTINGS} SELECT coalesce(agency_name, source) AS seller, count(*) AS n, count(price) AS priced, count(*) FILTER (price IS NULL AND price_bracket IS NOT NULL) AS bracket_only FROM l GROUP BY 1 HAVING count(*) >= 20")
def agg_17(spark, d):
    """What sellers publish, those with twenty or more listings."""
    g = listings(spark, d, "agency_name", "price", "price_bracket").groupBy(F.coalesce("agency_name", "source").alias("seller"))
    return g.agg(F.count("*").alias("n"), F.count("price").alias("priced"), F.count_if(F.col("price").isNull() & F.col("price_bracket").isNotNull()).alias("bracket_only")).where("n >= 20")


@plan.query("agg_18", f"WITH {LISTINGS} SELECT {AREA('comune')} AS area, coalesce(agency_name, source) AS seller, count(*) AS n, coalesce(list_aggregate(list_sort(list(DISTINCT trim(regexp_replace(surface_raw, '[0-9.,]+', '', 'g'))) FILTER (surface_raw IS NOT NULL)), 'string_agg', ';'), '') AS labels FROM l GROUP BY ALL")
def agg_18(spark, d):
    """Sellers by area with the labels they put on sizes."""
    label = F.trim(F.regexp_replace("surface_raw", "[0-9.,]+", ""))
    g = listings(spark, d, "comune", "agency_name", "surface_raw").groupBy(area_key(F.col("comune")).alias("area"), F.coalesce("agency_name", "source").alias("seller"))
    return g.agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(label)), ";").alias("labels"))


@plan.query("agg_19", f"WITH {_UNIT} SELECT area, count(*) AS n, median(price) AS price, {half_up_sql('median(x)')} AS unit, CAST(floor(median(dom_est)) AS INTEGER) AS age FROM u GROUP BY area")
def agg_19(spark, d):
    """Area statistics."""
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).cast("double").alias("v")) for c in ("price", "x", "dom_est")]))
    g = quantiles(units(spark, d).select("area", sides.alias("s")).select("area", "s.*"), ["area", "side"], "v", {"m": 0.5})
    one = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return g.groupBy("area").agg(one("price", "n").alias("n"), one("price", "m").alias("price"), half_up(one("x", "m")).alias("unit"), F.floor(one("dom_est", "m")).cast("int").alias("age"))


@plan.query("agg_20", f"WITH {_UNIT}, b AS (SELECT {AREA('comune')} AS area, min(min_eur_m2) AS lo, max(max_eur_m2) AS hi FROM omi_bands WHERE tipologia <> 'Box' AND max_eur_m2 > 10 GROUP BY 1), a AS (SELECT area, median(x) AS m FROM u GROUP BY area) SELECT area, {half_up_sql('m')} AS asked, lo, hi, CASE WHEN lo IS NULL THEN 'none' WHEN m > hi THEN 'above' WHEN m < lo THEN 'below' ELSE 'inside' END AS cue FROM a LEFT JOIN b USING (area)")
def agg_20(spark, d):
    """Median asked price against the official range of the area."""
    b = load(spark, d, "omi_bands").where("tipologia <> 'Box' AND max_eur_m2 > 10").groupBy(area_key(F.col("comune")).alias("area")).agg(F.min("min_eur_m2").alias("lo"), F.max("max_eur_m2").alias("hi"))
    a = quantiles(units(spark, d), ["area"], "x", {"m": 0.5})
    cue = F.when(F.col("lo").isNull(), "none").when(F.col("m") > F.col("hi"), "above").when(F.col("m") < F.col("lo"), "below").otherwise("inside")
    return a.join(b, "area", "left").select("area", half_up(F.col("m")).alias("asked"), "lo", "hi", cue.alias("cue"))


@plan.query("agg_21", f"WITH {_MEMBERS}, c AS (SELECT cluster, {AREA('comune')} AS area, count(*) AS n FROM m GROUP BY ALL) SELECT cluster, area FROM c QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, area) = 1")
def agg_21(spark, d):
    """The area most members name, ties in alphabetical order."""
    c = members(spark, d, "comune").groupBy("cluster", area_key(F.col("comune")).alias("area")).agg(F.count("*").alias("n"))
    return c.groupBy("cluster").agg(F.min_by("area", F.struct(-F.col("n"), "area")).alias("area"))


_CURVE = "WITH r AS (SELECT left(first_seen, 7) AS month, max(TRY_CAST(source_id AS BIGINT)) AS id, min(CAST(left(first_seen, 10) AS DATE)) AS day FROM listings WHERE regexp_matches(first_seen, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(source_id AS BIGINT) >= 100000000 GROUP BY 1)"
_RATES = f"{_CURVE}, g AS (SELECT id - lag(id) OVER w AS ids, day - lag(day) OVER w AS days FROM r WINDOW w AS (ORDER BY month)), m AS (SELECT ids, ids / (days / 30.44e0) AS rate, days FROM g WHERE ids IS NOT NULL)"


@plan.query("agg_22", f"{_RATES} SELECT (SELECT count(*) FROM r) AS n, (SELECT min(id) FROM r) AS first_id, (SELECT max(id) FROM r) AS last_id, count(*) FILTER (abs(ids) >= 10000) AS gaps, {half_up_sql('(max(rate) FILTER (days >= 30.44e0) - min(rate) FILTER (days >= 30.44e0)) / abs(avg(rate) FILTER (days >= 30.44e0)) * 100')} AS spread FROM m")
def agg_22(spark, d):
    """Health of a curve of anchors (the greatest number of each month): how many, from where to where, wide gaps, and
    how much the monthly rate varies; spans of under a month are no rate."""
    rows = load(spark, d, "listings").where(F.col("first_seen").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}")).select(F.left("first_seen", F.lit(7)).alias("month"), F.col("source_id").try_cast("long").alias("id"), F.left("first_seen", F.lit(10)).cast("date").alias("day")).where("id >= 100000000")
    r = rows.groupBy("month").agg(F.max("id").alias("id"), F.min("day").alias("day"))
    order = W.orderBy("month")  # one row a month
    g = r.select("id", (F.col("id") - F.lag("id").over(order)).alias("ids"), F.datediff("day", F.lag("day").over(order)).alias("days"))
    rate = F.when(F.col("days") >= 30.44, F.col("ids") / (F.col("days") / F.lit(30.44)))
    a = g.withColumn("rate", rate).agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count_if(F.abs("ids") >= 10000).alias("gaps"), F.max("rate").alias("hi"), F.min("rate").alias("lo"), F.avg("rate").alias("mean"))
    return a.select("n", "first_id", "last_id", "gaps", half_up((F.col("hi") - F.col("lo")) / F.abs("mean") * 100).alias("spread"))


@plan.query("agg_23", f"WITH {LISTINGS} SELECT coalesce(zona_guess, '-') AS guess, count(*) FILTER (left(zona_poly, 1) = 'B') AS b, count(*) FILTER (left(zona_poly, 1) = 'C') AS c, count(*) FILTER (left(zona_poly, 1) = 'D') AS d, count(*) FILTER (left(zona_poly, 1) = 'R') AS r, count(*) FILTER (zona_poly IS NULL) AS none FROM l GROUP BY 1")
def agg_23(spark, d):
    """Transition from guessed to polygon zone class."""
    rows = listings(spark, d, "zona_guess", "zona_poly").select(F.coalesce("zona_guess", F.lit("-")).alias("guess"), F.coalesce(F.lower(F.left("zona_poly", F.lit(1))), F.lit("none")).alias("z"))
    return rows.groupBy("guess").pivot("z", ["b", "c", "d", "r", "none"]).count().fillna(0)


@plan.query("agg_24", f"WITH {LISTINGS} SELECT source, count(*) AS n, count(*) FILTER (price IS NULL) AS unpriced FROM l GROUP BY source")
def agg_24(spark, d):
    return listings(spark, d, "price").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("price").isNull()).alias("unpriced"))


@plan.query("agg_25", "WITH p AS (SELECT DISTINCT lower(trim(dhash)) AS h, source, source || '/' || source_id AS rec FROM photo_hashes), n AS (SELECT h, count(DISTINCT rec) AS k FROM p GROUP BY h) SELECT p.source, count(DISTINCT rec) AS listings, count(DISTINCT p.h) AS pictures, count(DISTINCT p.h) FILTER (k > 1) AS shared, max(k) AS most FROM p JOIN n USING (h) GROUP BY p.source")
def agg_25(spark, d):
    """Sharing of pictures by source."""
    p = load(spark, d, "photo_hashes").select(F.lower(F.trim("dhash")).alias("h"), "source", rec_name().alias("rec")).distinct()
    n = p.groupBy("h").agg(F.count("rec").alias("k"))
    return p.join(n, "h").groupBy("source").agg(F.countDistinct("rec").alias("listings"), F.countDistinct("h").alias("pictures"), F.countDistinct(F.when(F.col("k") > 1, F.col("h"))).alias("shared"), F.max("k").alias("most"))


@plan.query("agg_26", f"SELECT {AREA('comune')} AS area, coalesce(upper(left(trim(surface_basis), 1)), '-') AS basis, count(*) AS n, count(*) FILTER (min_eur_m2 > max_eur_m2) AS inverted FROM (SELECT DISTINCT * FROM omi_bands) GROUP BY ALL")
def agg_26(spark, d):
    """Sanity of the bands by area and basis."""
    b = load(spark, d, "omi_bands").distinct()
    return b.groupBy(area_key(F.col("comune")).alias("area"), F.coalesce(F.upper(F.left(F.trim("surface_basis"), F.lit(1))), F.lit("-")).alias("basis")).agg(F.count("*").alias("n"), F.count_if(F.col("min_eur_m2") > F.col("max_eur_m2")).alias("inverted"))


_STATED = r"regexp_extract(description, 'circa ([0-9]+) mq', 1)"


@plan.query("agg_27", f"WITH {LISTINGS}, s AS (SELECT source, TRY_CAST({_STATED} AS INTEGER) AS said, mq FROM l WHERE length(description) >= 25) SELECT source, count(*) AS texts, count(said) AS stated, count(*) FILTER (abs(said - mq)::DOUBLE / nullif(mq, 0) > 0.1) AS conflicts FROM s GROUP BY source")
def agg_27(spark, d):
    """Coverage and conflicts of sizes stated in prose, by source."""
    said = F.regexp_extract("description", "circa ([0-9]+) mq", 1).try_cast("int")
    s = listings(spark, d, "description", "mq").where(F.length("description") >= 25).select("source", said.alias("said"), "mq")
    off = F.abs(F.col("said") - F.col("mq")).cast("double") / F.nullif("mq", F.lit(0)) > 0.1
    return s.groupBy("source").agg(F.count("*").alias("texts"), F.count("said").alias("stated"), F.count_if(off).alias("conflicts"))


@plan.query("agg_28", f"WITH {_MEMBERS}, x AS (SELECT cluster, min({AREA('comune')}) AS area, (max(price) - min(price))::DOUBLE / nullif(min(price), 0) AS p, (max(mq) - min(mq))::DOUBLE / nullif(min(mq), 0) AS s FROM m GROUP BY cluster) SELECT area, count(*) AS n, {half_up_sql('max(greatest(coalesce(p, 0), coalesce(s, 0))) * 100')} AS worst FROM x GROUP BY area")
def agg_28(spark, d):
    """Findings by area with the worst spread."""
    spread = lambda c: (F.max(c) - F.min(c)).cast("double") / F.nullif(F.min(c), F.lit(0))
    x = members(spark, d, "comune", "price", "mq").groupBy("cluster").agg(F.min(area_key(F.col("comune"))).alias("area"), spread("price").alias("p"), spread("mq").alias("s"))
    return x.groupBy("area").agg(F.count("*").alias("n"), half_up(F.max(F.greatest(F.coalesce("p", F.lit(0.0)), F.coalesce("s", F.lit(0.0)))) * 100).alias("worst"))


@plan.query("snk_07", f"WITH {_MEMBERS} SELECT cluster, string_agg('- ' || rec || ': ' || coalesce(CAST(price AS VARCHAR), 'n/a'), chr(10) ORDER BY rec) AS report FROM m GROUP BY cluster")
def snk_07(spark, d):
    """One text block per cluster."""
    line = F.concat(F.lit("- "), "rec", F.lit(": "), F.coalesce(F.col("price").cast("string"), F.lit("n/a")))
    return members(spark, d, "price").groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rec", line.alias("line")))), lambda x: x["line"]), "\n").alias("report"))


@plan.query("win_11", f"WITH {_IV}, g AS (SELECT area, quantile_cont(lo, 0.25) AS l25, quantile_cont(lo, 0.5) AS l50, quantile_cont(hi, 0.5) AS h50, quantile_cont(hi, 0.75) AS h75 FROM v GROUP BY area) SELECT v.area, CASE WHEN lo > h75 THEN 'above p75' WHEN hi < l25 THEN 'below p25' WHEN lo > h50 THEN 'above p50' WHEN hi < l50 THEN 'below p50' ELSE 'straddling' END AS place, count(*) AS n FROM v JOIN g USING (area) GROUP BY ALL")
def win_11(spark, d):
    """Where an interval stands in its area's band, interval against interval."""
    v = units(spark, d).where("mqc >= mq").select("area", half_up(F.col("price") / F.nullif("mqc", F.lit(0.0))).alias("lo"), F.col("x").alias("hi"))
    g = v.groupBy("area").agg(F.percentile("lo", 0.25).alias("l25"), F.median("lo").alias("l50"), F.median("hi").alias("h50"), F.percentile("hi", 0.75).alias("h75"))
    place = F.when(F.col("lo") > F.col("h75"), "above p75").when(F.col("hi") < F.col("l25"), "below p25").when(F.col("lo") > F.col("h50"), "above p50").when(F.col("hi") < F.col("l50"), "below p50").otherwise("straddling")
    return v.join(g, "area").groupBy("area", place.alias("place")).agg(F.count("*").alias("n"))


@plan.query("ext_02", f"WITH b AS (SELECT DISTINCT {AREA('comune')} AS area, zona_code, tipologia, semester, avg(min_eur_m2) AS lo FROM omi_bands WHERE max_eur_m2 > 10 GROUP BY ALL) SELECT a.area, a.zona_code, a.tipologia, {half_up_sql('(b.lo - a.lo) / a.lo * 100')} AS drift FROM b a JOIN b USING (area, zona_code, tipologia) WHERE a.semester = '2025-S1' AND b.semester = '2025-S2'")
def ext_02(spark, d):
    """Extension: drift of the bands between two semesters."""
    b = load(spark, d, "omi_bands").where("max_eur_m2 > 10").groupBy(area_key(F.col("comune")).alias("area"), "zona_code", "tipologia", "semester").agg(F.avg("min_eur_m2").alias("lo"))
    first = b.where("semester = '2025-S1'").drop("semester")
    second = b.where("semester = '2025-S2'").drop("semester").withColumnRenamed("lo", "lo2")
    return first.join(second, ["area", "zona_code", "tipologia"]).select("area", "zona_code", "tipologia", half_up((F.col("lo2") - F.col("lo")) / F.col("lo") * 100).alias("drift"))


@plan.query("ext_03", f"WITH {LISTINGS} SELECT coalesce(agency_name, source) AS seller, price, count(*) AS n FROM l WHERE price > 0 GROUP BY ALL HAVING count(*) > 1")
def ext_03(spark, d):
    """Extension: one seller, several offers at one price."""
    return listings(spark, d, "agency_name", "price").where("price > 0").groupBy(F.coalesce("agency_name", "source").alias("seller"), "price").agg(F.count("*").alias("n")).where("n > 1")


@plan.query("ext_04", f"WITH {_MEMBERS} SELECT cluster, max(dom_est) - min(dom_est) AS age_gap FROM m WHERE dom_est IS NOT NULL GROUP BY cluster")
def ext_04(spark, d):
    """Extension: disagreement of apparent ages inside a cluster."""
    return members(spark, d, "dom_est").where("dom_est IS NOT NULL").groupBy("cluster").agg((F.max("dom_est") - F.min("dom_est")).alias("age_gap"))


@plan.query(
    "gate_07",
    f"""WITH {_DIFF}, r AS (SELECT cluster, bool_and(regexp_matches(lower(trim(coalesce(agency_name, ''))), '{AUCTION}')) AS resold, bool_or(cluster_ref) AS ref FROM (SELECT m.*, coalesce(u.ref, FALSE) AS cluster_ref FROM m LEFT JOIN (SELECT source || '/' || source_id AS rec, url_alt AS cluster, bool_or(match_route = 'ref') AS ref FROM url_alt GROUP BY ALL) u USING (rec, cluster)) GROUP BY cluster),
    y AS (SELECT *, coalesce((m_hi - m_lo)::DOUBLE / m_lo, 0) AS ms, coalesce((p_hi - p_lo)::DOUBLE / p_lo, 0) AS ps FROM x JOIN r USING (cluster))
    SELECT cluster, CASE WHEN n < 2 THEN 'single' WHEN ps = 0 AND ms = 0 AND types < 2 AND areas < 2 THEN 'agreed' WHEN ms > 2.0 AND NOT ref THEN 'size' WHEN resold AND ms < 0.15 THEN 'reseller' WHEN ps > 5.0 THEN 'price' ELSE 'kept' END AS outcome FROM y""",
)
def gate_07(spark, d):
    """Clusters that are no disagreement about one item, in order of the guards: no difference, sizes too far apart
    without a common reference, resellers of one auction that all but agree, prices too far apart."""
    ref = load(spark, d, "url_alt").groupBy(rec_name().alias("rec"), F.col("url_alt").alias("cluster")).agg(F.bool_or(F.col("match_route") == "ref").alias("ref"))
    m = members(spark, d, "agency_name").join(ref, ["rec", "cluster"], "left")
    resold = F.lower(F.trim(F.coalesce("agency_name", F.lit("")))).rlike(AUCTION)
    r = m.groupBy("cluster").agg(F.bool_and(resold).alias("resold"), F.bool_or(F.coalesce("ref", F.lit(False))).alias("ref"))
    spread = lambda lo, hi: F.coalesce((F.col(hi) - F.col(lo)).cast("double") / F.col(lo), F.lit(0.0))
    y = differences(spark, d).join(r, "cluster").withColumn("ms", spread("m_lo", "m_hi")).withColumn("ps", spread("p_lo", "p_hi"))
    outcome = F.when(F.col("n") < 2, "single").when((F.col("ps") == 0) & (F.col("ms") == 0) & (F.col("types") < 2) & (F.col("areas") < 2), "agreed")
    outcome = outcome.when((F.col("ms") > 2.0) & ~F.col("ref"), "size").when(F.col("resold") & (F.col("ms") < 0.15), "reseller").when(F.col("ps") > 5.0, "price").otherwise("kept")
    return y.select("cluster", outcome.alias("outcome"))


@plan.query("str_08", f"WITH {_MEMBERS}, s AS (SELECT cluster, {_STREET6} AS street, trim(coalesce(title, '')) AS title FROM m) SELECT cluster, coalesce(min_by(street, (-length(street), street)) FILTER (street <> ''), min_by(title, (-length(title), title)) FILTER (title <> ''), 'no address') AS label FROM s GROUP BY cluster")
def str_08(spark, d):
    """Best label of a cluster: the longest public street, else the longest title, else a constant; ties in alphabetical order."""
    longest = lambda c: F.min(F.when(F.col(c) != "", F.struct((-F.length(c)).alias("k"), F.col(c).alias("v"))))["v"]
    s = members(spark, d, "address_raw", "title").select("cluster", public_street(F.col("address_raw")).alias("street"), F.trim(F.coalesce("title", F.lit(""))).alias("title"))
    return s.groupBy("cluster").agg(F.coalesce(longest("street"), longest("title"), F.lit("no address")).alias("label"))


_LABEL = f"coalesce(regexp_extract_all(regexp_replace(lower({FOLD('label')}), '[^a-z0-9]+', ' ', 'g'), '[a-z0-9]+')[1:4], [])"
_SLUG = f"""{_MEMBERS}, t AS (SELECT *, {_STREET6} AS street FROM m),
    g AS (SELECT cluster, min_by({AREA('comune')}, rec) AS area, min_by(street, (-length(street), street)) FILTER (street <> '') AS label, left(sha1(string_agg(rec, '|' ORDER BY rec)), 6) AS h FROM t GROUP BY cluster),
    s AS (SELECT cluster, array_to_string(list_filter(list_concat([area], {_LABEL}, [h]), lambda x: x <> ''), '-') AS slug FROM g)"""


def cluster_slugs(spark, d):
    """``cluster, slug``: area of the first member, four words of the longest public street, six digits of the members' digest."""
    m = members(spark, d, "comune", "address_raw").withColumn("street", public_street(F.col("address_raw")))
    named = F.when(F.col("street") != "", F.struct((-F.length("street")).alias("k"), "street"))
    g = m.groupBy("cluster").agg(F.min_by(area_key(F.col("comune")), "rec").alias("area"), F.min(named)["street"].alias("label"), F.left(F.sha1(F.array_join(F.array_sort(F.collect_list("rec")), "|")), F.lit(6)).alias("h"))
    words = F.filter(F.split(F.regexp_replace(F.lower(fold_accents(F.coalesce("label", F.lit("")))), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    return g.select("cluster", F.array_join(F.filter(F.concat(F.array("area"), F.slice(words, 1, 4), F.array("h")), lambda x: x != ""), "-").alias("slug"))


@plan.query("str_16_clusters", f"WITH {_SLUG} SELECT cluster, slug FROM s")
def str_16_clusters(spark, d):
    """Public key of each cluster."""
    return cluster_slugs(spark, d)


_CIVIC_KEY = "-[0-9]+[a-z]?-[0-9a-f]{6}$"


@plan.query("gate_03", f"WITH {_SLUG} SELECT count(*) FILTER (regexp_matches(slug, '{_CIVIC_KEY}')) AS violations, count(*) AS keys FROM s")
def gate_03(spark, d):
    """Public keys of clusters that end in a house number."""
    return cluster_slugs(spark, d).agg(F.count_if(F.col("slug").rlike(_CIVIC_KEY)).alias("violations"), F.count("*").alias("keys"))


@plan.query("win_09", f"""WITH {_DIFF}, v AS (SELECT DISTINCT unnest(ids) AS rec FROM verified_clusters WHERE verdict = 'confirmed'), sure AS (SELECT DISTINCT cluster FROM m JOIN v USING (rec))
    SELECT cluster, {half_up_sql("coalesce((m_hi - m_lo)::DOUBLE / m_lo * 100, 0) + coalesce((p_hi - p_lo)::DOUBLE / p_lo * 100, 0)")} + CASE WHEN cluster IN (FROM sure) THEN 50 ELSE 0 END AS score FROM x""")
def win_09(spark, d):
    """Rank of findings: size and price spread in per cent, and fifty where a member is confirmed; ties by name."""
    pct = lambda lo, hi: F.coalesce((F.col(hi) - F.col(lo)).cast("double") / F.col(lo) * 100, F.lit(0.0))
    sure = load(spark, d, "verified_clusters").where("verdict = 'confirmed'").select(F.explode("ids").alias("rec")).distinct()
    confirmed = clusters(spark, d).join(sure, "rec", "left_semi").select("cluster", F.lit(50).alias("bonus")).distinct()
    x = differences(spark, d).join(confirmed, "cluster", "left")
    score = half_up(pct("m_lo", "m_hi") + pct("p_lo", "p_hi")) + F.coalesce("bonus", F.lit(0))
    return x.select("cluster", score.alias("score")).orderBy(F.desc("score"), "cluster")
