"""Whole pipelines: from listings to what a user reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.functions.text import TYPE_SYNONYMS, area_key, public_street, type_class
from pagliaio.operators.graph import components
from pagliaio.plans.joins import _OFFERS, _PICTURES, close_pairs, joi_07, offers
from pagliaio.plans.offers import _STREET6, AREA, AUCTION
from pagliaio.plans.registry import Plan, half_up, half_up_sql, listings
from pagliaio.session import cut_lineage
from pagliaio.tables import load

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql

#: Prices that are multiples of this are round and group nothing by themselves.
ROUND_TO = 1000
#: A cluster's sizes lie within this of their median; spreads beyond these are no disagreement about one item.
TOLERANCE, MOST_SIZE_SPREAD, MOST_PRICE_SPREAD, LEAST_RESELLER_SPREAD = 1.35, 200.0, 500.0, 15.0


def set_names(members: DataFrame, key: str) -> DataFrame:
    """``key, n, name``: each set's size and a name that only equal sets share, from two hashes of the members each in two sums."""
    first, second = F.xxhash64("rec"), F.xxhash64(F.lit(1), F.col("rec"))
    name = F.concat_ws("/", F.bit_xor(first), F.sum(first.cast("decimal(38,0)")), F.bit_xor(second), F.sum(second.cast("decimal(38,0)")))
    return members.groupBy(key).agg(F.count("*").alias("n"), name.alias("name"))


def evidence_groups(spark, d) -> tuple[DataFrame, DataFrame]:
    """Members (name, rec) of the evidence groups, and (name, n, evidence): one group for each different set of members."""
    o = cut_lineage(offers(spark, d))
    priced = o.where(f"price > 0 AND price % {ROUND_TO} <> 0")
    groups = priced.groupBy("area", "price").agg(F.countDistinct("seller").alias("sellers")).where("sellers >= 2").drop("sellers")
    by_price = priced.join(groups, ["area", "price"]).select(F.concat_ws("|", F.lit("p"), "area", "price").alias("gid"), "rec", F.lit("price").alias("tag"))
    pairs = close_pairs(o.where(f"price % {ROUND_TO} = 0")).select(F.concat_ws("|", F.lit("s"), "rec_a", "rec_b").alias("gid"), F.explode(F.array("rec_a", "rec_b")).alias("rec"), F.lit("price+surface").alias("tag"))
    pictures = cut_lineage(joi_07(spark, d))
    of_picture = cut_lineage(components(pictures.select("rec_a", "rec_b"), "rec_a", "rec_b"))
    strength = pictures.join(of_picture, pictures["rec_a"] == of_picture["member"]).groupBy("component").agg(F.min("shared").alias("least"))
    shown = of_picture.join(o.select("rec", "seller"), F.col("member") == F.col("rec"))
    several = shown.groupBy("component").agg(F.countDistinct("seller").alias("sellers"), F.count("*").alias("n")).where("sellers > 1 AND n > 1")
    by_picture = shown.join(several, "component").join(strength, "component").select(F.concat_ws("|", F.lit("f"), "component").alias("gid"), "rec", F.when(F.col("least") >= 2, "photo").otherwise("photo-weak").alias("tag"))
    found = cut_lineage(by_price.unionByName(pairs).unionByName(by_picture))
    named = cut_lineage(set_names(found, "gid").join(found.select("gid", "tag").distinct(), "gid"))
    refs = o.where("ref <> ''").withColumn("key", F.concat_ws("|", "area", "ref"))
    shared = refs.join(refs.groupBy("key").agg(F.countDistinct("seller").alias("sellers")).where("sellers > 1"), "key", "left_semi")
    confirmed = set_names(shared, "key").select("name", F.lit("ref").alias("tag")).join(named.select("name", "n"), "name")
    tags = named.select("name", "n", "tag").unionByName(confirmed.select("name", "n", "tag"))
    first = named.groupBy("name").agg(F.min("gid").alias("gid"))
    return cut_lineage(found.join(first, "gid").select("name", "rec").distinct()), cut_lineage(tags.groupBy("name", "n").agg(F.array_sort(F.collect_set("tag")).alias("evidence")))


def evidence_clusters(spark, d) -> tuple[DataFrame, DataFrame]:
    """Members (cluster, rec) and (cluster, n, evidence): components of all evidence, and where one is incoherent its smaller groups instead."""
    members, groups = evidence_groups(spark, d)
    least = members.groupBy("name").agg(F.min("rec").alias("least"))
    of_all = cut_lineage(components(members.join(least, "name").select("least", "rec"), "least", "rec"))
    joined = cut_lineage(of_all.join(listings(spark, d, "mq", "agency_name"), F.col("member") == F.col("rec")).select("component", "rec", F.when(F.col("mq") > 0, F.col("mq").cast("double")).alias("s"), F.coalesce("agency_name", "source").alias("seller")))
    stats = joined.groupBy("component").agg(F.count("*").alias("n"), F.countDistinct("seller").alias("sellers"), F.count("s").alias("sized"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY s DESC)").alias("med"))
    near = F.when(F.col("sized") > 2, (F.col("hi") / F.col("med") <= TOLERANCE) & (F.col("med") / F.col("lo") <= TOLERANCE)).otherwise(True)
    whole = cut_lineage(stats.select("component", F.col("n").alias("all"), ((F.col("n") == 2) | (near & (F.col("n") <= F.col("sellers") + 1))).alias("coherent")))
    placed = least.join(of_all, F.col("least") == F.col("member")).join(whole, "component").join(groups, "name").select("name", "component", "coherent", "all", "n", "evidence")
    placed = cut_lineage(placed)
    merged = placed.where("coherent").groupBy("component").agg(F.first("all").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("evidence")))).alias("evidence"))
    parts = placed.where("NOT coherent AND n < all").select(F.col("name").alias("cluster"), "n", "evidence")
    rows = joined.join(merged, "component").select(F.col("component").alias("cluster"), "rec").unionByName(members.join(parts, F.col("name") == F.col("cluster")).select("cluster", "rec"))
    return cut_lineage(rows), cut_lineage(merged.withColumnRenamed("component", "cluster").unionByName(parts))


_FOUND = f"""{_OFFERS}, {_PICTURES},
    pr AS (SELECT list_sort(list(rec)) AS m, 'price' AS tag FROM o WHERE price > 0 AND price % {ROUND_TO} <> 0 GROUP BY area, price HAVING count(DISTINCT seller) >= 2),
    pk AS (SELECT *, count(*) OVER (PARTITION BY area, price) AS k FROM o WHERE price > 0 AND price % {ROUND_TO} = 0),
    ps AS (SELECT list_value(a.rec, b.rec) AS m, 'price+surface' AS tag FROM pk a JOIN pk b ON a.area = b.area AND a.price = b.price AND a.rec < b.rec AND a.seller <> b.seller
      WHERE a.mq > 0 AND b.mq > 0 AND (greatest(a.mq, b.mq) - least(a.mq, b.mq))::DOUBLE / least(a.mq, b.mq) <= 0.15
        AND CASE WHEN a.street IS NULL OR b.street IS NULL THEN a.k <= 2 ELSE contains(a.street, b.street) OR contains(b.street, a.street) END),
    pp AS (SELECT a.rec AS u, b.rec AS v, count(DISTINCT a.h) AS shared FROM q a JOIN q b ON a.rec < b.rec AND bit_count(xor(a.h, b.h)) <= 5 GROUP BY ALL),
    pe AS (SELECT u, v FROM pp UNION SELECT v, u FROM pp),
    prr AS (SELECT DISTINCT u AS rec, u AS lab FROM pe UNION SELECT pe.v, prr.lab FROM prr JOIN pe ON pe.u = prr.rec WHERE prr.lab < pe.v),
    pc AS (SELECT rec, min(lab) AS c FROM prr GROUP BY rec),
    pl AS (SELECT c, min(shared) AS least FROM pp JOIN pc ON pc.rec = pp.u GROUP BY c),
    ph2 AS (SELECT list_sort(list(o.rec)) AS m, CASE WHEN any_value(least) >= 2 THEN 'photo' ELSE 'photo-weak' END AS tag FROM pc JOIN pl USING (c) JOIN o ON o.rec = pc.rec GROUP BY c HAVING count(DISTINCT seller) > 1 AND count(*) > 1),
    rf AS (SELECT list_sort(list(rec)) AS m FROM o WHERE ref <> '' GROUP BY area, ref HAVING count(DISTINCT seller) > 1),
    f0 AS (FROM pr UNION ALL FROM ps UNION ALL FROM ph2),
    f AS (SELECT m, len(m) AS n, list_sort(list(DISTINCT tag)) AS evidence FROM (FROM f0 UNION ALL SELECT m, 'ref' FROM rf WHERE m IN (SELECT m FROM f0)) GROUP BY m),
    fe AS (SELECT DISTINCT m[1] AS u, unnest(m) AS v FROM f), fb AS (SELECT u, v FROM fe WHERE u <> v UNION SELECT v, u FROM fe WHERE u <> v),
    fr AS (SELECT DISTINCT u AS rec, u AS lab FROM fb UNION SELECT fb.v, fr.lab FROM fr JOIN fb ON fb.u = fr.rec WHERE fr.lab < fb.v),
    fc AS (SELECT rec, min(lab) AS component FROM fr GROUP BY rec),
    cs AS (SELECT component, list_sort(list(rec)) AS m, count(*) AS n, count(DISTINCT seller) AS sellers, list_sort(list(mq) FILTER (mq > 0)) AS s FROM fc JOIN o USING (rec) GROUP BY component),
    ok AS (SELECT *, n = 2 OR (n <= sellers + 1 AND (coalesce(len(s), 0) <= 2 OR (s[len(s)]::DOUBLE / s[len(s) // 2 + 1] <= {TOLERANCE} AND s[len(s) // 2 + 1]::DOUBLE / s[1] <= {TOLERANCE}))) AS coherent FROM cs),
    pt AS (SELECT f.*, ok.component, ok.coherent, ok.m AS all_m, ok.n AS all_n FROM f JOIN fc ON fc.rec = f.m[1] JOIN ok USING (component)),
    cl AS (SELECT any_value(all_m) AS m, list_sort(list_distinct(flatten(list(evidence)))) AS evidence FROM pt WHERE coherent GROUP BY component
           UNION ALL SELECT m, evidence FROM pt WHERE NOT coherent AND n < all_n)"""


@plan.query("grf_02_evidence", f"WITH RECURSIVE {_FOUND} SELECT m[1] AS first_rec, len(m) AS n, array_to_string(evidence, '+') AS evidence FROM cl")
def grf_02_evidence(spark, d):
    """Clusters of all evidence (equal odd prices, round price with size, pictures, references) after the coherence test."""
    members, groups = evidence_clusters(spark, d)
    first = members.groupBy("cluster").agg(F.min("rec").alias("first_rec"))
    return groups.join(first, "cluster").select("first_rec", "n", F.array_join("evidence", "+").alias("evidence"))


_CLASS = "CASE " + " ".join(f"WHEN lower(trim(typology)) = '{k}' THEN '{v}'" for k, v in TYPE_SYNONYMS.items()) + " ELSE lower(trim(typology)) END"


@plan.query(
    "pipe_contradictions",
    f"""WITH RECURSIVE {_FOUND},
    vd AS (SELECT cl.m, cl.evidence, min_by(v.verdict, v.ord) AS verdict, min_by(coalesce(v.drop_ids, []), v.ord) AS gone FROM cl JOIN verified_clusters v
      ON list_has_all(v.ids, cl.m) OR (v.verdict <> 'confirmed' AND list_has_all(cl.m, v.ids)) GROUP BY cl.m, cl.evidence),
    ov AS (SELECT cl.m AS was, cl.evidence, vd.verdict, list_filter(cl.m, lambda x: NOT list_contains(coalesce(vd.gone, []), x)) AS m FROM cl LEFT JOIN vd ON vd.m = cl.m AND vd.evidence = cl.evidence),
    x0 AS (SELECT was, evidence, verdict, list_contains(evidence, 'ref') OR list_contains(evidence, 'photo') OR coalesce(verdict = 'confirmed', FALSE) AS identity, unnest(m) AS rec FROM ov WHERE coalesce(verdict, 'confirmed') = 'confirmed' AND len(m) > 1),
    x1 AS (SELECT x0.*, CASE WHEN coalesce(price_withheld, 0) <> 1 AND price > 0 THEN price END AS p, CASE WHEN mq > 0 THEN mq END AS s, {_CLASS} AS t, {AREA('comune')} AS a, nullif(lower({_STREET6}), '') AS street, regexp_matches(lower(trim(coalesce(agency_name, ''))), '{AUCTION}') AS reseller FROM x0 JOIN l USING (rec)),
    x2 AS (SELECT was, evidence, verdict, any_value(identity) AS identity, min(rec) AS first_rec, count(*) AS n, min(p) AS p_lo, max(p) AS p_hi, min(s) AS s_lo, max(s) AS s_hi, count(DISTINCT t) AS types, count(DISTINCT nullif(a, '')) AS areas, count(DISTINCT street) AS streets, bool_and(reseller) AS resold FROM x1 GROUP BY was, evidence, verdict),
    x3 AS (SELECT *, coalesce((p_hi - p_lo)::DOUBLE / p_lo * 100, 0) AS p_pct, coalesce((s_hi - s_lo)::DOUBLE / s_lo * 100, 0) AS s_pct FROM x2)
    SELECT first_rec, n, array_to_string(evidence, '+') AS evidence, coalesce(verdict = 'confirmed', FALSE) AS confirmed, {half_up_sql('p_pct')} AS price_pct, {half_up_sql('s_pct')} AS size_pct, types, areas,
      {half_up_sql('s_pct + p_pct + CASE WHEN verdict IS NULL THEN 0 ELSE 50 END')} AS score
    FROM x3 WHERE (p_pct > 0 OR s_pct > 0 OR types > 1 OR areas > 1 OR (identity AND areas <= 1 AND streets > 1))
      AND NOT (s_pct > {MOST_SIZE_SPREAD} AND NOT list_contains(evidence, 'ref')) AND NOT (resold AND s_pct < {LEAST_RESELLER_SPREAD}) AND NOT p_pct > {MOST_PRICE_SPREAD}""",
)
def pipe_contradictions(spark, d):
    """Who disagrees about one item: evidence, clusters, verdicts, disagreements, guards in order, rank.

    A verdict rejects a cluster that holds its set or lies in it, and confirms one that lies in it; the first verdict
    counts and takes out its dropped members. Streets count only where reference or pictures identify the item and
    no area differs.
    """
    members, groups = evidence_clusters(spark, d)
    v = load(spark, d, "verified_clusters").select("ord", "verdict", F.array_distinct("ids").alias("ids"), F.coalesce("drop_ids", F.array().cast("array<string>")).alias("gone"))
    met = members.join(v.select("ord", "verdict", "gone", F.size("ids").alias("n_ids"), F.explode("ids").alias("rec")), "rec")
    met = met.groupBy("cluster", "ord", "verdict", "gone", "n_ids").agg(F.count("*").alias("both")).join(groups.select("cluster", "n"), "cluster")
    laid = (F.col("both") == F.col("n")) | ((F.col("verdict") != "confirmed") & (F.col("both") == F.col("n_ids")))
    verdicts = met.where(laid).groupBy("cluster").agg(F.min_by(F.struct("verdict", "gone"), "ord").alias("v")).select("cluster", "v.verdict", "v.gone")
    kept = groups.drop("n").join(verdicts, "cluster", "left").where(F.coalesce("verdict", F.lit("confirmed")) == "confirmed")
    rows = members.join(kept, "cluster").where(~F.coalesce(F.array_contains("gone", F.col("rec")), F.lit(False))).drop("gone")
    facts = listings(spark, d, "price", "price_withheld", "mq", "typology", "comune", "address_raw", "agency_name").select(
        "rec", F.when((F.coalesce("price_withheld", F.lit(0)) != 1) & (F.col("price") > 0), F.col("price")).alias("p"), F.when(F.col("mq") > 0, F.col("mq")).alias("s"), type_class(F.col("typology")).alias("t"),
        F.nullif(area_key(F.col("comune")), F.lit("")).alias("a"), F.nullif(F.lower(public_street(F.col("address_raw"))), F.lit("")).alias("street"), F.lower(F.trim(F.coalesce("agency_name", F.lit("")))).rlike(AUCTION).alias("reseller"),
    )
    x = rows.join(facts, "rec").groupBy("cluster").agg(
        F.first("evidence").alias("evidence"), F.first("verdict").alias("verdict"), F.min("rec").alias("first_rec"), F.count("*").alias("n"), F.min("p").alias("p_lo"), F.max("p").alias("p_hi"), F.min("s").alias("s_lo"), F.max("s").alias("s_hi"),
        F.countDistinct("t").alias("types"), F.countDistinct("a").alias("areas"), F.countDistinct("street").alias("streets"), F.bool_and("reseller").alias("resold"),
    ).where("n > 1")
    pct = lambda lo, hi: F.coalesce((F.col(hi) - F.col(lo)).cast("double") / F.col(lo) * 100, F.lit(0.0))
    x = x.withColumn("p_pct", pct("p_lo", "p_hi")).withColumn("s_pct", pct("s_lo", "s_hi"))
    has = lambda tag: F.array_contains("evidence", tag)
    confirmed = F.col("verdict").isNotNull()
    differ = (F.col("p_pct") > 0) | (F.col("s_pct") > 0) | (F.col("types") > 1) | (F.col("areas") > 1) | ((has("ref") | has("photo") | confirmed) & (F.col("areas") <= 1) & (F.col("streets") > 1))
    guarded = x.where(differ).where(~((F.col("s_pct") > MOST_SIZE_SPREAD) & ~has("ref"))).where(~(F.col("resold") & (F.col("s_pct") < LEAST_RESELLER_SPREAD))).where(F.col("p_pct") <= MOST_PRICE_SPREAD)
    score = half_up(F.col("s_pct") + F.col("p_pct") + F.when(confirmed, 50).otherwise(0))
    return guarded.select("first_rec", "n", F.array_join("evidence", "+").alias("evidence"), confirmed.alias("confirmed"), half_up(F.col("p_pct")).alias("price_pct"), half_up(F.col("s_pct")).alias("size_pct"), "types", "areas", score.alias("score")).orderBy(F.desc("score"), "first_rec")
