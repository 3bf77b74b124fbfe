"""Extensions on the star schema and the event stream: what the engine offers beyond listings."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagliaio.plans.registry import Plan, half_up, half_up_sql
from pagliaio.tables import broadcast_if_small, load

plan = Plan()
QUERIES, SQL = plan.queries, plan.sql


@plan.query("ext_q1", f"SELECT l_returnflag, l_linestatus, {half_up_sql('sum(l_quantity)', 2)} AS sum_qty, {half_up_sql('sum(l_extendedprice * (1 - l_discount))', 0)} AS revenue, {half_up_sql('avg(l_discount)', 4)} AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def ext_q1(spark, d):
    """Pricing summary."""
    li = load(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(half_up(F.sum("l_quantity"), 2).alias("sum_qty"), half_up(F.sum(net), 0).alias("revenue"), half_up(F.avg("l_discount"), 4).alias("avg_disc"), F.count("*").alias("n"))


@plan.query("ext_q3", f"SELECT l_orderkey, {half_up_sql('sum(l_extendedprice * (1 - l_discount))', 1)} AS revenue, o_orderdate FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1995-03-15' AND l_shipdate > TIMESTAMP '1995-03-15' GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, l_orderkey LIMIT 10")
def ext_q3(spark, d):
    """Shipping priority: top ten orders."""
    day = F.lit("1995-03-15").cast("timestamp_ntz")
    c = load(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    o = load(spark, d, "orders").where(F.col("o_orderdate") < day).select("o_orderkey", "o_custkey", "o_orderdate")
    li = load(spark, d, "lineitem").where(F.col("l_shipdate") > day).select("l_orderkey", "l_extendedprice", "l_discount")
    j = li.join(o.join(c, F.col("c_custkey") == F.col("o_custkey"), "left_semi"), F.col("l_orderkey") == F.col("o_orderkey"))
    g = j.groupBy("l_orderkey", "o_orderdate").agg(half_up(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 1).alias("revenue"))
    return g.orderBy(F.col("revenue").desc(), "l_orderkey").limit(10).select("l_orderkey", "revenue", "o_orderdate")


@plan.query("ext_q5", f"SELECT n_name, {half_up_sql('sum(l_extendedprice * (1 - l_discount))', 0)} AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name")
def ext_q5(spark, d):
    """Local supplier volume: dimensions are broadcast only if they are small."""
    n = load(spark, d, "nation").join(F.broadcast(load(spark, d, "region").where("r_name = 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    s = load(spark, d, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name")
    co = load(spark, d, "orders").select("o_orderkey", "o_custkey").join(load(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    li = load(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount").join(broadcast_if_small(s), F.col("l_suppkey") == F.col("s_suppkey"))
    j = li.join(co, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return j.groupBy("n_name").agg(half_up(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 0).alias("revenue"))


@plan.query("ext_q6", f"SELECT {half_up_sql('sum(l_extendedprice * l_discount)', 1)} AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1994-01-01' AND l_shipdate < TIMESTAMP '1995-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def ext_q6(spark, d):
    """Forecast of revenue change: all filters reach the scan."""
    li = load(spark, d, "lineitem").where("l_shipdate >= TIMESTAMP_NTZ '1994-01-01' AND l_shipdate < TIMESTAMP_NTZ '1995-01-01' AND l_discount BETWEEN 0.05D AND 0.07D AND l_quantity < 24")
    return li.agg(half_up(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 1).alias("revenue"))


@plan.query("ext_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def ext_rollup(spark, d):
    return load(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@plan.query("ext_topk", "SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3")
def ext_topk(spark, d):
    """Three dearest lines of each supplier."""
    li = load(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice").distinct()
    w = W.partitionBy("l_suppkey").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber")
    return li.withColumn("k", F.row_number().over(w)).where("k <= 3").drop("k")


@plan.query("ext_windows", f"SELECT event_type, epoch_us(time_bucket(INTERVAL 1 hour, ts)) // 1000000 AS hour, count(*) AS n, {half_up_sql('sum(value)', 2)} AS total FROM events GROUP BY ALL")
def ext_windows(spark, d):
    """Tumbling windows over events."""
    g = load(spark, d, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), half_up(F.sum("value"), 2).alias("total"))
    return g.select("event_type", F.unix_seconds(F.col("w.start").cast("timestamp")).alias("hour"), "n", "total")


@plan.query("ext_sessions", "WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events), g AS (SELECT user_id, t, CASE WHEN t - lag(t) OVER w >= 1800000000 OR lag(t) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)), i AS (SELECT user_id, t, sum(s) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, count(DISTINCT k) AS sessions, count(*) AS events FROM i GROUP BY user_id")
def ext_sessions(spark, d):
    """Sessions with a gap of half an hour."""
    s = load(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").alias("n"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))
