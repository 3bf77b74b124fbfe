"""Exact quantiles of groups of any size: counts by bucket narrow the range of each rank until it can be sorted.

``percentile`` keeps every different value of a group in one task. Here a task keeps
at most ``BUCKETS`` counts for each range, and sorts at most ``FINISH_ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage
from pagliaio.tables import broadcast_if_small

BUCKETS, FINISH_ROWS = 512, 20_000


def _ranks(rows: DataFrame, wanted: DataFrame, finish_rows: int, max_rounds: int) -> DataFrame:
    """``g, rank, value`` of ``wanted`` (g, rank, lo, hi, rel, n): the rank lies in [lo, hi], at ``rel`` of its ``n`` rows."""
    found = []
    for _ in range(max_rounds):
        done = wanted.where("lo = hi")
        found.append(done.select("g", "rank", F.col("lo").alias("value")))
        wanted = cut_lineage(wanted.where("lo < hi"))
        short = F.col("n") <= finish_rows
        ending, going = wanted.agg(F.count_if(short), F.count_if(~short)).first()
        ranges = wanted.select("g", "lo", "hi", short.alias("short")).distinct()
        inside = lambda some: rows.join(broadcast_if_small(some), (rows["g"] == some["g"]) & (rows["v"] >= some["lo"]) & (rows["v"] <= some["hi"])).select(rows["g"], "v", "lo", "hi")
        if ending:
            order = Window.partitionBy("g", "lo", "hi").orderBy("v")
            sorted_ = inside(ranges.where("short")).withColumn("rel", F.row_number().over(order).cast("long") - 1)
            found.append(cut_lineage(wanted.where(short).join(sorted_, ["g", "lo", "hi", "rel"]).select("g", "rank", F.col("v").alias("value"))))
        if not going:
            out = found[0]
            for part in found[1:]:
                out = out.unionByName(part)
            return out
        bucket = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS), F.lit(BUCKETS - 1)).alias("bucket")
        counts = inside(ranges.where("NOT short")).groupBy("g", "lo", "hi", bucket).agg(F.count("*").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
        # At most BUCKETS rows a range.
        upto = F.sum("c").over(Window.partitionBy("g", "lo", "hi").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counts = counts.withColumn("upto", upto)
        hit = wanted.where(~short).join(counts, ["g", "lo", "hi"]).where((F.col("rel") >= F.col("upto") - F.col("c")) & (F.col("rel") < F.col("upto")))
        narrowed = hit.select("g", "rank", F.col("low").alias("lo"), F.col("high").alias("hi"), (F.col("rel") - F.col("upto") + F.col("c")).alias("rel"), F.col("c").alias("n"))
        wanted = cut_lineage(narrowed.unionByName(wanted.where(short & F.lit(False)).select("g", "rank", "lo", "hi", "rel", "n")))
    raise RuntimeError(f"not all quantiles were found in {max_rounds} rounds")


def quantiles(rows: DataFrame, groups: list[str], value: str, wanted: dict[str, float], finish_rows: int = FINISH_ROWS, max_rounds: int = 200) -> DataFrame:
    """``groups..., n, <name>...``: for each name the quantile with linear interpolation, as ``percentile`` gives it.

    NULL values don't count; a group of NULLs only has ``n`` = 0 and NULL quantiles, NULL is a group like others,
    and without ``groups`` there is one row. An empty table with groups gives no row.
    """
    names = [f"_g{i}" for i in range(len(groups))]
    keyed = rows.select(F.to_json(F.struct(*[F.col(c) for c in groups], F.lit(1)), {"ignoreNullFields": "false"}).alias("g"), *[F.col(c).alias(k) for c, k in zip(groups, names)], F.col(value).cast("double").alias("v"))
    keyed = cut_lineage(keyed)
    stats = cut_lineage(keyed.groupBy("g", *names).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    at = {name: (F.col("n") - 1) * F.lit(float(q)) for name, q in wanted.items()}
    ends = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in at.values()])))
    ranks = stats.where("n > 0").select("g", "lo", "hi", "n", F.explode(ends).alias("rank")).withColumn("rel", F.col("rank"))
    found = _ranks(keyed.select("g", "v").where("v IS NOT NULL"), ranks.select("g", "rank", "lo", "hi", "rel", "n"), finish_rows, max_rounds)
    # At most two ranks a quantile and group.
    by_rank = found.groupBy("g").agg(F.map_from_entries(F.collect_set(F.struct("rank", "value"))).alias("m"))
    out = stats.join(by_rank, "g", "left")
    value_of = lambda p: F.element_at("m", F.floor(p)) + (F.element_at("m", F.ceil(p)) - F.element_at("m", F.floor(p))) * (p - F.floor(p))
    result = out.select(*[F.col(k).alias(c) for k, c in zip(names, groups)], "n", *[F.when(F.col("n") > 0, value_of(p)).alias(name) for name, p in at.items()])
    if groups:
        return result
    return result.agg(F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("n"), *[F.max(name).alias(name) for name in wanted])
