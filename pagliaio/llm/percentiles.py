"""Percentiles of very large columns: distributed multi-select.

Every partition proposes the median of what is left of each group; the weighted
median of the proposals becomes the pivot; all rows are counted three ways against
it; ranges without a wanted rank are discarded; and so on until every wanted rank
is found. What is left of a group is sorted once it is down to a sixty-fourth of the
group. The results are exact order statistics. The rows left shrink by a constant
factor a round.

For combination over days or other portions, a portion's order statistics on a
grid of ``1/error`` ranks are its summary; merged summaries answer any percentile
with a rank error of at most ``error`` times the number of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage
from pagliaio.tables import BROADCAST_ROWS

#: A remainder is sorted once it is at most this share of its group, or at most so many rows (a task's worth),
#: whichever is less, and in any case when no more than the least number is left.
FINISH_SHARE, FINISH_MOST, FINISH_LEAST = 1 / 64, 100_000, 8


def _propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One proposal per group and partition: the weighted median of its batches' medians."""
    seen: dict[tuple, list[tuple[float, int]]] = {}
    for batch in batches:
        for key, v in batch.groupby(["g", "node"], sort=False)["v"]:
            a = v.to_numpy()
            k = (len(a) - 1) // 2
            seen.setdefault(key, []).append((float(np.partition(a, k)[k]), len(a)))
    rows = []
    for (g, node), medians in seen.items():
        medians.sort()
        weights = np.cumsum([w for _, w in medians])
        rows.append((g, node, medians[int(np.searchsorted(weights, (weights[-1] + 1) // 2))][0], int(weights[-1])))
    yield pd.DataFrame(rows, columns=["g", "node", "m", "w"])


def multi_select(values: DataFrame, targets: DataFrame, finish_share: float = FINISH_SHARE, max_rounds: int = 200, stats: dict | None = None) -> DataFrame:
    """``g, rank, value``: the ``rank``-th smallest (from 0) ``v`` of group ``g``.

    ``values`` has ``g string, v double`` without NULLs, ``targets`` ``g string, rank long``.
    Ranks outside the group give no row. Repeated values are counted, not searched.
    ``stats`` gets the number of pivot rounds.
    """
    spark = values.sparkSession
    key = ["g", "node"]
    rest = cut_lineage(values.select("g", F.lit("").alias("node"), "v"))
    sizes = rest.groupBy("g").agg(F.count("*").alias("n"))
    finish = F.greatest(F.least(F.col("n") * F.lit(finish_share), F.lit(FINISH_MOST)), F.lit(FINISH_LEAST)).cast("long").alias("finish")
    # Every open rank with the range (node) of its group that holds it, its rank in there and the range's rows.
    active = targets.select("g", "rank").distinct().join(sizes, "g").where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    active = cut_lineage(active.select("g", F.lit("").alias("node"), "rank", F.col("rank").alias("rel"), "n", finish))
    found = [spark.createDataFrame([], "g string, rank long, value double")]
    small = F.col("n") <= F.col("finish")
    for done in range(max_rounds):
        nodes, ending, going = active.agg(F.count_distinct("g", "node"), F.count_if(small), F.count_if(~small)).first()
        hint = F.broadcast if nodes <= BROADCAST_ROWS else lambda df: df
        if ending:
            order = Window.partitionBy(*key).orderBy("v")
            sorted_ = rest.join(hint(active.where(small).select(*key).distinct()), key, "left_semi").withColumn("rel", F.row_number().over(order).cast("long") - 1)
            found.append(cut_lineage(sorted_.join(hint(active.where(small)), [*key, "rel"]).select("g", "rank", F.col("v").alias("value"))))
        if not going:
            if stats is not None:
                stats["rounds"] = done
            return reduce(DataFrame.unionByName, found)
        live = active.where(~small)
        large = rest.join(hint(live.select(*key).distinct()), key, "left_semi")
        proposals = cut_lineage(large.mapInPandas(_propose, "g string, node string, m double, w long"))
        pivots = proposals.groupBy(*key).agg(F.expr("percentile(m, 0.5, w)").alias("p"))
        cut = large.join(hint(pivots), key)
        counts = cut.groupBy(*key).agg(F.first("p").alias("p"), F.count_if(F.col("v") < F.col("p")).alias("lt"), F.count_if(F.col("v") == F.col("p")).alias("eq"))
        aimed = cut_lineage(live.join(hint(counts), key))
        hit = (F.col("rel") >= F.col("lt")) & (F.col("rel") < F.col("lt") + F.col("eq"))
        found.append(aimed.where(hit).select("g", "rank", F.col("p").alias("value")))
        left, upto = F.col("rel") < F.col("lt"), F.col("lt") + F.col("eq")
        moved = aimed.where(~hit).withColumn("node", F.concat("node", F.when(left, "L").otherwise("R")))
        active = cut_lineage(moved.select("g", "node", "rank", F.when(left, F.col("rel")).otherwise(F.col("rel") - upto).alias("rel"), F.when(left, F.col("lt")).otherwise(F.col("n") - upto).alias("n"), "finish"))
        at = aimed.select(*key, "p").distinct()
        side = F.when(F.col("v") < F.col("p"), "L").when(F.col("v") > F.col("p"), "R")
        parted = large.join(hint(at), key).withColumn("side", side).where(F.col("side").isNotNull()).select("g", F.concat("node", "side").alias("node"), "v")
        rest = cut_lineage(parted.join(hint(active.select(*key).distinct()), key, "left_semi"))
    raise RuntimeError(f"not all ranks were found in {max_rounds} rounds")


def _encoded(groups: list[str]):
    """Group columns as one string that keeps NULL apart from every value."""
    return F.to_json(F.struct(*groups), {"ignoreNullFields": "false"})


def _values(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.select(_encoded(groups).alias("g"), v.alias("v"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(groups)]).where("v IS NOT NULL AND NOT isnan(v)")


def _sizes(data: DataFrame, groups: list[str]) -> tuple[DataFrame, list[str]]:
    keys = [f"k{i}" for i in range(len(groups))]
    return cut_lineage(data.groupBy("g").agg(F.count("*").alias("n"), *[F.first(k).alias(k) for k in keys])), keys


def exact_percentiles(df: DataFrame, groups: list[str], value: str, quantiles: list[float]) -> DataFrame:
    """``groups..., q, value, n``: percentiles with linear interpolation between the two ranks around ``(n-1)q``.

    NULL and NaN values are not counted; groups without a value give no row; NULL is a
    group like others. Values are compared as doubles.
    """
    data = cut_lineage(_values(df, groups, value))
    sizes, keys = _sizes(data, groups)
    wanted = sizes.select("g", "n", *keys, F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q"))
    wanted = wanted.withColumn("pos", (F.col("n") - 1) * F.col("q")).withColumn("lo", F.floor("pos").cast("long")).withColumn("hi", F.ceil("pos").cast("long"))
    targets = wanted.select("g", F.explode(F.array("lo", "hi")).alias("rank"))
    found = multi_select(data.select("g", "v"), targets)
    low = found.select("g", F.col("rank").alias("lo"), F.col("value").alias("v_lo"))
    high = found.select("g", F.col("rank").alias("hi"), F.col("value").alias("v_hi"))
    value_ = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.col("lo"))
    return wanted.join(low, ["g", "lo"]).join(high, ["g", "hi"]).select(*[F.col(k).alias(c) for k, c in zip(keys, groups)], "q", value_.alias("value"), "n")


def summarize(df: DataFrame, groups: list[str], value: str, error: float = 0.01) -> DataFrame:
    """``groups..., value, weight``: a mergeable summary, ``1/error`` exact order statistics per group with the rows each stands for."""
    step = int(round(1 / error))
    data = cut_lineage(_values(df, groups, value))
    sizes, keys = _sizes(data, groups)
    # Point j stands for the ranks up to end_j = ceil(j * n / step); small groups keep every value.
    ends = sizes.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(step)))).withColumn("end", F.ceil(F.col("j") * F.col("n") / step).cast("long"))
    ends = ends.groupBy("g", "end").agg(F.first("n").alias("n"), *[F.first(k).alias(k) for k in keys])
    ends = ends.withColumn("weight", F.col("end") - F.coalesce(F.lag("end").over(Window.partitionBy("g").orderBy("end")), F.lit(0)))
    found = multi_select(data.select("g", "v"), ends.select("g", (F.col("end") - 1).alias("rank")))
    return ends.withColumn("rank", F.col("end") - 1).join(found, ["g", "rank"]).select(*[F.col(k).alias(c) for k, c in zip(keys, groups)], "value", "weight")


def merge_summaries(summaries: DataFrame, groups: list[str], quantiles: list[float]) -> DataFrame:
    """``groups..., q, value, n``: percentiles of all portions from their summaries (columns groups, value, weight).

    The rank of ``value`` is off by at most the summaries' error times ``n``.
    """
    points = summaries.groupBy(*groups, "value").agg(F.sum("weight").alias("weight"))
    order = Window.partitionBy(*groups).orderBy("value")
    ranked = points.withColumn("upto", F.sum("weight").over(order)).withColumn("n", F.sum("weight").over(Window.partitionBy(*groups)))
    wanted = ranked.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
    reached = wanted.where(F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n"))))
    return reached.groupBy(*groups, "q").agg(F.min("value").alias("value"), F.first("n").alias("n"))
