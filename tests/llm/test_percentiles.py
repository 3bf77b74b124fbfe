import math
import random

import numpy as np
import pytest

from pagliaio.llm.percentiles import exact_percentiles, merge_summaries, multi_select, summarize


@pytest.mark.parametrize("finish, rounds", [(0.0, 5), (1 / 16, 4), (1.0, 0)])
def test_ranks_of_skewed_groups(spark, finish, rounds):
    rnd = random.Random(rounds)
    rows = [("hot", float(rnd.choice([1, 2, 5, rnd.gauss(0, 100)]))) for _ in range(900)] + [("few", 3.0)] * 60 + [("x", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    by = {g: sorted(v for h, v in rows if h == g) for g in ("hot", "few", "x")}
    want = {(g, r): by[g][r] for g in by for r in {0, len(by[g]) // 3, len(by[g]) // 2, len(by[g]) - 1}}
    targets = spark.createDataFrame([*want, ("hot", 10_000), ("none", 0)], "g string, rank long")
    stats = {}
    got = {(r.g, r.rank): r.value for r in multi_select(df, targets, finish, stats=stats).collect()}
    assert got == want and stats["rounds"] >= rounds and (rounds or not stats["rounds"])


def test_percentiles_with_nulls_and_clashing_names(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 4.0), (None, 7.0), ("b", None)]
    df = spark.createDataFrame(rows, "node string, g double").selectExpr("node", "g", "1 as v", "2 as rank", "3 as n")
    got = {(r.node, r.q): (r.value, r["n"]) for r in exact_percentiles(df, ["node"], "g", [0.0, 0.5]).collect()}
    assert got == {("a", 0.0): (1.0, 2), ("a", 0.5): (2.5, 2), (None, 0.0): (7.0, 1), (None, 0.5): (7.0, 1)}
    clash = {(r.v, r.value) for r in exact_percentiles(df, ["v", "rank"], "g", [0.0]).collect()}
    assert clash == {(1, 1.0)}
    assert exact_percentiles(df.where("false"), ["node"], "g", [0.5]).collect() == []


def test_merged_summaries_keep_the_bound(spark):
    rnd = random.Random(3)
    rows = [(f"day{rnd.randrange(4)}", "g", rnd.lognormvariate(0, 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "day string, grp string, x double")
    error, qs = 0.02, [0.01, 0.5, 0.9, 0.99]
    merged = merge_summaries(summarize(df, ["day", "grp"], "x", error), ["grp"], qs).collect()
    values = np.sort([r[2] for r in rows])
    for r in merged:
        rank = np.searchsorted(values, r.value)
        assert r["n"] == 3000 and abs(rank + 1 - math.ceil(r.q * 3000)) <= error * 3000 + 1
