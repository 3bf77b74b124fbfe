import random
from statistics import quantiles as parts

import pytest
from pyspark.sql import functions as F

from pagliaio.operators.quantiles import quantiles


@pytest.mark.parametrize("finish", [3, 10_000])
def test_against_percentile(spark, finish):
    rnd = random.Random(finish)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 7.0, rnd.gauss(0, 1e6), rnd.random() * 1e-6])) for _ in range(900)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "n string, v double").selectExpr("n", "v", "1 as g", "2 as lo")
    want = {r[0]: tuple(r)[1:] for r in df.groupBy("n").agg(F.count("v"), F.percentile("v", 0.1), F.median("v"), F.percentile("v", 0.99)).collect()}
    got = {r[0]: tuple(r)[1:] for r in quantiles(df.withColumnRenamed("n", "key"), ["key"], "v", {"low": 0.1, "mid": 0.5, "high": 0.99}, finish_rows=finish).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][0] == w[0] and got[k][1:] == (pytest.approx(w[1:]) if w[0] else (None,) * 3)


def test_all_rows_and_none(spark):
    df = spark.range(1001).selectExpr("cast(id as double) as v")
    assert tuple(quantiles(df, [], "v", {"m": 0.5, "q": 0.25}, finish_rows=4).first()) == (1001, parts(range(1001), n=2, method="inclusive")[0], 250.0)
    assert tuple(quantiles(df.where("false"), [], "v", {"m": 0.5}).first()) == (0, None)
    assert quantiles(df.selectExpr("v", "1 as k").where("false"), ["k"], "v", {"m": 0.5}).collect() == []
