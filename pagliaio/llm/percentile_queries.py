"""Queries of problem 4: percentiles of price and surface per comune."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagliaio.llm.percentiles import exact_percentiles, merge_summaries, summarize
from pagliaio.tables import broadcast_if_small, current_state, load

QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9]
ERROR = 0.01


def comune_key(col: str = "comune"):
    return F.regexp_replace(F.lower(F.trim(col)), r"\s+", "-")


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = current_state(load(spark, sf_dir, "listings"), ["comune", "price", "mq"])
    measures = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in ("price", "mq")]))
    return rows.select(comune_key().alias("comune"), "source", measures.alias("m")).select("comune", "source", "m.measure", "m.v")


def p4_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of price and mq per comune."""
    found = exact_percentiles(_measures(spark, sf_dir), ["comune", "measure"], "v", QUANTILES)
    return found.select("comune", "measure", "q", (F.floor(F.col("value") * 100e0 + 0.5e0) / 100e0).alias("value"), "n")


def p4_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same percentiles from summaries of each source, merged: rank error at most one per cent."""
    portions = summarize(_measures(spark, sf_dir), ["source", "comune", "measure"], "v", ERROR)
    return merge_summaries(portions, ["comune", "measure"], QUANTILES)


def p4_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each merged percentile keeps its bound: its rank among all values is off by one per cent at most."""
    measured = _measures(spark, sf_dir).where("v IS NOT NULL")
    merged = p4_merged(spark, sf_dir).select(F.col("comune").alias("c"), F.col("measure").alias("m"), "q", "value", "n")
    # A percentile a group: merged has five rows for each.
    both = measured.join(broadcast_if_small(merged), F.col("comune").eqNullSafe(F.col("c")) & (F.col("measure") == F.col("m")))
    ranks = both.groupBy("c", "m", "q", "n").agg(F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto"))
    wanted, slack = F.ceil(F.col("q") * F.col("n")), F.lit(ERROR) * F.col("n") + 1
    return ranks.select(F.col("c").alias("comune"), F.col("m").alias("measure"), "q", ((F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)).alias("within"))


QUERIES = {"p4_percentiles": p4_percentiles, "p4_merged": p4_merged, "p4_error": p4_error}

_STATE = """
        WITH l AS (SELECT * FROM listings WHERE source IS NOT NULL AND source_id IS NOT NULL
                   QUALIFY row_number() OVER (PARTITION BY source, source_id
                     ORDER BY TRY_CAST(fetched_at AS TIMESTAMPTZ) DESC NULLS LAST, comune DESC NULLS LAST, price DESC NULLS LAST, mq DESC NULLS LAST) = 1),
        k AS (SELECT regexp_replace(lower(trim(comune)), '\\s+', '-', 'g') AS comune, price, mq FROM l),
        m AS (SELECT comune, 'price' AS measure, CAST(price AS DOUBLE) AS v FROM k UNION ALL SELECT comune, 'mq', CAST(mq AS DOUBLE) FROM k)
        """

SQL = {
    "p4_percentiles": _STATE + " UNION ALL ".join(
        f"SELECT comune, measure, CAST({q} AS DOUBLE) AS q, floor(quantile_cont(v, {q}) * 100e0 + 0.5e0) / 100e0 AS value, count(v) AS n FROM m GROUP BY comune, measure HAVING count(v) > 0"
        for q in QUANTILES
    ),
    "p4_error": _STATE + f"SELECT comune, measure, unnest([{', '.join(f'CAST({q} AS DOUBLE)' for q in QUANTILES)}]) AS q, TRUE AS within FROM m GROUP BY comune, measure HAVING count(v) > 0",
}
