"""Keyed tables without a table format: upsert, insert-if-absent, observation of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(current: DataFrame, incoming: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``current`` with ``incoming`` rows put in or over it; of several incoming rows of a key the last in ``order`` wins.

    Whole rows are replaced: columns that ``incoming`` lacks become NULL. NULL keys
    are keys like others. One shuffle on the key; no collected groups.
    """
    both = current.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)), allowMissingColumns=True)
    rank = F.row_number().over(W.partitionBy(*key).orderBy(F.col("_in").desc(), *[o.desc_nulls_last() for o in order]))
    return both.withColumn("_rank", rank).where("_rank = 1").drop("_in", "_rank")


def insert_absent(current: DataFrame, incoming: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``current`` and those incoming rows whose key it lacks; the first in ``order`` wins inside ``incoming``."""
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*[o.asc_nulls_first() for o in order]))
    first = incoming.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return current.unionByName(first.join(current.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


def observed_changes(sightings: DataFrame, key: list[str], value: str, at: str) -> DataFrame:
    """``key..., at, event, value, previous``: what an observer logs sighting by sighting.

    The first sighting of a key is ``new`` (also without a value); later ones are
    ``change`` where the value and the last known value before it are both there and
    differ, else ``unchanged``.
    """
    w = W.partitionBy(*key).orderBy(at)
    rows = sightings.withColumn("previous", F.lag(value).over(w)).withColumn("_n", F.row_number().over(w))
    event = F.when(F.col("_n") == 1, "new").when(F.col(value).isNotNull() & F.col("previous").isNotNull() & (F.col(value) != F.col("previous")), "change").otherwise("unchanged")
    return rows.select(*key, at, event.alias("event"), value, "previous")
