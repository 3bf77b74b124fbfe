"""Structured Streaming: observation of sightings, keyed upsert, windows with late data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OBSERVED = "source string, source_id string, at timestamp, event string, price long, previous long"


def observe_stream(sightings: DataFrame) -> DataFrame:
    """Events of a stream of sightings (source, source_id, at, price): ``new`` for an unseen key, ``change`` where
    the last and the new price are there and differ.

    State per key: the last price and instant. A micro-batch is put in order of time
    inside the key; a sighting older than the state changes nothing.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["at", "price"], kind="stable")  # one key's rows of one micro-batch
        price, last = state.get if state.exists else (None, None)
        seen, out = state.exists, []
        for at, new in zip(rows["at"], rows["price"]):
            new = None if pd.isna(new) else int(new)
            stamp = at.value
            if seen and stamp <= last:
                continue
            if not seen:
                out.append((*key, at, "new", new, None))
            elif new is not None and price is not None and new != price:
                out.append((*key, at, "change", new, price))
            seen, price, last = True, new, stamp
        state.update((price, last))
        frame = pd.DataFrame(out, columns=["source", "source_id", "at", "event", "price", "previous"])
        yield frame.astype({"price": "Int64", "previous": "Int64"})

    return sightings.groupBy("source", "source_id").applyInPandasWithState(step, OBSERVED, "price long, last long", "append", GroupStateTimeout.NoTimeout)


def upsert_sink(path: str, key: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the latest row of each key in a versioned parquet table.

    Each batch writes version ``n`` from version ``n-1``; a batch that is replayed
    writes the same version again, so the result is exactly once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("_epoch", F.lit(epoch))
        if epoch > 0:
            rows = rows.unionByName(batch.sparkSession.read.parquet(f"{path}/v={epoch - 1}").withColumn("_epoch", F.lit(-1)), allowMissingColumns=True)
        rank = F.row_number().over(W.partitionBy(*key).orderBy(F.col(order).desc_nulls_last(), F.col("_epoch").desc()))
        rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_epoch").write.mode("overwrite").parquet(f"{path}/v={epoch}")

    return write


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Event time as an instant (files without a zone hold UTC) under a watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts and sums by type; data later than the watermark is left out."""
    return _timed(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return _timed(events, late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))


def deduplicated(events: DataFrame, key: str = "event_id", late: str = "10 minutes") -> DataFrame:
    """Repeated events dropped within the watermark, so the state stays bounded."""
    return _timed(events, late).dropDuplicatesWithinWatermark([key])
