"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage


def row_hash(columns: list[str]) -> Column:
    """Canonical 64-bit hash of a row: NULL differs from every value, columns don't run together."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c).cast("string")]
    return F.xxhash64(*parts)


def snapshot_changes(
    sightings: DataFrame, key: list[str], values: list[str], run: str, at: str
) -> DataFrame:
    """Additions, removals and changes of every run against the run before it.

    ``sightings`` holds one or more rows per key and run; of several the one with
    the greatest ``at`` counts (equal instants: the greatest values). Each run is
    full-outer-joined with its predecessor on the key, and row hashes are compared.
    Returns ``key..., run, change_kind``; the first run has no rows.

    NULL keys are keys like others (null-safe join). Rows whose run is NULL belong
    to no snapshot and are left out. An empty input gives an empty result. Columns
    of the input other than those named are not read, so their names can't clash.
    """
    # One scan and one aggregation: keys and hashes are written once, both sides and the calendar read them.
    latest = cut_lineage(
        sightings.where(F.col(run).isNotNull())
        .select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.col(run).alias("run"), F.col(at).alias("at"), row_hash(values).alias("h"), F.struct(*values).alias("v"))
        .groupBy(*[f"k{i}" for i in range(len(key))], "run")
        .agg(F.max_by("h", F.struct("at", "v")).alias("h"))
    )
    # One row per run: bounded by the number of runs, not by the data.
    runs = latest.select("run").distinct()
    calendar = runs.groupBy().agg(F.array_sort(F.collect_set("run")).alias("r")).select(
        F.explode(F.arrays_zip(F.slice(F.col("r"), 1, F.greatest(F.size("r") - 1, F.lit(0))).alias("run"), F.slice(F.col("r"), 2, F.size("r")).alias("next"))).alias("c")
    ).select("c.run", "c.next")
    keys = [f"k{i}" for i in range(len(key))]
    before = latest.join(F.broadcast(calendar), "run").select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col("next").alias("b_run"), F.col("h").alias("b_h"))
    after = latest.join(F.broadcast(calendar.select(F.col("next").alias("run"))), "run", "left_semi")
    on = F.col("run") == F.col("b_run")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"b_{k}"))
    joined = after.join(before, on, "full_outer")
    kind = (
        F.when(F.col("b_run").isNull(), F.lit("added"))
        .when(F.col("run").isNull(), F.lit("removed"))
        .when(F.col("h") != F.col("b_h"), F.lit("changed"))
    )
    return (
        joined.withColumn("change_kind", kind)
        .where(F.col("change_kind").isNotNull())
        .select(
            *[F.when(F.col("run").isNull(), F.col(f"b_k{i}")).otherwise(F.col(f"k{i}")).alias(k) for i, k in enumerate(key)],
            F.coalesce("run", "b_run").alias(run),
            "change_kind",
        )
    )
