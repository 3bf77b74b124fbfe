"""Writers: ordered CSV and JSON exports, partition replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, order: list[Column | str]) -> None:
    """One sorted CSV with a header. The file is single by its purpose, a report."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_deterministic(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """CSV and JSON side by side in fixed columns and total order: two runs write the same bytes."""
    rows = df.select(*columns).orderBy(*order, *[c for c in columns if c not in order]).coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    rows.select(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(f"{path}/json")


def replace_partitions(df: DataFrame, path: str, partition: list[str]) -> None:
    """Delete-then-insert of exactly the partitions that ``df`` brings; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
