"""Order-dependent clustering and matching inside bounded blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_fit(rows: DataFrame, block: list[str], order: list[str], fields: dict[str, float], threshold: int, most_rows: int = 100_000) -> DataFrame:
    """``block..., id, leader``: each row joins the first group of its block whose first row it scores against.

    Rows are taken in ``order``; a row scores one for each numeric field of
    ``fields`` within its relative tolerance. The outcome depends on the order, so a
    block is one task by nature: blocks above ``most_rows`` are refused rather than
    cut; choose a finer block for them.
    """
    largest = rows.groupBy(*block).count().agg(F.max("count")).first()[0] or 0
    if largest > most_rows:
        raise ValueError(f"a block has {largest} rows; first fit needs blocks of at most {most_rows}")
    names = list(fields)
    tolerance = np.array([fields[n] for n in names])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        values = pdf[names].to_numpy(dtype=float)
        leaders: list[int] = []
        owner = []
        for i in range(len(pdf)):
            hit = None
            if leaders:
                a, b = values[leaders], values[i]
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = (np.abs(a - b) / np.maximum(np.abs(a), np.abs(b)) <= tolerance).sum(axis=1)
                good = np.flatnonzero(score >= threshold)
                hit = leaders[good[0]] if len(good) else None
            if hit is None:
                leaders.append(i)
                hit = i
            owner.append(pdf["id"].iloc[hit])
        return pdf[[*block, "id"]].assign(leader=owner)

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*block, "id"]) + f", leader {kinds['id']}"
    return rows.select(*dict.fromkeys([*block, "id", *order, *names])).groupBy(*block).applyInPandas(run, schema)


def one_to_one(pairs: DataFrame, distance: int) -> DataFrame:
    """``a, b, matched``: greedy one-to-one matching of two listings' pictures (columns a, b, hashes_a, hashes_b) in list order."""

    @F.pandas_udf("int")
    def match(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            free = [int(x) for x in b]
            n = 0
            for x in (int(x) for x in a):
                k = next((i for i, y in enumerate(free) if ((x ^ y) & (2**64 - 1)).bit_count() <= distance), None)
                if k is not None:
                    free.pop(k)
                    n += 1
            out.append(n)
        return pd.Series(out, dtype="int32")

    return pairs.select("a", "b", match("hashes_a", "hashes_b").alias("matched"))
