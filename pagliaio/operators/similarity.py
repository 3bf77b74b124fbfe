"""Exact similarity join of 64-bit hashes."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.functions.text import hamming
from pagliaio.session import cut_lineage


def near_hashes(hashes: DataFrame, bits: str, distance: int, chunks: int | None = None) -> DataFrame:
    """``h1, h2, distance``: pairs of different hashes (h1 < h2) within ``distance`` bits.

    Of ``chunks`` chunks at least ``chunks - distance`` are equal, so the pairs meet in
    an equi-join on combinations of that many chunks: full recall, no cross join. Only
    distinct hashes are compared, so a hash that many rows hold costs nothing extra.
    More chunks make longer keys: 7 for distance 5 give keys of about 18 bits, 9 of 28. Where ``chunks`` isn't
    given there are as many as keep the hashes of a key few: the keys have at least as many bits as the number of hashes.
    """
    values = cut_lineage(hashes.select(F.col(bits).alias("h")).where(F.col("h").isNotNull()).distinct())
    if chunks is None:
        wanted = max(16, values.count().bit_length())
        chunks = next((c for c in range(distance + 2, 33) if (c - distance) * (64 // c) >= wanted), 32)
    need = chunks - distance
    if need < 1:
        raise ValueError("more chunks than the distance are needed")
    edges = [round(i * 64 / chunks) for i in range(chunks + 1)]
    part = [F.call_function("shiftrightunsigned", F.col("h"), F.lit(64 - b)).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    keys = F.array(*[F.xxhash64(F.lit(k), *[part[i] for i in combo]) for k, combo in enumerate(combinations(range(chunks), need))])
    keyed = values.select("h", F.explode(keys).alias("key"))
    pairs = keyed.select(F.col("h").alias("h1"), "key").join(keyed.select(F.col("h").alias("h2"), "key"), "key").where("h1 < h2")
    d = hamming(F.col("h1"), F.col("h2"))
    return pairs.where(d <= distance).select("h1", "h2", d.alias("distance")).distinct()
