"""Consolidating pairwise matches into groups: union-find on a two-dimensional grid.

Vertices are hashed into ``n`` blocks; an edge lives in the cell (row block of one
end, column block of the other). A round does three things:

1. *Local union-find.* Every cell streams its edges through a union-find whose
   state is bounded by the vertices of its two blocks, never by its edges. It
   reports each vertex with its cell representative.
2. *Exchange.* A vertex that lies in several cells of its row and column takes the
   least of their representatives; the others become the edges of the next round.
3. Only representatives go on, so the edge set shrinks geometrically; it is empty
   when all parents are stable. Vertices are ordered by a hash, which keeps chains
   that arrive in sorted order from shrinking by one vertex a round.

Afterwards the parents found in the rounds are composed from the last to the
first. The driver sees counts only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage, shuffle_width

#: Edges that a cell holds at most, and at least before the grid gets another one: between the two there
#: are as many cells as the session has shuffle partitions, so every core has one.
MOST_EDGES, LEAST_EDGES = 250_000, 500


def grid_side(edges: int, width: int, most: int = MOST_EDGES, least: int = LEAST_EDGES) -> int:
    """Blocks of vertices: their square is the number of cells."""
    return max(1, math.ceil(math.sqrt(max(edges / most, min(width, edges / least)))))


def _order_key(col: str):
    """Exact vertex name in hashed order: a 32-bit hash in hex, then the name itself."""
    return F.concat(F.lpad(F.hex(F.xxhash64(F.col(col)).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"), F.col(col))


def _local_union_find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids: dict[str, int] = {}
    names: list[str] = []
    parent: list[int] = []

    def number(name: str) -> int:
        k = ids.get(name)
        if k is None:
            k = ids[name] = len(names)
            names.append(name)
            parent.append(k)
        return k

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch["u"], batch["v"]):
            a, b = find(number(u)), find(number(v))
            if a != b:
                if names[a] < names[b]:
                    parent[b] = a
                else:
                    parent[a] = b
    for start in range(0, len(names), 100_000):
        part = range(start, min(start + 100_000, len(names)))
        yield pd.DataFrame({"x": [names[i] for i in part], "r": [names[find(i)] for i in part]})


def connected_groups(edges: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 60, most_edges: int = MOST_EDGES, least_edges: int = LEAST_EDGES) -> DataFrame:
    """``member, group_id``: every linked vertex with the least member of its group.

    Edges may repeat, loop and run in either direction. Rows with a NULL end link
    nothing and are left out; a vertex whose only edges are loops forms no group.
    Names are compared as strings; other columns of ``edges`` are ignored. Empty
    input gives an empty result. A vertex that takes part in a third of all edges
    is spread over a whole row of the grid by its partners' blocks.
    """
    spark = edges.sparkSession
    current = cut_lineage(
        edges.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(_order_key("a").alias("u"), _order_key("b").alias("v"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    )
    count = current.count()
    parents: list[DataFrame] = []
    while count:
        if len(parents) == max_rounds:
            raise RuntimeError(f"parents are not stable after {max_rounds} rounds")
        blocks = grid_side(count, shuffle_width(spark), most_edges, least_edges)
        block = lambda c: F.pmod(F.hash(c), F.lit(blocks))
        # The partition is the cell: one task has exactly one.
        cells = current.repartitionById(blocks * blocks, block("u") * blocks + block("v"))
        local = cut_lineage(cells.mapInPandas(_local_union_find, "x string, r string"))
        best = cut_lineage(local.groupBy("x").agg(F.min("r").alias("p")))
        parents.append(best.where(F.col("p") != F.col("x")))
        # Both ends of every (vertex, cell representative) pair step to their parents: the
        # image keeps exactly the old connections, and settled vertices leave as loops.
        image = local.join(best, "x").select("p", "r").where(F.col("p") != F.col("r")).distinct()
        image = image.unionByName(parents[-1].select("p", F.col("p").alias("r")).distinct())
        up = best.select(F.col("x").alias("r"), F.col("p").alias("q"))
        current = cut_lineage(
            image.join(up, "r").where(F.col("p") != F.col("q")).select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct()
        )
        count = current.count()
    if not parents:
        return spark.createDataFrame([], "member string, group_id string")
    resolved = parents[-1]
    for earlier in reversed(parents[:-1]):
        follow = resolved.select(F.col("x").alias("p"), F.col("p").alias("_root"))
        settled = resolved.join(earlier.select("x"), "x", "left_anti")
        resolved = cut_lineage(earlier.join(follow, "p", "left").select("x", F.coalesce("_root", "p").alias("p")).unionByName(settled))
    name = lambda c: F.substr(F.col(c), F.lit(9))
    members = resolved.select(name("x").alias("member"), F.col("p").alias("root")).unionByName(
        resolved.select(name("p").alias("member"), F.col("p").alias("root"))
    ).distinct()
    least = members.groupBy("root").agg(F.min("member").alias("group_id"))
    return members.join(least, "root").select("member", "group_id")


def star_links(members: DataFrame, key: str, member: str, salts: int = 64) -> DataFrame:
    """``u, v``: links that join all members of each key, without a hub for large keys.

    Members are tied to the least member of their salt, and those to the least of
    the key: two partial aggregations, and no vertex with more than ``salts`` plus
    one salt's members as partners.
    """
    salted = members.where(F.col(key).isNotNull() & F.col(member).isNotNull()).select(
        F.col(key).alias("k"), F.col(member).alias("m"), F.pmod(F.hash(member), F.lit(salts)).alias("s")
    ).distinct()
    hubs = salted.groupBy("k", "s").agg(F.min("m").alias("hub"))
    tops = hubs.groupBy("k").agg(F.min("hub").alias("top"))
    low = salted.join(hubs, ["k", "s"]).select(F.col("hub").alias("u"), F.col("m").alias("v"))
    high = hubs.join(tops, "k").select(F.col("top").alias("u"), F.col("hub").alias("v"))
    return low.unionByName(high).where(F.col("u") != F.col("v"))


def small_key_links(members: DataFrame, key: str, member: str, most: int) -> DataFrame:
    """Links among the members of keys that 2 to ``most`` distinct members hold; larger keys link none.

    The distinct members per key are counted by partial aggregation. Keys that hold
    more than a thousandth of all pairs are fewer than a thousand, so those above
    ``most`` are broadcast and dropped before the join; what is left is not hot.
    """
    pairs = cut_lineage(members.where(F.col(key).isNotNull() & F.col(member).isNotNull()).select(F.col(key).alias("k"), F.col(member).alias("m")).distinct())
    sizes = cut_lineage(pairs.groupBy("k").agg(F.count("*").alias("n"), F.min("m").alias("u")))
    hot_from = max(most, pairs.count() // 1000)
    hot = sizes.where(F.col("n") > hot_from).select("k")
    rest = pairs.join(F.broadcast(hot), "k", "left_anti")
    return rest.join(sizes.where(F.col("n").between(2, most)), "k").select("u", F.col("m").alias("v")).where(F.col("u") != F.col("v"))
