import random

import pytest

from pagliaio.llm.grouping import connected_groups, grid_side, small_key_links, star_links


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    return {x: find(x) for x in parent}


def groups(spark, edges, cell=250_000):
    df = spark.createDataFrame(edges, "u string, v string, member string, x int")
    return {r.member: r.group_id for r in connected_groups(df, most_edges=cell, least_edges=min(cell, 500)).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_chains_and_hubs(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"n{rnd.randrange(150)}", f"n{rnd.randrange(150)}") for _ in range(70)]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(80)]  # a chain in sorted order
    edges += [("hub", f"h{i}") for i in range(60)]
    edges += [(None, "a"), ("a", None), ("loop", "loop")] + edges[:10]
    rows = [(u, v, "clash", 1) for u, v in edges]
    assert groups(spark, rows) == groups(spark, rows, cell=20) == brute(edges)


def test_grid_follows_cores_and_edges():
    assert [grid_side(n, 12) for n in (0, 400, 3_800, 38_000, 10**7, 10**10)] == [1, 1, 3, 4, 7, 200]


def test_empty_and_loops_only(spark):
    assert groups(spark, []) == {}
    assert groups(spark, [("a", "a", None, None)]) == {}


def test_links_of_small_and_large_keys(spark):
    rows = [("two", "a"), ("two", "b"), ("two", "a"), ("one", "a"), (None, "z"), ("two", None)] + [("big", f"m{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "k string, m string")
    assert {(r.u, r.v) for r in small_key_links(df, "k", "m", 3).collect()} == {("a", "b")}
    got = {r.member: r.group_id for r in connected_groups(star_links(df, "k", "m", salts=4)).collect()}
    assert got == {"a": "a", "b": "a"} | {f"m{i}": "m0" for i in range(9)}
