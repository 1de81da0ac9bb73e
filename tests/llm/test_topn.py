"""Top N per group by bisection."""

import random

import pytest

from weftline.llm import topn

SCHEMA = "item_i bigint, item_j bigint, score double, g string, j int"


def brute(rows, n):
    best = {}
    for i, j, s, *_ in rows:
        if i is not None and j is not None and s is not None and s == s and abs(s) != float("inf"):
            best[i, j] = max(s, best.get((i, j), s))
    out = set()
    for i in {k[0] for k in best}:
        own = sorted(((-s, j) for (a, j), s in best.items() if a == i))[:n]
        out |= {(i, j, -s + 0.0, k + 1) for k, (s, j) in enumerate(own)}
    return out


def got(df, n, **more):
    return {(r.g, r.j, r.score + 0.0, r.rank_no) for r in topn.top_n(df, "item_i", "item_j", "score", n, **more).collect()}


@pytest.mark.parametrize("limit", [topn.BROADCAST_GROUPS, 0])
def test_against_brute_force(spark, limit):
    rng = random.Random(3)
    values = [0.0, -0.0, 1e-308, 5e-324, -1e300, 1e300, 0.5, 0.5000000000000001, -2.5, float("nan"), float("inf"), None]
    rows = [(i, rng.randrange(-50, 400), rng.choice(values) if rng.random() < 0.6 else rng.random(), "x", 0) for i in (1, 1, 1, 2, 3, None) for _ in range(250)]
    rows += [(4, j, 0.25, "x", 0) for j in range(300)] + rows[:50] + [(5, None, 1.0, None, None), (6, 1, float("nan"), None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df, 20, broadcast_groups=limit) == brute(rows, 20)
    assert got(df.repartition(7), 1, broadcast_groups=limit) == brute(rows, 1)


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA), 20) == set()


def test_list_differences(spark):
    top = topn.top_n(spark.createDataFrame([(1, 7, 0.9, "", 0), (1, 8, 0.8, "", 0), (2, 9, 0.1, "", 0), (3, 4, 0.5, "", 0)], SCHEMA), "item_i", "item_j", "score", 20)
    lists = spark.createDataFrame([(1, [7]), (1, [7]), (2, None), (3, [4, 99]), (None, [1])], "item bigint, item_list array<bigint>")
    wrong = {(r.g, r.rank_no, r.j) for r in topn.list_differences(top, lists, "item", "item_list").collect()}
    assert wrong == {(1, 2, 8), (2, 1, 9)}


@pytest.mark.parametrize("limit", [topn.BROADCAST_GROUPS, 0])
def test_many_groups_and_a_hot_one(spark, limit):
    """Beyond what is broadcast: thousands of groups, most of them small, and one with a third of the rows."""
    df = spark.range(12_000).selectExpr(
        "if(id % 3 = 0, 0L, id % 2500) AS item_i", "id AS item_j", "cast(pmod(hash(id), 97) AS double) AS score", "'x' AS g", "0 AS size"
    )
    rows = [tuple(r) for r in df.collect()]
    assert got(df, 5, broadcast_groups=limit) == brute(rows, 5)
