"""Term frequencies and co-occurrence."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from weftline.llm import cooccur, termfreq


def test_terms(spark):
    rows = [(1, "a b  a\tc"), (1, " a b a c "), (2, "a　B"), (3, None), (4, " \n"), (5, ""), (None, "q q"), (None, "q q"), (6, "x_1,y")] + [(k, "hub hub") for k in range(10, 40)]
    df = spark.createDataFrame(rows, "walk bigint, path string").selectExpr("walk", "path", "0 AS term", "'z' AS id")
    got = {r.term: r for r in termfreq.term_frequencies(df, "walk", "path", 3, 2).collect()}
    assert {t: (r.occurrences, r.records, r.mark) for t, r in got.items()} == {
        "a": (3, 2, None), "b": (1, 1, "rare"), "c": (1, 1, "rare"), "B": (1, 1, "rare"), "q": (2, 1, "rare"), "x_1,y": (1, 1, "rare"), "hub": (60, 30, "common"),
    }
    assert sorted(r.id for r in got.values()) == list(range(7))
    assert termfreq.term_frequencies(df.limit(0), "walk", "path").count() == 0


def test_many_ranges_and_blocks(spark):
    """Ranges of 8 identifiers, blocks of a few records, and sums of two arrays at a time."""
    df = spark.range(100).selectExpr("id AS walk", "concat_ws(' ', transform(sequence(0, cast(id AS int)), x -> concat('n', x)), 'n0') AS path")
    for more in ({"width": 8}, {"block_chars": 300}, {"width": 8, "block_chars": 300, "fan_in": 2}):
        got = {r.term: (r.occurrences, r.records) for r in termfreq.term_frequencies(df, "walk", "path", **more).collect()}
        assert got == {f"n{k}": (100 - k + 100 * (k == 0), 100 - k) for k in range(100)}


def test_identifiers_beyond_16_bits(spark):
    df = spark.range(400).selectExpr("id AS walk", "concat_ws(' ', transform(sequence(0, 99), x -> concat('n', id * 100 + x)), 'hub') AS path")
    rows = termfreq.term_frequencies(df, "walk", "path").selectExpr("max(id)", "sum(occurrences)", "count(term)").first()
    assert tuple(rows) == (40_000, 40_400, 40_001)


def test_count_arrays():
    """Three records over identifiers 9, 4 and 7; the second record holds 4 twice."""
    ids, occurrences, records = termfreq.count_arrays(np.array([9, 4, 7]), np.array([0, 1, 1, 1, 2, 0]), np.array([2, 2, 2]))
    assert ids.tolist() == [4, 7, 9] and occurrences.tolist() == [3, 1, 2] and records.tolist() == [2, 1, 2]


@pytest.mark.parametrize("chunk, broadcast, apart", [(256, 100_000, 1), (4, 100_000, 1), (4, 0, 1), (1, 0, 1), (4, 0, 2**40)])
def test_pairs(spark, monkeypatch, chunk, broadcast, apart):
    """``apart``: items so far apart that two don't fit one number."""
    monkeypatch.setattr(cooccur, "BROADCAST_BASKETS", broadcast)
    monkeypatch.setattr(cooccur, "BROADCAST_ITEMS", broadcast)
    rng = random.Random(5)
    rows = [(f"u{rng.randrange(12)}", rng.randrange(30)) for _ in range(150)] + [("big", k) for k in range(40)] + [(None, 1), ("u1", None), ("alone", 77)]
    rows = [(u, i if i is None else (i - 3) * apart) for u, i in rows]
    df = spark.createDataFrame(rows + rows[:40], "user string, item bigint").selectExpr("*", "1 AS b", "2 AS x", "3 AS n")
    held = {(u, i) for u, i in rows if u is not None and i is not None}
    baskets = {}
    for u, i in held:
        baskets.setdefault(u, set()).add(i)
    both, single = Counter(p for s in baskets.values() for p in combinations(sorted(s), 2)), Counter(i for _, i in held)
    got = {(r.i, r.j): r for r in cooccur.associations(df, "user", "item", chunk=chunk).collect()}
    assert {k: r.n_ij for k, r in got.items()} == both
    for (i, j), r in got.items():
        assert r.n == len(baskets) and r.lift == pytest.approx(both[i, j] * len(baskets) / (single[i] * single[j]))
    few = {(r.i, r.j) for r in cooccur.associations(df, "user", "item", 2, 2, chunk).collect()}
    assert few == {k for k, n in both.items() if n >= 2 and n * len(baskets) >= 2 * single[k[0]] * single[k[1]]}


def test_no_pairs(spark):
    assert cooccur.associations(spark.createDataFrame([], "user string, item bigint"), "user", "item").count() == 0
