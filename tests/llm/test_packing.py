"""Packing: nothing lost, nothing split without need, little room left."""

import random

import pytest

from weftline.llm import packing


def check(rows, items, capacities):
    for name, capacity in capacities.items():
        own = [r for r in rows if r.container == name]
        pieces, bins = {}, {}
        for r in own:
            pieces.setdefault(r.doc_id, []).append((r.piece_no, r.start, r.tokens))
            bins[r.bin] = bins.get(r.bin, 0) + r.tokens
        assert max(bins.values()) <= capacity
        assert set(pieces) == set(items)
        for doc, size in items.items():
            at = 0
            for k, (piece, start, tokens) in enumerate(sorted(pieces[doc])):
                assert (piece, start) == (k, at)
                at += tokens
            assert at == size and len(pieces[doc]) == -(-size // capacity)
        yield name, sum(bins.values()) / (len(bins) * capacity)


@pytest.mark.parametrize("part", [20_000, 100])
def test_pack(spark, part):
    rng = random.Random(1)
    items = {k: rng.choice([1, 5, 30, 200, 256, 700, 3000]) + rng.randrange(50) for k in range(3000)}
    sizes = spark.createDataFrame(list(items.items()), "doc bigint, tokens int")
    boxes = spark.createDataFrame([("s", 256), ("l", 2048), ("l", 2048), (None, 9), ("bad", 0), ("none", None)], "container string, capacity int")
    rows = packing.pack(sizes, boxes, part=part).collect()
    for name, used in check(rows, items, {"s": 256, "l": 2048}):
        assert used > 0.97, (name, used)


def test_empty(spark):
    sizes, boxes = spark.createDataFrame([], "doc bigint, tokens int"), spark.createDataFrame([("s", 4)], "container string, capacity int")
    assert packing.pack(sizes, boxes).count() == 0
    assert packing.pack(spark.createDataFrame([(1, 3)], "doc bigint, tokens int"), boxes.limit(0)).count() == 0


def test_sizes(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (None, "x"), (4, "a" * 100_000), (5, "日本語 <|endoftext|>")], "doc_id bigint, text string").selectExpr("*", "1 AS doc", "2 AS tokens")
    got = {r.doc: r.tokens for r in packing.token_sizes(df, "doc_id", "text").collect()}
    assert set(got) == {1, 4, 5} and 2 <= got[1] <= 4 and got[4] > 1000 and got[5] > 3


def test_best_fit():
    assert sorted(map(sorted, packing.best_fit([6, 4, 5, 5], 10))) == [[0, 1], [2, 3]]
    assert packing.best_fit([], 10) == []


def test_repeated_items(spark):
    """Two rows of one id are two items; their pieces never meet in a bin too small for both."""
    sizes = spark.createDataFrame([(1, 25), (1, 25), (1, 7), (2, 10), (2, 10)], "doc bigint, tokens int")
    rows = packing.pack(sizes, spark.createDataFrame([("s", 10)], "container string, capacity int")).collect()
    bins = {}
    for r in rows:
        bins[r.bin] = bins.get(r.bin, 0) + r.tokens
    assert sum(bins.values()) == 77 and max(bins.values()) <= 10 and len(rows) == 9 and len(bins) == 8


def test_rows_of_one_id_are_dealt_out(spark):
    """A third of all rows under one id: items of their own, in several parts, nothing lost."""
    sizes = spark.range(900).selectExpr("if(id % 3 = 0, 7L, id) AS doc", "cast(1 + id % 40 AS int) AS tokens")
    rows = packing.pack(sizes, spark.createDataFrame([("s", 64)], "container string, capacity int"), part=100).collect()
    bins = {}
    for r in rows:
        bins[r.bin] = bins.get(r.bin, 0) + r.tokens
    assert len(rows) == 900 and sum(r.doc_id == 7 for r in rows) == 301 and max(bins.values()) <= 64
    assert sum(bins.values()) == sum(1 + k % 40 for k in range(900)) and sum(bins.values()) / (64 * len(bins)) > 0.97


def test_many_containers_in_turns(spark):
    sizes = spark.createDataFrame([(k, 3 + k % 5) for k in range(30)], "doc bigint, tokens int")
    boxes = spark.createDataFrame([(f"c{k}", 10 + k) for k in range(9)], "container string, capacity int")
    rows = packing.pack(sizes, boxes, most_containers=2).collect()
    assert {name for name, _ in check(rows, {k: 3 + k % 5 for k in range(30)}, {f"c{k}": 10 + k for k in range(9)})} == {f"c{k}" for k in range(9)}
    assert {(r.container, r.doc_id, r.piece_no) for r in rows} == {(r.container, r.doc_id, r.piece_no) for r in packing.pack(sizes, boxes).collect()}
