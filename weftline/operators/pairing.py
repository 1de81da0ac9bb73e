"""Pairs of the rows that share a key, and joins on keys of which a few own most rows.

A key with d rows makes about d * d pairs. Up to ``CHUNK`` rows that is work for
one task; a larger key's rows are dealt out to chunks by hash, and every pair of
chunks is a unit of its own, so no unit holds more than two chunks however
many rows the key has, and no pair is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key in one chunk of a self-join.
CHUNK = 4096
#: A key is hot if it owns at least one in so many rows; there are no more hot keys than that, so what belongs to them may be broadcast.
HOT_KEYS = 20_000


def chunks_of(rows: DataFrame, key: str, chunk: int = CHUNK) -> DataFrame:
    """``key``, ``chunks`` of the keys with more than ``chunk`` rows: few, or none."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("chunks")).where(F.col("chunks") > chunk).select(key, F.ceil(F.col("chunks") / chunk).cast("int").alias("chunks"))


def self_join(rows: DataFrame, key: str, item: str, payload: tuple[str, ...] = (), chunk: int = CHUNK, where: Column | None = None) -> DataFrame:
    """Every pair of rows of each key with ``a`` < ``b``: ``key``, ``a``, ``b`` (their items) and the payload columns with suffixes ``_a`` and ``_b``.

    ``rows`` is unique by (key, item). ``where`` is a further condition on the pairs.
    """
    dealt = rows.join(chunks_of(rows, key, chunk), key, "left").select(key, item, *payload, F.coalesce("chunks", F.lit(1)).alias("_chunks"))
    own = F.pmod(F.xxhash64(item), F.col("_chunks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    left = dealt.select(key, F.col(item).alias("a"), *(F.col(p).alias(f"{p}_a") for p in payload), own.alias("_c"), every.alias("_d"))
    right = dealt.select(key, F.col(item).alias("b"), *(F.col(p).alias(f"{p}_b") for p in payload), own.alias("_d"), every.alias("_c"))
    pairs = left.join(right, [key, "_c", "_d"]).where("a < b")
    return (pairs if where is None else pairs.where(where)).drop("_c", "_d")


def list_products(dealt: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Every unordered pair of items of each key, as ``keys``, ``i`` < ``j``.

    ``dealt`` is unique by (keys, ``x``) and has ``chunks``, the chunks of the
    key, and ``c``, the item's chunk from 0. Chunks should hold a few hundred
    items: one row yields the products of two of them.
    """
    lists = dealt.groupBy(*keys, "chunks", "c").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    within = F.flatten(F.expr("transform(xs, (v, k) -> transform(slice(xs, k + 2, size(xs)), w -> struct(v AS i, w AS j)))"))
    ordinary = lists.select(*keys, F.explode(within).alias("p"))
    # Chunk c goes to all pairs of chunks that it belongs to; where the other one holds no item, nothing meets it.
    big = lists.where(F.col("chunks") > 1)
    sent = big.select(*keys, "xs", "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("d")).where("c <> d")
    met = sent.groupBy(*keys, F.least("c", "d").alias("c1"), F.greatest("c", "d").alias("c2")).agg(
        F.min_by("xs", "c").alias("xs"), F.max_by("xs", "c").alias("ys"), F.count(F.lit(1)).alias("held")
    )
    across = F.flatten(F.expr("transform(xs, v -> transform(ys, w -> struct(least(v, w) AS i, greatest(v, w) AS j)))"))
    products = met.where("held = 2").select(*keys, F.explode(across).alias("p"))
    return ordinary.union(products).select(*keys, "p.i", "p.j")


def keyed_join(rows: DataFrame, lookup: DataFrame, key: str, size: str, total: int, how: str = "inner", hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined with ``lookup``, which has a row per key, among it ``size``: how many of ``total`` rows the key owns.

    What belongs to hot keys is broadcast, at most ``hot_keys`` rows of lookup;
    only rows of other keys are shuffled. ``how``: ``inner``, ``left`` or
    ``left_semi``. A NULL key meets nothing.
    """
    hot = F.col(size) * hot_keys >= total
    few, many = lookup.where(hot).drop(size), lookup.where(~hot).drop(size)
    near = rows.join(F.broadcast(few), key, "left_semi" if how == "left_semi" else "inner")
    far = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(many, key, how)
    return near.unionByName(far)
