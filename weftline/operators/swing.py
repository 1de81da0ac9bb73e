"""Swing: two items are alike if pairs of users who share little else share both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .pairing import list_products, self_join

#: Common items of two users in one chunk.
LIST_CHUNK = 512


def cap_users(rows: DataFrame, most: int | None = 800, seed: int = 7) -> DataFrame:
    """``u``, ``i`` with at most ``most`` users of each item, chosen by a seeded hash: the same ones however the data lie."""
    if most is None:
        return rows.select("u", "i")
    chance = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("u").cast("string"), F.col("i").cast("string")))
    place = F.row_number().over(Window.partitionBy("i").orderBy("chance", "u"))
    return rows.select("u", "i", chance.alias("chance")).withColumn("place", place).where(F.col("place") <= most).select("u", "i")


def swing(rows: DataFrame, max_user: int | None = 800, seed: int = 7, chunk: int = LIST_CHUNK) -> DataFrame:
    """``item_i``, ``item_j``, ``score`` in both directions: the sum over pairs of users of both items of 1 / (1 + their common items).

    ``rows``: ``u``, ``i``, unique. Every pair of users gets the list of its
    common items once; the list yields the pairs of items, so the triples of two
    items and two users are never joined. Pairs of one common item yield none.
    The cap bounds the pairs of users that an item makes; without one, the users
    of a hot item meet in chunks. Two users with more than ``chunk`` items each
    may share very many: their common items are dealt out to chunks, and no row
    yields more than the products of two chunks.
    """
    held = cut(cap_users(rows, max_user, seed))
    heavy = held.groupBy("u").agg(F.count(F.lit(1)).alias("items")).where(F.col("items") > chunk)  # few users, or none
    held = held.join(heavy, "u", "left")
    met = self_join(held, "i", "u", ("items",))
    common = met.where("items_a IS NULL OR items_b IS NULL").groupBy("a", "b").agg(F.sort_array(F.collect_list("i")).alias("xs")).where(F.size("xs") > 1)
    within = F.flatten(F.expr("transform(xs, (x, k) -> transform(slice(xs, k + 2, size(xs)), y -> struct(x AS i, y AS j)))"))
    each = common.select(F.explode(within).alias("p"), (1.0 / (1.0 + F.size("xs"))).alias("w")).select("p.i", "p.j", "w")
    scores = each.unionByName(_of_heavy_users(held.where("items IS NOT NULL"), chunk)).groupBy("i", "j").agg(F.sum("w").alias("score"))
    both = F.array(F.struct(F.col("i").alias("item_i"), F.col("j").alias("item_j")), F.struct(F.col("j").alias("item_i"), F.col("i").alias("item_j")))
    return scores.select(F.explode(both).alias("p"), "score").select("p.item_i", "p.item_j", "score")


def _of_heavy_users(held: DataFrame, chunk: int) -> DataFrame:
    """``i``, ``j``, ``w`` of all pairs of users with many items each."""
    met = self_join(held.select("i", "u"), "i", "u").select("a", "b", F.col("i").alias("x"))
    shared = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / (chunk / 2)).cast("int")
    dealt = met.join(shared, ["a", "b"]).select("a", "b", "n", "x", chunks.alias("chunks"), F.pmod(F.xxhash64("x"), chunks).cast("int").alias("c"))
    return list_products(dealt, ("a", "b", "n")).select("i", "j", (1.0 / (1.0 + F.col("n"))).alias("w"))
