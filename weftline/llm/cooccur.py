"""Items that appear together: pair counts over baskets, and how far they exceed chance.

Ordinary baskets (at most ``chunk`` items) yield their pairs in one step. A
huge basket is split into chunks of that many items; each unordered pair of
chunks is a row of its own, spread over the tasks by a hash, and yields the
products of its two chunks. So no task ever holds more than chunk * chunk pairs
of one basket, and no pair is lost. Pairs are counted with map-side combination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.pairing import keyed_join, list_products
from ..session import cut

#: Items in a chunk: a row yields at most CHUNK * CHUNK pairs.
CHUNK = 256
#: At most so many huge baskets are broadcast, by their names alone; their number is counted first.
BROADCAST_BASKETS = 100_000
#: At most so many items that no pair can hold are broadcast, a few MB; their number is counted first.
BROADCAST_ITEMS = 200_000


def baskets(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct ``b``, ``x`` with neither NULL."""
    return df.select(df[basket].alias("b"), df[item].cast("bigint").alias("x")).where("b IS NOT NULL AND x IS NOT NULL").distinct()


def _fitting(held: DataFrame, per_item: DataFrame, fit: DataFrame, total: int) -> DataFrame:
    """The rows of ``held`` whose item is in ``fit``. Few unfit items are counted and broadcast; else hot items are, and the rows of the others are shuffled by item."""
    unfit = cut(per_item.select("x").join(fit.select("x"), "x", "left_anti"))
    if unfit.count() <= BROADCAST_ITEMS:
        return held.join(F.broadcast(unfit), "x", "left_anti")
    return keyed_join(held, fit.select("x", "n_x"), "x", "n_x", total, "left_semi")


def _pairs(held: DataFrame, sizes: DataFrame, chunk: int, total: int) -> DataFrame:
    """Every unordered pair of every basket, as ``i`` < ``j``; ``held`` is distinct (b, x), ``sizes`` has ``n`` >= the rows of each b."""
    # Items are dealt out to the basket's chunks by hash, so that huge baskets never pass through one task whole.
    # A basket's number of chunks depends on its size alone.
    many = cut(sizes.where(F.col("n") > chunk).select("b", F.ceil(F.col("n") / (chunk / 2)).cast("int").alias("chunks"), "n"))
    if many.count() <= BROADCAST_BASKETS:
        dealt = held.join(F.broadcast(many.drop("n")), "b", "left")
    else:
        dealt = keyed_join(held, many, "b", "n", total, "left")
    chunks = F.coalesce("chunks", F.lit(1))
    return list_products(dealt.select("b", "x", chunks.alias("chunks"), F.pmod(F.xxhash64("x"), chunks).cast("int").alias("c")), ("b",)).select("i", "j")


def associations(df: DataFrame, basket: str, item: str, min_pairs: int = 1, min_lift: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Pairs of items with the number of baskets that hold both and their scores.

    Returns ``i`` < ``j``, ``n_i``, ``n_j``, ``n_ij``, ``n`` (all baskets),
    ``lift`` (n_ij * n / (n_i * n_j)) and ``pmi`` (its logarithm), for pairs
    with n_ij >= ``min_pairs`` and lift >= ``min_lift``.

    Repeated (basket, item) rows count once; rows with a NULL in either don't
    count. Items that no such pair can hold are left out before pairing, which
    loses nothing: n_ij never exceeds n_i, so n_i must reach ``min_pairs``, and
    lift never exceeds n / n_i, so n_i must not exceed n / ``min_lift``. Empty
    tables and baskets of one item give no pairs.
    """
    held = cut(baskets(df, basket, item))
    per_item = cut(held.groupBy("x").agg(F.count(F.lit(1)).alias("n_x")))
    total = held.select("b").distinct().agg(F.count(F.lit(1)).alias("n"))
    fit = per_item.crossJoin(F.broadcast(total)).where((F.col("n_x") >= min_pairs) & (F.col("n_x") * min_lift <= F.col("n")))
    rows = held.count()
    pairs = _pairs(_fitting(held, per_item, fit, rows), held.groupBy("b").agg(F.count(F.lit(1)).alias("n")), chunk, rows)
    least, most = per_item.agg(F.min("x"), F.max("x")).first()
    if least is not None and most - least < 2**31:  # two items fit one number: less to shuffle and to hash
        packed = pairs.select((F.shiftleft(F.col("i") - least, 32) + F.col("j") - least).alias("ij")).groupBy("ij").agg(F.count(F.lit(1)).alias("n_ij"))
        counted = packed.select((F.shiftright("ij", 32) + least).alias("i"), (F.col("ij").bitwiseAND(2**32 - 1) + least).alias("j"), "n_ij")
    else:
        counted = pairs.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n_ij"))
    counted = counted.where(F.col("n_ij") >= min_pairs)
    scored = counted.join(fit.select(F.col("x").alias("i"), F.col("n_x").alias("n_i"), "n"), "i").join(fit.select(F.col("x").alias("j"), F.col("n_x").alias("n_j")), "j")
    lift = F.col("n_ij").cast("double") * F.col("n") / (F.col("n_i").cast("double") * F.col("n_j"))
    return scored.where(F.col("n_ij") * F.col("n") >= F.col("n_i") * F.col("n_j") * min_lift).select("i", "j", "n_i", "n_j", "n_ij", "n", lift.alias("lift"), F.log(lift).alias("pmi"))
