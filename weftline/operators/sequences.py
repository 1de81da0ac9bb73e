"""Item sequences for embedding training: length rules, vocabulary, subsampling, skip-gram pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_uniform
from ..session import cut


def build_sequences(df: DataFrame, key: str, item: str, *order: str, last: int | None = None) -> DataFrame:
    """``seq_id``, ``items``: each key's items by the order columns. Rows with a NULL key or item go.

    With ``last`` only the last so many rows of a key are gathered; the others
    are cut off before the shuffle, so a key of very many rows is no burden.
    """
    rows = df.where(df[key].isNotNull() & df[item].isNotNull())
    rows = rows.select(rows[key].alias("seq_id"), F.struct(*(rows[o].alias(f"o{k}") for k, o in enumerate(order)), rows[item].cast("string").alias("item")).alias("x"))
    if last is not None:
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("seq_id").orderBy(F.desc("x")))).where(F.col("place") <= last)
    return rows.groupBy("seq_id").agg(F.sort_array(F.collect_list("x")).alias("x")).select("seq_id", F.col("x.item").alias("items"))


def key_lists(df: DataFrame, key: str, item: str, *order: str) -> DataFrame:
    """``key``, ``values``: all items of each key, repeats included, as SQL's ``collect_list`` grouped by the key: the payload of a list store.

    NULL items are left out; a NULL key is a key. Items come by the order columns,
    if there are any, and by themselves, so the lists don't depend on partitions.
    """
    by = [df[o].alias(f"o{k}") for k, o in enumerate(order)]
    x = F.when(df[item].isNotNull(), F.struct(*by, df[item].alias("item")))
    return df.select(df[key].alias("key"), x.alias("x")).groupBy("key").agg(F.sort_array(F.collect_list("x")).alias("x")).select("key", F.col("x.item").alias("values"))


def truncate(seqs: DataFrame, min_len: int = 3, max_len: int | None = 200, side: str = "left") -> DataFrame:
    """Drops sequences below ``min_len``; of longer ones than ``max_len``, ``left`` keeps the last items, ``right`` the first, anything else all."""
    kept = seqs.where(F.size("items") >= min_len)
    if max_len is None or side not in ("left", "right"):
        return kept
    start = F.greatest(F.size("items") - max_len + 1, F.lit(1)) if side == "left" else F.lit(1)
    return kept.withColumn("items", F.slice("items", start, max_len))


def sequence_stats(seqs: DataFrame) -> DataFrame:
    """One row: ``num_seq`` and ``mean_len``, both 0 without sequences."""
    return seqs.agg(F.count(F.lit(1)).alias("num_seq"), F.coalesce(F.avg(F.size("items")), F.lit(0.0)).alias("mean_len"))


def item_counts(seqs: DataFrame) -> DataFrame:
    """``item``, ``cnt``."""
    return seqs.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))


def vocabulary(counts: DataFrame, min_count: int | None = 3, max_count: int | None = None, pool: DataFrame | None = None, pool_mode: str = "replace") -> DataFrame:
    """``item``, ``cnt``, ``ix`` (from 1, by count descending, then item; 0 is the replacement token).

    Without a pool, counts between the limits stay. A pool (``item``) either
    replaces the vocabulary (``replace``: limits don't matter, absent items count
    0) or narrows it (``intersect``).
    """
    kept = counts
    if pool is not None and pool_mode == "replace":
        kept = pool.select("item").distinct().join(counts, "item", "left").select("item", F.coalesce("cnt", F.lit(0)).alias("cnt"))
    else:
        if min_count is not None:
            kept = kept.where(F.col("cnt") >= min_count)
        if max_count is not None:
            kept = kept.where(F.col("cnt") <= max_count)
        if pool is not None:
            kept = kept.join(pool.select("item").distinct(), "item", "left_semi")
    return _numbered(kept)


def _numbered(kept: DataFrame) -> DataFrame:
    """Dense numbers in order. Rows are sorted over all tasks; each task numbers its own, and a row per task carries the numbers before it."""
    at = F.spark_partition_id().cast("bigint")
    placed = cut(kept.orderBy(F.desc("cnt"), "item").select("item", "cnt", at.alias("part"), F.monotonically_increasing_id().alias("place")))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    # the identifier is the task's number in the upper bits and the row's in the lower 33
    number = F.col("before") + F.col("place") - F.shiftleft("part", 33) + 1
    return placed.join(F.broadcast(offsets), "part").select("item", "cnt", number.alias("ix"))


def keep_probability(vocab: DataFrame, threshold: float = 1e-5) -> DataFrame:
    """``item``, ``keep``: sqrt(threshold / frequency) over the vocabulary; at 1 or more an item is never dropped."""
    total = vocab.agg(F.sum("cnt").alias("total"))
    return vocab.crossJoin(F.broadcast(total)).where("cnt > 0").select("item", "ix", F.sqrt(F.lit(threshold) * F.col("total") / F.col("cnt")).alias("keep"))


def positions(seqs: DataFrame) -> DataFrame:
    """``seq_id``, ``pos`` from 0, ``item``."""
    return seqs.select("seq_id", F.posexplode("items").alias("pos", "item"))


def index_sequences(seqs: DataFrame, vocab: DataFrame, mode: str = "replace") -> DataFrame:
    """``seq_id``, ``pos``, ``ix``: items outside the vocabulary become 0 (``replace``) or go (``remove``)."""
    found = positions(seqs).join(vocab.select("item", "ix"), "item", "left")
    if mode == "replace":
        return found.select("seq_id", "pos", F.coalesce("ix", F.lit(0)).cast("bigint").alias("ix"))
    place = F.row_number().over(Window.partitionBy("seq_id").orderBy("pos")) - 1
    return found.where(F.col("ix").isNotNull()).select("seq_id", place.alias("pos"), "ix")


def subsample(indexed: DataFrame, keep: DataFrame, seed: int = 7, mode: str = "replace", epoch: int = 0) -> DataFrame:
    """Keeps an item if a hash of (seed, epoch, sequence, place) is below its keep probability; dropped ones become 0 or go."""
    u = hash_uniform(seed, epoch, F.col("seq_id"), F.col("pos"))
    stays = F.coalesce(u < F.col("keep"), F.lit(mode == "replace"))
    rows = indexed.join(keep.select("ix", "keep"), "ix", "left").withColumn("stays", stays)
    if mode == "replace":
        return rows.select("seq_id", "pos", F.when(F.col("stays"), F.col("ix")).otherwise(0).cast("bigint").alias("ix"))
    place = F.row_number().over(Window.partitionBy("seq_id").orderBy("pos")) - 1
    return rows.where("stays").select("seq_id", place.alias("pos"), "ix")


def skip_grams(indexed: DataFrame, window: int | Column = 10, distinct_targets: bool = False, train_with_zero: bool = True) -> DataFrame:
    """``seq_id``, ``pos``, ``centre``, ``target`` of each place and its neighbours up to ``window`` away.

    ``window`` may be a column of ``indexed`` (see :func:`random_window`). With
    ``distinct_targets`` a place has each target once; without
    ``train_with_zero`` the replacement token is neither centre nor target.
    Neighbours come out of the sequence's own array: no join of places.
    """
    w = F.lit(window) if isinstance(window, int) else window
    rows = indexed.withColumn("w", w)
    seqs = rows.groupBy("seq_id").agg(F.sort_array(F.collect_list(F.struct("pos", "ix", "w"))).alias("x"))
    near = F.expr("filter(slice(x, greatest(k - c.w + 1, 1), c.w + least(k, c.w) + 1), y -> y.pos <> c.pos)")
    each = seqs.select("seq_id", "x", F.posexplode("x").alias("k", "c")).select("seq_id", F.col("c.pos").alias("pos"), F.col("c.ix").alias("centre"), F.explode(near).alias("t"))
    pairs = each.select("seq_id", "pos", "centre", F.col("t.ix").alias("target"))
    if not train_with_zero:
        pairs = pairs.where("centre <> 0 AND target <> 0")
    return pairs.distinct() if distinct_targets else pairs


def random_window(window: int, seed: int = 7, full: bool = False) -> Column:
    """A window for each place: uniform on 1 .. window - 1, or 1 .. window if ``full``."""
    most = window if full else window - 1
    if most < 1:
        raise ValueError(f"window: {window}")
    return (F.floor(hash_uniform(seed, F.col("seq_id"), F.col("pos")) * most) + 1).cast("int")


def shuffled(pairs: DataFrame, seed: int, *keys: str) -> DataFrame:
    """The rows in an order that depends only on seed and keys."""
    return pairs.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))), *keys)


def sample(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """``n`` rows without replacement: those of least hash, a distributed top n."""
    return df.withColumn("_order", F.md5(F.concat_ws("|", F.lit(str(seed)), df[key].cast("string")))).orderBy("_order", key).limit(n).drop("_order")
