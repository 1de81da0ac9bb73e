"""Top N items within every group by simultaneous bisection.

All groups are refined at once. A row's score becomes an order-preserving
64-bit code; ties are settled by a second code made of the identifier. Each
round cuts every open group's interval of codes into at most 257 parts by its
leading undecided bits, counts the rows of each part in one partially combined
aggregation, and keeps of each group only the part in which its N-th row lies.
A group closes as soon as its cutoff holds exactly N rows, after at most eight
rounds on the score and eight on the identifier. Groups of at most N rows never
take part. No task ever sorts a whole group: at the end at most N rows of a
group are left to rank.

A round reads the rows that were written last, and writes those still in
question only once they are a quarter of these. Bounds are broadcast while they
are few; beyond, those of hot groups are, and the other rows are shuffled by group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..operators.pairing import keyed_join
from ..session import cut

#: Bits that one round decides, i.e. 2 ** BITS midpoints for each open group.
BITS = 8
#: At most this many rows of bounds (under 100 bytes each) are broadcast; their number is counted first.
BROADCAST_GROUPS = 200_000

_LOWEST = -(2**63)


def code_of(scores: np.ndarray) -> np.ndarray:
    """The bits of doubles, with all but the sign turned over below zero: they order like the doubles themselves."""
    bits = (scores.astype("float64") + 0.0).view("int64")  # + 0.0: -0.0 and 0.0 are one score
    return bits ^ ((bits >> 63) & 0x7FFFFFFFFFFFFFFF)


@F.pandas_udf(LongType())
def _code(score: pd.Series) -> pd.Series:
    return pd.Series(code_of(score.to_numpy()))


def _bounded(rows: DataFrame, bounds: DataFrame, groups: int, limit: int, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with the bounds of their group; ``size`` of bounds says how many of ``total`` rows the group has."""
    if groups <= limit:
        return rows.join(F.broadcast(bounds.drop("size")), "g", how)
    return keyed_join(rows, bounds, "g", "size", total, how)


def top_n(df: DataFrame, group: str, item: str, score: str, n: int = 20, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """The ``n`` items of highest score of every group, exact and fully ordered.

    Returns ``g`` (the group), ``j`` (the item, bigint), ``score`` and
    ``rank_no`` from 1, by score descending, then item ascending.

    Rows count if group and item are not NULL and the score is a finite
    number. An (group, item) given several times counts once, with its highest
    score. A group of fewer than ``n`` items is returned whole; an empty table
    gives no rows. Other columns are never read.
    """
    s = df[score].cast("double")
    rows = df.select(df[group].alias("g"), df[item].cast("bigint").alias("j"), s.alias("s")).where(
        F.col("g").isNotNull() & F.col("j").isNotNull() & ~F.isnan("s") & (F.abs("s") < float("inf"))
    )
    best = rows.groupBy("g", "j").agg(F.max("s").alias("s"))
    base = cut(best.select("g", "j", "s", _code("s").alias("c1"), F.expr("~j").alias("c2")))
    sizes = cut(base.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("c1").alias("lo"), F.max("c1").alias("hi")))
    total, expected, groups = sizes.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("size", F.when(F.col("size") > n, F.col("size")), F.when(F.col("size") > n, 1)))).first()
    # phase 1 looks for the score's code c1, phase 2 for the identifier's code c2 among the rows whose c1 is cut1
    bounds = sizes.where(F.col("size") > n).select("g", "size", F.lit(1).alias("phase"), F.lit(n).cast("bigint").alias("need"), F.lit(_LOWEST).alias("cut1"), "lo", "hi")
    closed, held, written, open_groups = [], base.select("g", "j", "c1", "c2"), total, groups
    while open_groups:
        bounds = bounds.withColumn("shift", F.greatest(F.lit(0), F.expr(f"if(lo = hi, 0, length(bin(lo ^ hi))) - {BITS}")))
        x = F.when(F.col("phase") == 1, F.col("c1")).otherwise(F.col("c2"))
        candidates = (
            _bounded(held, bounds, open_groups, broadcast_groups, total)
            .where(((F.col("phase") == 1) | (F.col("c1") == F.col("cut1"))) & x.between(F.col("lo"), F.col("hi")))
            .select("g", "j", "c1", "c2", x.alias("x"), F.expr("shiftright(if(phase = 1, c1, c2), shift)").alias("part"))
        )
        if expected * 4 <= written:
            candidates = cut(candidates)
            held, written = candidates.select("g", "j", "c1", "c2"), expected
        counts = candidates.groupBy("g", "part").agg(
            F.count(F.lit(1)).alias("rows"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.min("c2").alias("lo2"), F.max("c2").alias("hi2")
        )
        above = F.sum("rows").over(Window.partitionBy("g").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        here = (
            counts.withColumn("above", above)
            .join(bounds.select("g", "size", "phase", "need", "cut1"), "g")
            .where((F.col("above") >= F.col("need")) & (F.col("above") - F.col("rows") < F.col("need")))
            .withColumn("rest", F.col("need") - F.col("above") + F.col("rows"))
        )
        here = cut(here)
        whole = F.col("rest") == F.col("rows")
        first = F.col("phase") == 1
        closed.append(
            here.where(whole).select("g", "size", F.when(first, F.col("lo")).otherwise(F.col("cut1")).alias("cut1"), F.when(first, F.lit(_LOWEST)).otherwise(F.col("lo")).alias("cut2"))
        )
        tied = first & (F.col("lo") == F.col("hi"))
        bounds = here.where(~whole).select(
            "g", "size",
            F.when(tied, F.lit(2)).otherwise(F.col("phase")).alias("phase"),
            F.col("rest").alias("need"),
            F.when(tied, F.col("lo")).otherwise(F.col("cut1")).alias("cut1"),
            F.when(tied, F.col("lo2")).otherwise(F.col("lo")).alias("lo"),
            F.when(tied, F.col("hi2")).otherwise(F.col("hi")).alias("hi"),
        )
        open_groups, expected = here.where(~whole).agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    kept = base
    if closed:
        cutoffs = closed[0]
        for more in closed[1:]:
            cutoffs = cutoffs.union(more)
        # rows of the groups that took no part have no cutoff and stay
        kept = _bounded(base, cut(cutoffs), groups, broadcast_groups, total, "left").where(
            F.col("cut1").isNull() | (F.col("c1") > F.col("cut1")) | ((F.col("c1") == F.col("cut1")) & (F.col("c2") >= F.col("cut2")))
        )
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("c1"), F.desc("c2")))
    return kept.select("g", "j", F.col("s").alias("score"), rank.alias("rank_no"))


def list_differences(top: DataFrame, lists: DataFrame, group: str, items: str) -> DataFrame:
    """Entries of ``top`` whose place in the published list holds another item or none.

    ``lists`` has one list per group, maybe repeated identically; of different
    lists for one group the least is compared. A NULL list, a list that is too
    short, a NULL place and a missing row all count as holding none. Returns
    ``g``, ``rank_no``, ``j``.
    """
    own = lists.select(lists[group].alias("g"), lists[items].alias("published")).where(F.col("g").isNotNull()).groupBy("g").agg(F.min("published").alias("published"))
    held = F.get("published", F.col("rank_no") - 1)
    return top.join(own, "g", "left").where(~held.eqNullSafe(F.col("j"))).select("g", "rank_no", "j")
