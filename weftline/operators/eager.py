"""Per-key results over tables in which a few keys own most rows.

A join of two skewed inputs multiplies their hot keys: a key with ``a`` rows on
one side and ``b`` on the other yields ``a * b`` joined rows in one task. The
aggregates asked of such a join can be computed without ever forming it. Both
inputs are aggregated by the join key first (Spark combines on the map side, so
a hot key arrives as one small row per task), the compact states are joined one
row to one row, and the joined counts and sums follow algebraically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(value: Column) -> Column:
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def key_state(df: DataFrame, key: str, value: str | None, prefix: str) -> DataFrame:
    """One row per key (NULL included): row count, finite-value count and sum."""
    rows = df.select(
        df[key].cast("string").alias("key_value"),
        (_finite(df[value]) if value else F.lit(None).cast("double")).alias("v"),
    )
    return rows.groupBy("key_value").agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.count("v").alias(f"{prefix}_values"),
        F.sum("v").alias(f"{prefix}_sum"),
    )


def eager_join_aggregate(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_value: str | None = None, right_value: str | None = None
) -> DataFrame:
    """Aggregates per key of ``left`` FULL OUTER JOIN ``right`` on the key.

    Returns one row per key of either side: ``key_value`` (the key as string),
    ``left_rows``, ``left_values``, ``left_sum``, the same for ``right``, and of
    the inner join ``joined_rows``, ``joined_left_sum``, ``joined_right_sum``
    and ``joined_product_sum`` (the sum of left value x right value).

    NULL keys keep their own row per side and join nothing, as in SQL. NULL,
    NaN and infinite values count as rows but not in sums; a sum without any
    value is 0. Repeated rows count as often as they occur. Empty inputs give
    no rows. Only the named columns are read, so other columns may have any
    name.
    """
    a, b = key_state(left, left_key, left_value, "left"), key_state(right, right_key, right_value, "right")
    states = a.join(b, "key_value", "full_outer").fillna(0)
    return states.select(
        "key_value", "left_rows", "left_values", "left_sum", "right_rows", "right_values", "right_sum",
        (F.col("left_rows") * F.col("right_rows")).alias("joined_rows"),
        (F.col("left_sum") * F.col("right_rows")).alias("joined_left_sum"),
        (F.col("right_sum") * F.col("left_rows")).alias("joined_right_sum"),
        (F.col("left_sum") * F.col("right_sum")).alias("joined_product_sum"),
    )


def overloaded_keys(states: DataFrame, left: DataFrame, right: DataFrame, left_name: str, right_name: str, one_in: int = 200) -> DataFrame:
    """Keys that own at least one row in ``one_in`` of their table.

    ``states`` is what :func:`eager_join_aggregate` returned for the two
    tables. All rows of a table count in its total, rows with a NULL key
    included; a NULL key is never named. The totals are counts without columns,
    which Parquet answers from its footers.
    """
    totals = left.agg(F.count(F.lit(1)).alias("left_total")).crossJoin(right.agg(F.count(F.lit(1)).alias("right_total")))
    sides = F.array(
        F.struct(F.lit(left_name).alias("field_name"), F.col("left_rows").alias("n"), F.col("left_total").alias("total")),
        F.struct(F.lit(right_name).alias("field_name"), F.col("right_rows").alias("n"), F.col("right_total").alias("total")),
    )
    return (
        states.where(F.col("key_value").isNotNull())
        .crossJoin(F.broadcast(totals))  # exactly one row
        .select("key_value", F.explode(sides).alias("s"))
        .where((F.col("s.n") > 0) & (F.col("s.n") * one_in >= F.col("s.total")))
        .select("s.field_name", "key_value")
    )


def roll_up(states: DataFrame, group: Column, name: str = "group_name") -> DataFrame:
    """Sums of the joined aggregates by any function of the key."""
    sums = ("left_rows", "right_rows", "joined_rows", "joined_left_sum", "joined_right_sum", "joined_product_sum")
    return states.groupBy(group.alias(name)).agg(*(F.sum(c).alias(c) for c in sums))
