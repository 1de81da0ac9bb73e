"""Typed interaction rows: who (user) did how much (rating) with what (item)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, column: str | int | None, place: int) -> Column:
    name = column if isinstance(column, str) else df.columns[place if column is None else column]
    return df[name]


def interactions(df: DataFrame, user: str | int | None = None, item: str | int | None = None, rating: str | int | None = None, with_rating: bool = True, dedupe: str = "sum") -> DataFrame:
    """``u``, ``i`` and, if wanted, ``r`` (double) from any table, by name or by position 0, 1, 2.

    Rows with a NULL in any of the columns go, as do NaN ratings. Repeated
    (user, item) rows become one: ``dedupe`` is ``sum``, ``max`` or
    ``distinct`` (the rows' ratings must then agree, else each stays).
    """
    columns = [_pick(df, user, 0).alias("u"), _pick(df, item, 1).alias("i")]
    if with_rating:
        columns.append(_pick(df, rating, 2).cast("double").alias("r"))
    rows = df.select(*columns).where(F.col("u").isNotNull() & F.col("i").isNotNull())
    if not with_rating or dedupe == "distinct":
        return rows.where(F.col("r").isNotNull() & ~F.isnan("r")).distinct() if with_rating else rows.distinct()
    rows = rows.where(F.col("r").isNotNull() & ~F.isnan("r"))
    if dedupe not in ("sum", "max"):
        raise ValueError(f"dedupe: {dedupe}")
    return rows.groupBy("u", "i").agg((F.sum if dedupe == "sum" else F.max)("r").alias("r"))


def roles(rows: DataFrame, model_type: str = "item") -> DataFrame:
    """``l`` and ``x``: similarity is between the ``x`` that share an ``l``. ``item`` compares items by users, ``user`` users by items."""
    if model_type == "item":
        return rows.withColumnsRenamed({"u": "l", "i": "x"})
    if model_type == "user":
        return rows.withColumnsRenamed({"i": "l", "u": "x"})
    raise ValueError(f"model type: {model_type}")
