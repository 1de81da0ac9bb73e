"""Weighted graphs and the transition probabilities of their random walks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def build_graph(df: DataFrame, directed: bool = True, weighted: bool = True, degree: int = 30) -> DataFrame:
    """``src``, ``dst``, ``weight`` from columns 0, 1 and (weighted) 2.

    Equal triples count once; an undirected graph gets every edge in both
    directions. Of each node's edges the ``degree`` heaviest stay (ties: least
    dst), each direction by itself. Edges that then still run in parallel add
    up, which leaves the walk's distribution as it was. Rows with a NULL end or
    weight, or a weight not above 0, go. Empty input gives an empty graph.
    """
    names = df.columns
    edges = df.select(
        df[names[0]].cast("string").alias("src"), df[names[1]].cast("string").alias("dst"), (df[names[2]].cast("double") if weighted else F.lit(1.0)).alias("weight")
    ).where("src IS NOT NULL AND dst IS NOT NULL AND weight > 0 AND NOT isnan(weight)")
    if not directed:
        ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
        edges = edges.select(F.explode(ends).alias("e"), "weight").select("e.src", "e.dst", "weight")
    place = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("weight"), "dst"))
    capped = edges.distinct().withColumn("place", place).where(F.col("place") <= degree)
    return capped.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def node_transitions(graph: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``prob``: the first hop; a node has at most ``degree`` rows."""
    return graph.select("src", "dst", (F.col("weight") / F.sum("weight").over(Window.partitionBy("src"))).alias("prob"))


def edge_transitions(graph: DataFrame, p: float = 1.0, q: float = 1.0) -> DataFrame:
    """``prev``, ``cur``, ``nxt``, ``prob``: a later hop, given the one before.

    The weight of an edge back to ``prev`` is divided by ``p``; one to another
    out-neighbour of ``prev`` stays; any other is divided by ``q``. Edges into a
    node without out-edges have no row.
    """
    first = graph.select(F.col("src").alias("prev"), F.col("dst").alias("cur"))
    second = graph.select(F.col("src").alias("cur"), F.col("dst").alias("nxt"), "weight")
    known = graph.select(F.col("src").alias("prev"), F.col("dst").alias("nxt"), F.lit(True).alias("near"))
    weight = F.when(F.col("nxt") == F.col("prev"), F.col("weight") / p).when(F.col("near"), F.col("weight")).otherwise(F.col("weight") / q)
    steps = first.join(second, "cur").join(known, ["prev", "nxt"], "left").select("prev", "cur", "nxt", weight.alias("weight"))
    return steps.select("prev", "cur", "nxt", (F.col("weight") / F.sum("weight").over(Window.partitionBy("prev", "cur"))).alias("prob"))
