"""Collaborative filtering: similarity of the entities that share neighbours, and top-N lists.

The pairs, by far the largest relation here, are not shuffled: the interaction
rows are, packed, to blocks of entities; a tile reads two of them. Only where an
entity owns more rows than a task can hold, the rows are paired by a join; what
belongs to one entity (its norm, its number of neighbours) is then put on the
rows before they are paired, and pairs are shuffled once, combined on the map side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tiles
from .pairing import CHUNK, self_join

FORMULAS = ("cosine", "jaccard", "jaccard-penalty")


def _mirrored(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair in one pass; ids as strings."""
    both = F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")), F.struct(F.col("b").alias("i"), F.col("a").alias("j")))
    return pairs.select(F.explode(both).alias("p"), "score").select(F.col("p.i").cast("string").alias("i"), F.col("p.j").cast("string").alias("j"), "score")


def cosine(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``i``, ``j``, ``score`` of every two entities that share a neighbour, in both directions.

    ``rows``: ``l``, ``x``, ``r``, unique by (l, x). Norms cover all rows of an
    entity. Entities of norm 0 have no cosine and no row. Empty input gives no
    rows.
    """
    pairs = tiles.scored(rows.select("l", "x", "r"), "cosine")
    return _mirrored(pairs) if pairs is not None else _joined_cosine(rows, chunk)


def _joined_cosine(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    norms = rows.groupBy("x").agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("norm")).where("norm > 0")
    scaled = rows.join(norms, "x").select("l", "x", (F.col("r") / F.col("norm")).alias("r"))
    pairs = self_join(scaled, "l", "x", ("r",), chunk)
    return _mirrored(pairs.groupBy("a", "b").agg(F.sum(F.col("r_a") * F.col("r_b")).alias("score")))


def jaccard(rows: DataFrame, penalty: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Shared neighbours over all neighbours of both; with ``penalty`` each shared one counts 1 / ln(1 + its own neighbours).

    ``rows``: ``l``, ``x``, unique. Columns as :func:`cosine`.
    """
    pairs = tiles.scored(_counted(rows, penalty), "jaccard")
    return _mirrored(pairs) if pairs is not None else _joined_jaccard(rows, penalty, chunk)


def _counted(rows: DataFrame, penalty: bool) -> DataFrame:
    """``l``, ``x`` and, with ``penalty``, what a shared ``l`` counts as ``r``."""
    held = rows.select("l", "x")
    return held.join(_weights(rows), "l").select("l", "x", F.col("w").alias("r")) if penalty else held


def _weights(rows: DataFrame) -> DataFrame:
    return rows.groupBy("l").agg((1.0 / F.log(1.0 + F.count(F.lit(1)))).alias("w"))


def _joined_jaccard(rows: DataFrame, penalty: bool = False, chunk: int = CHUNK) -> DataFrame:
    per_x = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    counted = rows.select("l", "x").join(per_x, "x")
    weight, payload = F.lit(1.0), ("n",)
    if penalty:
        counted = counted.join(_weights(rows), "l")
        weight, payload = F.col("w_a"), ("n", "w")
    pairs = self_join(counted, "l", "x", payload, chunk)
    sums = pairs.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("both"), F.sum(weight).alias("shared"))
    return _mirrored(sums.select("a", "b", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("both"))).alias("score")))


def similarity(rows: DataFrame, formula: str) -> DataFrame:
    """By the formula's name: cosine, jaccard or jaccard-penalty."""
    if formula == "cosine":
        return cosine(rows)
    if formula in FORMULAS:
        return jaccard(rows, penalty=formula == "jaccard-penalty")
    raise ValueError(f"formula: {formula}")


def candidates(rows: DataFrame, formula: str, n: int, slack: float = 0.0) -> DataFrame:
    """Those rows of :func:`similarity` among which are the ``n`` best of each ``i``, and all that are at most ``slack`` below: whatever scores rounded to half that may rank first."""
    if formula not in FORMULAS:
        raise ValueError(f"formula: {formula}")
    held = rows.select("l", "x", "r") if formula == "cosine" else _counted(rows, formula == "jaccard-penalty")
    lists = tiles.scored(held, "cosine" if formula == "cosine" else "jaccard", n, slack)
    if lists is None:
        return similarity(rows, formula)
    dealt = lists.select(F.col("a").cast("string").alias("i"), "b", "score").repartition("i")
    return dealt.select("i", F.explode(F.arrays_zip("b", "score")).alias("e")).select("i", F.col("e.b").cast("string").alias("j"), F.col("e.score").alias("score"))


def ranked(scores: DataFrame, n: int, i: str = "i", j: str = "j", score: str = "score") -> DataFrame:
    """The ``n`` rows of highest score of each ``i``, with ``rank_no`` from 1; ties by ``j``. A limit on the rank prunes before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(i).orderBy(F.desc(score), j))
    return scores.withColumn("rank_no", rank).where(F.col("rank_no") <= n)


def top_n(scores: DataFrame, n: int = 20, i: str = "i", j: str = "j", score: str = "score", id_name: str = "id", list_name: str = "rec_list") -> DataFrame:
    """One row per ``i``: its ``n`` best ``j`` in order."""
    lists = ranked(scores, n, i, j, score).groupBy(i).agg(F.sort_array(F.collect_list(F.struct("rank_no", F.col(j).alias("j")))).alias("ranked"))
    return lists.select(F.col(i).alias(id_name), F.col("ranked.j").alias(list_name))
