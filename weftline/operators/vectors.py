"""Exact nearest neighbours over unit vectors, by squared Euclidean distance (2 - 2 cosine)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import unit

#: Queries that are sent to every task of the corpus, or that make a block; rows of the corpus in a piece that meets such blocks.
QUERY_BLOCK, PIECE = 8192, 16_384


def normalise(df: DataFrame, key: str, vector: str, place: str | None = None) -> DataFrame:
    """``id`` and the unit ``v`` (array<double>); rows without a direction (NULL, zero, not finite) go. Of equal ids any may answer a query. ``place``: a column that says in which order the rows are stored, kept under that name."""
    kept = [df[place].alias("place")] if place else []
    return df.select(df[key].alias("id"), unit(vector).alias("v"), *kept).where("id IS NOT NULL AND v IS NOT NULL")


def _nearest(queries: np.ndarray, keys: list, k: int, not_self: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            ids = batch["id"].to_numpy()
            corpus = np.stack(batch["v"].to_numpy())
            for at in range(0, len(keys), 1024):
                own = keys[at : at + 1024]
                distance = 2 - 2 * queries[at : at + 1024] @ corpus.T
                if not_self:
                    distance[np.asarray(own, dtype=object)[:, None] == ids.astype(object)[None, :]] = np.inf
                floor = np.partition(distance, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                r, c = np.nonzero((distance <= floor[:, None]) & np.isfinite(distance))
                yield pd.DataFrame({"query": [own[x] for x in r], "id": ids[c], "distance": distance[r, c]})

    return run


def _met(k: int, not_self: bool):
    def run(key: tuple, queries: pd.DataFrame, corpus: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or corpus.empty:
            return pd.DataFrame({"query": queries["id"][:0], "id": corpus["id"][:0], "distance": np.zeros(0)})
        return pd.concat(_nearest(np.stack(queries["v"].to_numpy()), queries["id"].tolist(), k, not_self)(iter([corpus])))

    return run


def nearest(corpus: DataFrame, queries: DataFrame, k: int = 10, not_self: bool = True, query_block: int = QUERY_BLOCK, piece: int = PIECE) -> DataFrame:
    """``query``, ``id``, ``distance``, ``rank_no`` of the ``k`` nearest rows of ``corpus`` (``id``, ``v``) to each of ``queries`` (same columns).

    Up to ``query_block`` queries (counted first) are sent to the corpus, which
    is read once and not shuffled. More are dealt out to blocks of that size,
    the corpus to pieces, and each block meets each piece in a task of its own;
    nothing passes through the driver then. Either way the best ``k`` of a batch
    or piece for each query are kept before anything is shuffled. Ties go to the
    lesser id.
    """
    out = f"query {dict(queries.dtypes)['id']}, id {dict(corpus.dtypes)['id']}, distance double"
    count = queries.count()
    if not count:
        return corpus.sparkSession.createDataFrame([], out + ", rank_no int")
    if count <= query_block:
        rows = queries.select("id", "v").collect()
        found = corpus.select("id", "v").mapInPandas(_nearest(np.array([r.v for r in rows]), [r.id for r in rows], k, not_self), out)
    else:
        blocks, pieces = -(-count // query_block), max(1, -(-corpus.count() // piece))
        own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        asked = queries.select("id", "v", own(blocks).alias("block"), every(pieces).alias("piece"))
        held = corpus.select("id", "v", every(blocks).alias("block"), own(pieces).alias("piece"))
        found = asked.groupBy("block", "piece").cogroup(held.groupBy("block", "piece")).applyInPandas(_met(k, not_self), out)
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    return found.withColumn("rank_no", rank).where(F.col("rank_no") <= k)


def search_by_ids(corpus: DataFrame, ids: DataFrame, k: int = 10) -> DataFrame:
    """Neighbours of stored vectors, themselves left out; ids that aren't stored have no rows."""
    return nearest(corpus, corpus.join(ids.select(F.col(ids.columns[0]).alias("id")).distinct(), "id", "left_semi"), k, True)


def search_by_vectors(corpus: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """Neighbours of given vectors (``id``: the query's own name, ``v``: any length); a stored equal may be among them."""
    return nearest(corpus, normalise(vectors, "id", "v"), k, False)


def first_ids(df: DataFrame, key: str, n: int, order: str | None = None) -> DataFrame:
    """The first ``n`` ids: by ``order``, else by ``place``, the order in which they are stored, if the rows have it, else by themselves."""
    return df.orderBy(order or ("place" if "place" in df.columns else key), key).select(key).limit(n)
