"""Discrete sampling: alias tables and what they stand for."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alias_table(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Acceptance and alias of each slot: slot k is drawn uniformly, then kept with its acceptance, else its alias is taken."""
    n = len(weights)
    share = np.asarray(weights, dtype=float) * n / np.sum(weights)
    accept, alias = np.ones(n), np.arange(n)
    poor, rich = [k for k in range(n) if share[k] < 1], [k for k in range(n) if share[k] >= 1]
    while poor and rich:
        low, high = poor.pop(), rich[-1]
        accept[low], alias[low] = share[low], high
        share[high] -= 1 - share[low]
        if share[high] < 1:
            poor.append(rich.pop())
    return accept, alias


def alias_draw(accept: np.ndarray, alias: np.ndarray, slot: np.ndarray, coin: np.ndarray) -> np.ndarray:
    """Draws for two uniform numbers each."""
    k = np.minimum((slot * len(accept)).astype(int), len(accept) - 1)
    return np.where(coin < accept[k], k, alias[k])


def _tables(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("dst", ignore_index=True)
    accept, alias = alias_table(pdf["weight"].to_numpy())
    mass = accept.copy()
    np.add.at(mass, alias, 1 - accept)
    return pd.DataFrame({"src": pdf["src"], "dst": pdf["dst"], "accept": accept, "alias": pdf["dst"].to_numpy()[alias], "prob": mass / len(pdf)})


def alias_tables(graph: DataFrame) -> DataFrame:
    """Per node (of bounded degree) its alias table: ``src``, ``dst``, ``accept``, ``alias`` and ``prob``, the probability that the table gives to dst."""
    return graph.groupBy("src").applyInPandas(_tables, "src string, dst string, accept double, alias string, prob double")


def neighbour_lists(graph: DataFrame) -> DataFrame:
    """``src`` and ``nbrs``, its neighbours (dst, weight) in order of dst: a uniform number times the sum of weights picks one by running sums."""
    return graph.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("dst", "weight"))).alias("nbrs"))
