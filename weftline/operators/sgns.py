"""Skip-gram embeddings with sampled negatives (sampled softmax or NCE) by Adam, trained in parallel without a copy for all.

Items are dealt out to ``parts`` by their number, so every part holds frequent
and rare ones. In round r of an epoch, the pairs whose centre is in part i and
whose target is in part i + r meet the input vectors of part i and the output
vectors, biases and moments of part i + r. The rounds' tasks share no row, so
nothing is averaged, nothing passes through the driver, and a task holds two
parts however large the vocabulary is. Negatives of a target come from its part.
With one part this is the sequential algorithm. State, order and draws depend on
values alone, so a task that runs again returns the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import average
from ..session import cut

#: Numbers in the matrix of one part, 16 MB: larger vocabularies are dealt out to more parts.
PART_NUMBERS = 2_000_000
#: Pairs that one task of a round trains on, on average: more pairs are more parts, and so more and smaller tasks.
TASK_PAIRS = 2_000_000
LOSSES = ("sampled_softmax", "nce")
# Adam's usual constants.
BETA1, BETA2, EPSILON, RATE = 0.9, 0.999, 1e-8, 0.001

_ARRAYS = ("w", "m", "v", "bias", "bias_m", "bias_v")
_STATE = "task int, kind int, part int, rows bigint, step bigint, " + ", ".join(f"{x} binary" for x in _ARRAYS) + ", loss double, batches bigint"
#: Kinds of rows that a task reads: input vectors, output vectors, pairs; it writes the first two, and its loss as the third.
_INPUT, _OUTPUT, _PAIR = 0, 1, 2


def _log_uniform(rng: np.random.Generator, items: int, n: int) -> tuple[np.ndarray, int]:
    """``n`` distinct numbers below ``items``, drawn with a chance that falls as 1 / number, and the draws it took."""
    if n >= items:
        return np.arange(items), n
    found: dict[int, None] = {}
    tries = 0
    while len(found) < n:
        for k in np.minimum(np.exp(rng.random(2 * n) * np.log(items + 1)).astype(np.int64) - 1, items - 1).tolist():
            tries += 1
            found[k] = None
            if len(found) == n:
                break
    return np.fromiter(found, dtype=np.int64), tries


def _expected(numbers: np.ndarray, items: int, tries: int) -> np.ndarray:
    chance = np.log((numbers + 2) / (numbers + 1)) / np.log(items + 1)
    return -np.expm1(tries * np.log1p(-np.minimum(chance, 1 - 1e-12)))


class _Side:
    """A part's vectors (and biases), with Adam's moments; only the rows that a batch touches move."""

    def __init__(self, row: dict, dim: int):
        self.row = row
        self.w, self.m, self.v = (np.frombuffer(row[x], dtype=np.float64).reshape(-1, dim).copy() for x in ("w", "m", "v"))
        self.bias, self.bias_m, self.bias_v = (np.frombuffer(row[x], dtype=np.float64).copy() for x in ("bias", "bias_m", "bias_v"))

    @staticmethod
    def _adam(w: np.ndarray, m: np.ndarray, v: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        m[at] = BETA1 * m[at] + (1 - BETA1) * gradient
        v[at] = BETA2 * v[at] + (1 - BETA2) * gradient**2
        w[at] -= rate * m[at] / (np.sqrt(v[at]) + EPSILON)

    def move(self, rows: np.ndarray, gradient: np.ndarray, bias_gradient: np.ndarray | None, rate: float) -> None:
        at, place = np.unique(rows, return_inverse=True)
        summed = np.zeros((len(at), self.w.shape[1]))
        np.add.at(summed, place, gradient)
        self._adam(self.w, self.m, self.v, at, summed, rate)
        if bias_gradient is not None:
            self._adam(self.bias, self.bias_m, self.bias_v, at, np.bincount(place, bias_gradient, len(at)), rate)

    def out(self) -> dict:
        return self.row | {x: getattr(self, x).tobytes() for x in _ARRAYS}


def _batch(inputs: _Side, outputs: _Side, centre: np.ndarray, target: np.ndarray, negatives: tuple, loss: str, remove_hits: bool, rate: float) -> float:
    """One step on a batch, whose pairs share their negatives (numbers, expected counts, the targets' expected counts); the mean loss."""
    drawn, drawn_expected, target_expected = negatives
    c, t, s = inputs.w[centre], outputs.w[target], outputs.w[drawn]
    good = (c * t).sum(1) + outputs.bias[target] - np.log(target_expected)
    bad = c @ s.T + outputs.bias[drawn] - np.log(drawn_expected)
    if remove_hits:
        bad[target[:, None] == drawn[None, :]] = -np.inf
    if loss == "sampled_softmax":
        top = np.maximum(good, bad.max(1, initial=-np.inf))
        e_good, e_bad = np.exp(good - top), np.exp(bad - top[:, None])
        total = e_good + e_bad.sum(1)
        value = float((np.log(total) + top - good).mean())
        g_good, g_bad = e_good / total - 1, e_bad / total[:, None]
    else:
        value = float((np.logaddexp(0, -good) + np.logaddexp(0, bad).sum(1)).mean())
        g_good, g_bad = -1 / (1 + np.exp(np.clip(good, -500, 500))), 1 / (1 + np.exp(-np.clip(bad, -500, 500)))
    g_good, g_bad = g_good / len(centre), g_bad / len(centre)
    towards = g_good[:, None] * t + g_bad @ s
    outputs.move(np.concatenate([target, drawn]), np.concatenate([g_good[:, None] * c, g_bad.T @ c]), np.concatenate([g_good, g_bad.sum(0)]), rate)
    inputs.move(centre, towards, None, rate)
    return value


def _trainer(parts: int, dim: int, batch: int, n_sampled: int, loss: str, rate: float, remove_hits: bool, given: tuple | None, by_sequence: bool, seed: tuple):
    """Over a task's rows in order: its two sides, then its pairs, which stream past in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, _Side] = {}
        centres, targets, marks = (np.zeros(0, dtype=np.int64) for _ in range(3))
        losses, task, rng, part = [], None, None, 0

        def step(centre: np.ndarray, target: np.ndarray) -> None:
            outputs = sides[_OUTPUT]
            items = len(outputs.w)
            if given is None:
                drawn, tries = _log_uniform(rng, items, n_sampled)
                negatives = (drawn, _expected(drawn, items, tries), _expected(target, items, tries))
            else:
                held = given[0] % parts == part
                negatives = (given[0][held] // parts, given[1][held], np.full(len(target), given[2]))
            outputs.row["step"] += 1
            t = outputs.row["step"]
            losses.append(_batch(sides[_INPUT], outputs, centre, target, negatives, loss, remove_hits, rate * np.sqrt(1 - BETA2**t) / (1 - BETA1**t)))

        for b in batches:
            kinds = b.column("kind").to_numpy()
            for row in b.slice(0, int((kinds != _PAIR).sum())).to_pylist():
                task, sides[row["kind"]] = row["task"], _Side({k: row[k] for k in row if k in _STATE.replace(",", " ").split()}, dim)
                if row["kind"] == _OUTPUT:
                    part, rng = row["part"], np.random.default_rng([*seed, row["task"]])
            at = np.flatnonzero(kinds == _PAIR)
            new = [np.concatenate([old, b.column(c).to_numpy(zero_copy_only=False)[at].astype(np.int64)]) for old, c in ((centres, "centre"), (targets, "target"), (marks, "mark"))]
            centres, targets, marks = new
            while True:
                if by_sequence:  # a batch is the pairs of so many sequences
                    turns = np.flatnonzero(np.diff(marks)) + 1
                    end = int(turns[batch - 1]) if len(turns) >= batch else 0
                else:
                    end = batch if len(centres) > batch else 0
                if not end:
                    break
                step(centres[:end], targets[:end])
                centres, targets, marks = centres[end:], targets[end:], marks[end:]
        if task is None:
            return
        if len(centres):
            step(centres, targets)
        rows = [side.out() for side in sides.values()]
        empty = {x: None for x in _ARRAYS}
        rows.append({"task": task, "kind": _PAIR, "part": part, "rows": 0, "step": 0, **empty, "loss": float(np.sum(losses)), "batches": len(losses)})
        yield pa.RecordBatch.from_pylist(rows, schema=_schema())

    return run


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in _STATE.split(", "))])


def _first_state(spark: SparkSession, items: int, parts: int, dim: int, seed: int) -> DataFrame:
    """Input vectors uniform on -1 .. 1, output vectors normal with deviation 0.1, cut at 0.2; biases 0."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"].tolist():
                kind, part = k % 2, k // 2
                rows = len(range(part, items, parts))
                rng = np.random.default_rng([seed, kind, part])
                w = rng.uniform(-1, 1, (rows, dim)) if kind == _INPUT else np.clip(rng.normal(0, 0.1, (rows, dim)), -0.2, 0.2)
                zero, bias = np.zeros((rows, dim)).tobytes(), np.zeros(rows if kind == _OUTPUT else 0).tobytes()
                yield pd.DataFrame([{"task": part, "kind": kind, "part": part, "rows": rows, "step": 0, "w": w.tobytes(), "m": zero, "v": zero, "bias": bias, "bias_m": bias, "bias_v": bias, "loss": None, "batches": None}])

    return cut(spark.range(2 * parts).repartition(2 * parts).mapInPandas(draw, _STATE))


def _unpacked(dim: int, parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                w = np.frombuffer(r["w"], dtype=np.float64).reshape(-1, dim).astype(np.float32)
                yield pd.DataFrame({"kind": r["kind"], "ix": np.arange(len(w)) * parts + r["part"], "vector": list(w)})

    return run


def train(
    pairs: DataFrame | Callable[[int], DataFrame], vocab: DataFrame, dim: int = 128, epochs: int = 10, batch: int = 128, n_sampled: int = 10, loss: str = "sampled_softmax", rate: float | None = None,
    parts: int | None = None, seed: int = 7, shuffle: bool = True, remove_hits: bool = True, negatives: tuple | None = None, by_sequence: bool = False, replace_value: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Embeddings and the loss of every epoch.

    ``pairs``: ``seq_id``, ``pos``, ``centre``, ``target`` (indices; see
    ``sequences.skip_grams``), or a function that gives those of an epoch (from
    0). ``vocab``: ``item``, ``ix`` from 1. Index 0, the replacement token, is
    trained like any other; it has a row in the result if ``replace_value``
    names it. Returns (``node``, ``embed``, ``softmax``) and (``epoch``,
    ``loss``). Without pairs the vectors stay as they were drawn and there are
    no losses.

    ``rate`` is Adam's, 0.001 if not given. ``shuffle`` takes the pairs in
    another seeded order each epoch, else they come by sequence and place.
    ``by_sequence``: a batch is the pairs of ``batch`` sequences rather than
    ``batch`` pairs. ``remove_hits``: a negative that is a pair's target doesn't
    count for that pair. ``negatives`` = (indices, expected count of each,
    expected count of any target) replaces the sampler; with several parts each
    uses those that it holds. ``parts``: chosen by the size of the vocabulary and the
    number of pairs, if not given.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss: {loss}")
    spark = vocab.sparkSession
    draw = pairs if callable(pairs) else None
    items = (vocab.agg(F.max("ix")).first()[0] or 0) + 1
    first = cut((draw(0) if draw else pairs).select("seq_id", "pos", F.col("centre").cast("bigint").alias("centre"), F.col("target").cast("bigint").alias("target")))
    count = first.count()
    parts = min(items, parts or max(1, -(-items * dim // PART_NUMBERS), int(np.ceil(np.sqrt(count / TASK_PAIRS)))))
    given = None if negatives is None else (np.asarray(negatives[0], dtype=np.int64), np.asarray(negatives[1], dtype=np.float64), float(negatives[2]))
    state, losses = _first_state(spark, items, parts, dim, seed), []
    for epoch in range(epochs if count else 0):
        own = first if epoch == 0 or not draw else cut(draw(epoch).select("seq_id", "pos", F.col("centre").cast("bigint").alias("centre"), F.col("target").cast("bigint").alias("target")))
        order = F.xxhash64(F.lit(seed), F.lit(epoch), "seq_id", *(() if by_sequence else ("pos", "centre", "target"))) if shuffle else F.lit(0).cast("bigint")
        total, batches = 0.0, 0
        for turn in range(parts):
            mine = own.where(F.pmod(F.col("target") - F.col("centre"), F.lit(parts)) == turn).select(
                F.pmod("centre", F.lit(parts)).cast("int").alias("task"), F.lit(_PAIR).alias("kind"), order.alias("place"), F.xxhash64("seq_id").alias("mark"), "seq_id", "pos",
                F.floor(F.col("centre") / parts).alias("centre"), F.floor(F.col("target") / parts).alias("target"),
            )
            at = F.when(F.col("kind") == _INPUT, F.col("part")).otherwise(F.pmod(F.col("part") - turn, F.lit(parts))).cast("int")
            met = state.withColumn("task", at).unionByName(mine, allowMissingColumns=True)
            ordered = met.repartitionById(parts, F.col("task")).sortWithinPartitions("task", "kind", "place", "seq_id", "pos", "centre", "target")
            rows = cut(ordered.mapInArrow(_trainer(parts, dim, batch, n_sampled, loss, rate or RATE, remove_hits, given, by_sequence, (seed, epoch, turn)), _STATE))
            state = rows.where(F.col("kind") != _PAIR)
            for r in rows.where(F.col("kind") == _PAIR).select("loss", "batches").collect():  # a row for each part
                total, batches = total + r.loss, batches + r.batches
        losses.append((epoch, total / max(batches, 1)))
    vectors = state.select("kind", "part", "w").mapInPandas(_unpacked(dim, parts), "kind int, ix bigint, vector array<float>")
    both = vectors.groupBy("ix").agg(F.max(F.when(F.col("kind") == _INPUT, F.col("vector"))).alias("embed"), F.max(F.when(F.col("kind") == _OUTPUT, F.col("vector"))).alias("softmax"))
    names = vocab.select(F.col("item").cast("string").alias("node"), F.col("ix").cast("bigint").alias("ix"))
    if replace_value is not None:
        names = names.unionByName(spark.createDataFrame([(replace_value, 0)], "node string, ix bigint"))
    return both.join(names, "ix").select("node", "embed", "softmax"), spark.createDataFrame(losses, "epoch int, loss double")


def read_vectors(trained: DataFrame, mode: str = "embed") -> DataFrame:
    """``node``, ``embedding``: the input vectors (``embed``), the output vectors (``softmax``) or their mean (``avg``)."""
    if mode == "avg":
        return trained.select("node", average("embed", "softmax").alias("embedding"))
    if mode in ("embed", "softmax"):
        return trained.select("node", F.col(mode).alias("embedding"))
    raise ValueError(f"mode: {mode}")
