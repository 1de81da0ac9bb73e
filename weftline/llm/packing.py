"""Filling fixed-capacity containers: hierarchical residual packing.

Items are spread over partitions of bounded size. Every partition packs its own
by best fit, largest first, and emits the bins that are nearly full. The bins
left underfull become items of the next round, in which a few partitions merge
into one, until the rounds end in one partition or, for a container by itself,
nothing merges any more. An
item goes through the tree only as long as its bin is underfull, so the shuffled
data shrink from round to round.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how byte-level BPE of this kind splits text before merging, as published with the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Items in a partition of the first round, and most in one of a later round.
PART = 20_000
#: Partitions that merge into one from round to round.
FAN_IN = 8
#: A bin is nearly full at this share of its capacity.
NEARLY = 0.98
#: Most containers that are broadcast and packed side by side; more are packed in turns.
MOST_CONTAINERS = 1000
#: A container's rounds end when its underfull bins are still this share of what they were a round before.
HARDLY_FEWER = 0.95

_BIN = "container string, capacity int, part bigint, number int, fill int, docs array<bigint>, pieces array<int>, starts array<int>, tokens array<int>"


def _counter(vocabulary: str, split: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("packing", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(text)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32())], names=["doc", "tokens"])

    return run


def token_sizes(documents: DataFrame, doc_id: str, text: str, vocabulary: str = VOCABULARY, split: str = SPLIT) -> DataFrame:
    """``doc``, ``tokens``: every text's length in tokens of a public vocabulary (``vocabulary``: path of a file of ranks).

    Texts that are NULL or empty take no room and have no row, nor have rows
    whose id is NULL. Rows that repeat an id are items of their own.
    """
    rows = documents.select(documents[doc_id].cast("bigint").alias("doc"), documents[text].alias("text")).where("doc IS NOT NULL AND length(text) > 0")
    return spread(rows).mapInArrow(_counter(vocabulary, split), "doc bigint, tokens int")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, largest first, goes where least room stays."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        size = sizes[k]
        if fitting := rooms >> size:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[chosen].append(k)
        else:
            room, chosen = capacity, len(bins)
            bins.append([k])
        if left := room - size:
            by_room.setdefault(left, []).append(chosen)
            rooms |= 1 << left
    return bins


def _packer(pdf: pd.DataFrame) -> pd.DataFrame:
    if pdf.empty:
        return pdf
    pdf = pdf.sort_values(["fill", "first_doc", "first_piece"], ascending=[False, True, True], ignore_index=True)
    join = lambda name, bins: [np.concatenate([x[k] for k in b]) for b in bins] if (x := pdf[name].to_list()) else []
    fills = pdf["fill"].to_list()
    bins = best_fit(fills, int(pdf["capacity"].iloc[0]))
    out = {name: pdf[name].iloc[0] for name in ("container", "capacity", "part")}
    return pd.DataFrame({"number": np.arange(len(bins), dtype=np.int32), "fill": [sum(fills[k] for k in b) for b in bins]} | {name: join(name, bins) for name in ("docs", "pieces", "starts", "tokens")}).assign(**out)[
        ["container", "capacity", "part", "number", "fill", "docs", "pieces", "starts", "tokens"]
    ]


def pack(sizes: DataFrame, containers: DataFrame, container: str = "container", capacity: str = "capacity", part: int = PART, nearly: float = NEARLY, most_containers: int = MOST_CONTAINERS) -> DataFrame:
    """Bins of each container's capacity that hold all items.

    ``sizes`` is ``doc``, ``tokens`` (> 0). Returns one row per piece:
    ``container``, ``bin`` (its name), ``doc_id``, ``piece_no`` from 0,
    ``start`` (the piece's first token in the text) and ``tokens``. An item is
    cut only if it alone exceeds the capacity: into full pieces and a rest, each
    a row. The pieces of a bin never exceed its capacity.

    Rows that repeat a ``doc`` are items of their own.

    Containers with a NULL name or a capacity that is NULL or below 1 are left
    out; of a name given twice both count if their capacities differ. Without
    items or containers there are no rows. Other columns are never read.
    """
    kinds = containers.select(containers[container].alias("container"), containers[capacity].cast("int").alias("capacity")).where("container IS NOT NULL AND capacity > 0").distinct()
    turns = -(-kinds.count() // most_containers)
    if turns > 1:
        packed = [pack(sizes, kinds.where(F.pmod(F.xxhash64("container", "capacity"), F.lit(2 * turns)) == turn), part=part, nearly=nearly, most_containers=2 * most_containers) for turn in range(2 * turns)]
        return reduce(DataFrame.unionByName, packed)
    sizes = cut(sizes.select("doc", "tokens", F.monotonically_increasing_id().alias("row")))
    parts = max(1, -(-sizes.count() // part))
    each = sizes.crossJoin(F.broadcast(kinds)).withColumn("whole", F.expr("tokens div capacity"))
    # pieces as large as the container are bins already
    full = each.where("whole > 0").select("container", "capacity", "doc", "row", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int") - 1)).alias("piece"))
    rest = each.where("tokens > whole * capacity").select("container", "capacity", "doc", "row", F.col("whole").cast("int").alias("piece"), F.expr("cast(tokens - whole * capacity AS int)").alias("left"))
    done = [
        full.select(
            "container", F.concat_ws("-", "container", "capacity", F.lit("whole"), "row", "piece").alias("bin"), F.col("doc").alias("doc_id"),
            F.col("piece").alias("piece_no"), (F.col("piece") * F.col("capacity")).alias("start"), F.col("capacity").alias("tokens"),
        )
    ]
    open_bins = rest.select(
        "container", "capacity", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"), F.col("left").alias("fill"), F.array("doc").alias("docs"),
        F.array("piece").alias("pieces"), F.array(F.col("piece") * F.col("capacity")).alias("starts"), F.array("left").alias("tokens"),
    )
    level, before = 0, {}
    kind = F.concat_ws("-", "container", "capacity")
    while True:
        keyed = open_bins.withColumns({"first_doc": F.col("docs")[0], "first_piece": F.col("pieces")[0]})
        packed = cut(keyed.groupBy("container", "capacity", "part").applyInPandas(_packer, _BIN))
        underfull = F.col("fill") < nearly * F.col("capacity")
        left = {r.kind: r["count"] for r in packed.where(underfull).groupBy(kind.alias("kind")).count().collect()}  # a row for each container
        going = [] if parts == 1 else [k for k, n in left.items() if n <= HARDLY_FEWER * before.get(k, float("inf"))]
        goes_on = underfull & kind.isin(going)
        name = F.concat_ws("-", "container", "capacity", F.lit(level), "part", "number")
        row = F.explode(F.arrays_zip("docs", "pieces", "starts", "tokens"))
        done.append(
            packed.where(~goes_on).select("container", name.alias("bin"), row.alias("x"))
            .select("container", "bin", F.col("x.docs").alias("doc_id"), F.col("x.pieces").alias("piece_no"), F.col("x.starts").alias("start"), F.col("x.tokens").alias("tokens"))
        )
        if not going:
            break
        parts = max(1, min(-(-parts // FAN_IN), parts - 1), -(-max(left[k] for k in going) // part))
        open_bins = packed.where(goes_on).withColumn("part", F.col("part") % parts)
        level, before = level + 1, left
    return reduce(DataFrame.unionByName, done)


def fill_report(packed: DataFrame, containers: DataFrame, container: str = "container", capacity: str = "capacity") -> DataFrame:
    """Per container: bins, tokens, the least possible number of bins and the share of the room that is used."""
    kinds = containers.select(containers[container].alias("container"), containers[capacity].cast("bigint").alias("capacity")).distinct()
    sums = packed.groupBy("container").agg(F.count_distinct("bin").alias("bins"), F.sum("tokens").alias("tokens"))
    return sums.join(F.broadcast(kinds), "container").select(
        "container", "capacity", "bins", "tokens", F.ceil(F.col("tokens") / F.col("capacity")).alias("least_bins"), F.round(F.col("tokens") / (F.col("bins") * F.col("capacity")), 4).alias("used")
    )
