"""Sums over every two entities that share a neighbour, without a shuffle of their pairs.

Pairs are many times the rows that make them. So the rows are shuffled instead: the
entities are dealt out to blocks, and a tile, one task, gets all rows of two blocks.
It holds whatever its entities' pairs, norms and counts need, and gives each pair with
its final score. A row is packed with others of its block in compressed columns, of a
few bytes a row, and the block is written once: each of its tiles, as many as there are
blocks, reads it from the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, released

#: Entities are hashed to so many buckets, of which blocks are made.
BUCKETS = 512
#: Rows of a tile: blocks are as many as that takes.
TILE_ROWS = 5_000_000
#: A tile may be so many times as large, if one bucket is: beyond, rows are paired by a join.
MOST_TIMES = 2
#: Rows that are packed at a time, and pairs that are made at a time.
PACK_ROWS, PAIRS = 1_000_000, 500_000


def _packer(rows_at_once: int):
    """Rows of ``bucket`` and other columns as one binary value a bucket."""

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        table = table.take(pc.sort_indices(table, sort_keys=[("bucket", "ascending"), ("l", "ascending"), ("x", "ascending")])).combine_chunks()
        bucket = table.column("bucket").to_numpy()
        table = table.drop_columns(["bucket"])
        begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends, blobs = np.append(begins[1:], len(bucket)), []
        for lo, hi in zip(begins.tolist(), ends.tolist()):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.slice(lo, hi - lo))
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(bucket[begins]), pa.array(ends - begins), pa.array(blobs, pa.binary())], names=["bucket", "n", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows_at_once:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    return run


class _Side:
    """The rows of a block: codes of ``l`` and ``x``, weights, and per entity what its scores need."""

    def __init__(self, l: np.ndarray, x: np.ndarray, names: pa.Array, r: np.ndarray, formula: str):
        self.names = names
        if formula == "cosine":
            self.of = np.sqrt(np.bincount(x, r * r, len(names)))
            there = self.of[x] > 0
            l, x, r = l[there], x[there], r[there]
            r = r / self.of[x]
        else:
            self.of = np.bincount(x, minlength=len(names)).astype(np.float64)
        self.l, self.x, self.r = l, x, r


def _sums(left: _Side, right: _Side, keys: int, order: str | None, both: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``a``, ``b`` (codes), the sum and the number of products of each pair, all pairs of an ``a`` at once. ``order``: ``<`` or ``<>`` within one block; ``both``: products of both weights, else the left one counts."""
    by = np.argsort(right.l, kind="stable")
    b, rb = right.x[by], right.r[by]
    counts = np.bincount(right.l, minlength=keys)
    starts = np.cumsum(counts) - counts
    by = np.argsort(left.x, kind="stable")
    a, ra, l = left.x[by], left.r[by], left.l[by]
    met, lo, size = counts[l], starts[l], len(right.names)
    total = np.concatenate([[0], np.cumsum(met)])
    ends = np.append(np.flatnonzero(a[1:] != a[:-1]) + 1, len(a)) if len(a) else np.zeros(0, np.int64)

    def products(s: int, e: int):
        n = met[s:e]
        row = np.repeat(np.arange(s, e), n)
        at = np.arange(total[e] - total[s]) + np.repeat(lo[s:e] - (total[s:e] - total[s]), n)
        if order:
            there = a[row] < b[at] if order == "<" else a[row] != b[at]
            row, at = row[there], at[there]
        return a[row], b[at], ra[row] * (rb[at] if both else 1.0)

    s = done = 0
    while done < len(ends):
        last = max(done, int(np.searchsorted(total[ends], total[s] + PAIRS, "right")) - 1)
        e = int(ends[last])
        if total[e] - total[s] <= PAIRS or e - s == 1:
            x, y, w = products(s, e)
            if len(x):
                key = (x - x[0]).astype(np.int64) * size + y
                by = np.argsort(key)
                key = key[by]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                yield x[by][first], y[by][first], np.add.reduceat(w[by], first), np.diff(np.append(first, len(key)))
        else:  # one entity of very many pairs
            sums, number = np.zeros(size), np.zeros(size, np.int64)
            cut_at = [s]
            while cut_at[-1] < e:
                cut_at.append(min(e, max(cut_at[-1] + 1, int(np.searchsorted(total, total[cut_at[-1]] + PAIRS, "right")) - 1)))
            for f, t in zip(cut_at, cut_at[1:]):
                _, y, w = products(f, t)
                sums += np.bincount(y, w, size)
                number += np.bincount(y, minlength=size)
            y = np.flatnonzero(number)
            if len(y):
                yield np.full(len(y), a[s]), y, sums[y], number[y]
        s, done = e, last + 1


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``block``, ``rows`` of one block as one."""
    held = [batch for batch in batches if batch.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        rows = table.column("rows").combine_chunks()
        yield pa.RecordBatch.from_arrays([table.column("block").slice(0, 1).combine_chunks(), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=["block", "rows"])


def _scorer(formula: str, n: int | None, slack: float):
    """Over the one row ``first``, ``second`` (blocks), ``rows``, ``others`` of a tile: the scores of its pairs, or the best of each entity."""

    def codes(chunks: list[pa.ChunkedArray]) -> tuple[list[np.ndarray], pa.Array]:
        whole = pa.chunked_array([c for x in chunks for c in x.chunks], chunks[0].type).combine_chunks().dictionary_encode()
        ends = np.cumsum([0, *map(len, chunks)])
        found = whole.indices.to_numpy()
        return [found[s:e] for s, e in zip(ends, ends[1:])], whole.dictionary

    def best(left: _Side, right: _Side, x: np.ndarray, y: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        """The ``n`` highest of each ``a``, and what is less than ``slack`` below."""
        by = np.lexsort((-score, x))
        x, y, score = x[by], y[by], score[by]
        begins = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        held = np.diff(np.append(begins, len(x)))
        least = np.repeat(np.where(held > n, score[begins + np.minimum(held, n) - 1], -np.inf), held)
        kept = ~(score < least - slack)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.add.reduceat(kept, begins, dtype=np.int64))]).astype(np.int32))
        lists = (pa.ListArray.from_arrays(offsets, v) for v in (right.names.take(pa.array(y[kept])), pa.array(score[kept])))
        return pa.RecordBatch.from_arrays([left.names.take(pa.array(x[begins])), *lists], names=["a", "b", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [tile for batch in batches for tile in zip(*(c.to_pylist() for c in batch.columns))]
        if not tiles:  # the tile is the other way round, or a block is empty
            return
        first, second, *rows = tiles.pop()
        one = first == second
        held = [pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in block) for block in rows[: 1 if one else 2]]
        del rows
        ls, names = codes([t.column("l") for t in held])
        keys, sides = len(names), []
        for l, table in zip(ls, held):
            (x,), names = codes([table.column("x")])
            r = table.column("r").to_numpy() if "r" in table.column_names else np.ones(len(l))
            sides.append(_Side(l, x, names, r, formula))
        del held, ls, table
        turns = [(sides[0], sides[-1])] if one or n is None else [tuple(sides), tuple(sides[::-1])]
        for left, right in turns:
            for x, y, total, number in _sums(left, right, keys, ("<" if n is None else "<>") if one else None, formula == "cosine"):
                score = total if formula == "cosine" else total / (left.of[x] + right.of[y] - number)
                if n is not None:
                    yield best(left, right, x, y, score)
                else:
                    yield pa.RecordBatch.from_arrays([left.names.take(pa.array(x)), right.names.take(pa.array(y)), pa.array(score)], names=["a", "b", "score"])

    return run


def scored(rows: DataFrame, formula: str, n: int | None = None, slack: float = 0.0) -> DataFrame | None:
    """``a``, ``b``, ``score`` of every two entities that share a neighbour, each pair once.

    ``rows``: ``l``, ``x``, unique, and maybe ``r``: the rating for ``cosine``, else
    what a shared ``l`` counts. With ``n``, a row for each ``a`` and tile, with lists ``b``
    and ``score``, of both directions: together they hold the ``n`` best of each ``a``,
    and whatever is at most ``slack`` below. None if one bucket holds too many rows for a
    task.
    """
    spark, kind = rows.sparkSession, dict(rows.dtypes)["x"]
    bucket = F.pmod(F.xxhash64("x"), F.lit(BUCKETS)).cast("int").alias("bucket")
    packed = cut(rows.select(bucket, *rows.columns).mapInArrow(_packer(PACK_ROWS), "bucket int, n bigint, rows binary"))
    released(spark)  # what made the rows is on disk until then
    held = {r.bucket: r.n for r in packed.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # a row for each bucket
    if max(held.values(), default=0) > MOST_TIMES * TILE_ROWS // 2:
        return None
    few = int(np.ceil(np.sqrt(2 * spark.sparkContext.defaultParallelism)))
    blocks = min(BUCKETS, max(few, -(-2 * sum(held.values()) // TILE_ROWS)))
    loads, block_of = [0] * blocks, [0] * BUCKETS
    for k in sorted(held, key=lambda k: -held[k]):
        block_of[k] = loads.index(min(loads))
        loads[block_of[k]] += held[k]
    block = F.get(F.array(*(F.lit(b) for b in block_of)), F.col("bucket"))
    dealt = cut(packed.select(block.alias("block"), "rows").repartitionById(blocks, F.col("block")).mapInArrow(_gathered, "block int, rows array<binary>"))
    del packed
    released(spark)
    sides = dealt.select(F.col("block").alias("first"), "rows"), dealt.select(F.col("block").alias("second"), F.col("rows").alias("others"))
    # a partition for every two of the blocks' partitions, which reads them where they are: no exchange, whatever the blocks' size
    tile = sides[0].hint("shuffle_replicate_nl").join(sides[1], F.col("first") <= F.col("second")).select("first", "second", "rows", "others")
    schema = f"a {kind}, b {kind}, score double" if n is None else f"a {kind}, b array<{kind}>, score array<double>"
    return tile.mapInArrow(_scorer(formula, n, slack), schema)
