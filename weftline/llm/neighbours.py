"""Most similar vectors for every vector, by an inverted multi-index.

Vectors are scaled to unit length and cut into two halves. Each half is
quantised by its own k-means; a vector lies in the cell of its two centroids. A
query walks the cells by growing summed distance of its halves to the cell's
centroids, popping them off a heap, until that distance has grown by a certain
reach, and the entries found there are reranked by exact cosine. The reach is
measured on every table: a sample of queries is answered exactly, against all
rows, and walks go as far as they must for the wanted recall of those answers.

Cells are kept on shelves, so that few tasks have what a query needs: a shelf is
the region of one of some centres of whole vectors, and a cell is looked up on the
shelf where most of its entries lie (and on each shelf whose entries lie mostly
in that cell). A query is compared with all entries of the shelves that it visits.

Pairs above a bound of similarity are found without exception: the distance of
two vectors on different shelves is at least the sum of their distances from the
plane half way between the shelves' centres, so if they are closer than d, one of
them is closer than d / 2 to that plane, and it visits the other's shelf too.

Distribution: a shelf's entries and visitors are dealt out over pieces of
bounded size by hash, and every piece of entries streams past every piece of
visitors. A shelf that owns a third of all rows is therefore many bounded tasks.
Where a shelf is one piece, its entries are its own visitors and are sent there once.
Vectors are written once, when they are clean: their places and visits are found anew
in each pass over them.
Of equal vectors only the first k + 1 are entries, and one of them asks for all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.pairing import keyed_join
from ..session import cut, spread

#: The index is fitted on at most this many vectors, those of least hash; this many of them are the queries on which recall is measured.
FIT_ROWS, FIT_QUERIES = 20_000, 256
#: Share of the true neighbours of those queries that walks must reach.
RECALL = 0.97
#: Entries on a shelf, on average, and the most shelves.
SHELF, MOST_SHELVES = 2048, 1024
#: Most centroids of a half: a row for each occupied cell, at most their square, passes through the driver.
MOST_CENTROIDS = 1024
#: Entries and visitors in one piece.
ENTRY_PIECE, QUERY_PIECE = 65_536, 16_384
#: What a cosine of single precision, or a distance, may be off by.
MARGIN = 1e-5
SLACK = 1e-4
#: Vectors of equal ones that are broadcast, at most; their number is counted first.
BROADCAST_CLASSES = 100_000


def clean_vectors(df: DataFrame, key: str, vector: str, version: str | None, dim: int) -> DataFrame:
    """``key`` and its unit ``v`` (array<float>) of the row with the latest version.

    A key whose latest vector is NULL, has another length than ``dim``, holds a
    NULL, NaN or infinite number or is all zero has no vector. A NULL version
    is older than any other; of rows with equal versions the greatest vector
    counts. NULL keys go.
    """
    rows = df.select(df[key].alias("key"), df[vector].alias("raw"), (df[version] if version else F.lit(0)).alias("version")).where("key IS NOT NULL")
    latest = rows.groupBy("key").agg(F.max(F.struct("version", F.col("raw").isNotNull().alias("there"), "raw")).alias("m")).select("key", F.col("m.raw").alias("raw"))
    # an array's comparison with NaN or infinity inside is of no concern: such a vector goes here
    kinds = dict(latest.dtypes)
    raw = F.col("raw") if kinds["raw"] in ("array<float>", "array<double>") else F.col("raw").cast("array<double>")
    return latest.where(F.size("raw") == dim).select("key", raw.alias("raw")).mapInArrow(_units(dim), f"key {kinds['key']}, v array<float>")


def _units(dim: int):
    """Vectors of length 1; those with a NULL, NaN or infinite number, or without a direction, go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("raw").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # a NULL is NaN here
            largest = np.abs(x).max(1)
            good = np.flatnonzero(np.isfinite(largest) & (largest > 0))
            x = x[good] / largest[good][:, None]  # no square leaves a double's range
            x /= np.sqrt((x * x).sum(1))[:, None]
            flat = (x + 0.0).astype(np.float32).ravel()
            v = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(good)), v], names=["key", "v"])

    return run


def _kmeans(rows: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        near = ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def centroid_count(rows: int) -> int:
    """A power of two near twice the cube root of the rows, so that the entries in a cell grow as the cube root too."""
    return int(2 ** np.clip(round(np.log2(max(rows, 1)) / 3 + 1.3), 3, np.log2(MOST_CENTROIDS)))


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * rows @ centres.T, 0)


class Index:
    """Codebooks of both halves, the centres of the shelves, and of each cell its entries and its shelf."""

    def __init__(self, sample: np.ndarray, centroids: int, shelves: int, seed: int = 7):
        self.half = sample.shape[1] // 2
        self.first, self.second = _kmeans(sample[:, : self.half], centroids, seed), _kmeans(sample[:, self.half :], centroids, seed + 1)
        self.centres = _kmeans(sample, shelves, seed + 2)
        gap = np.sqrt(_distances(self.centres, self.centres))
        self.gap = np.where(gap > 0, gap, np.inf)
        self.shelves: dict[int, tuple[int, ...]] = {}

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and shelf of each vector."""
        a, b = _distances(x[:, : self.half], self.first).argmin(1), _distances(x[:, self.half :], self.second).argmin(1)
        return (a * len(self.second) + b).astype(np.int32), _distances(x, self.centres).argmin(1).astype(np.int32)

    def fill(self, held: list[tuple[int, int]]) -> None:
        """Notes on which shelves to look up which cells; a cell without a shelf is empty."""
        for cell, shelf in sorted(set(held)):
            self.shelves[cell] = (*self.shelves.get(cell, ()), shelf)

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.half], self.first), _distances(x[:, self.half :], self.second)

    def walked(self, x: np.ndarray, reach: float) -> list[set[int]]:
        """The shelves of the cells that each query walks within ``reach``."""
        return [{s for cell in _walk(p, q, self.shelves, reach) for s in self.shelves[cell]} for p, q in zip(*self._halves(x))]

    def reaches(self, x: np.ndarray) -> np.ndarray:
        """By query and shelf: the reach of a walk that leads there."""
        d1, d2 = self._halves(x)
        out = np.full((len(x), len(self.centres)), np.inf)
        for cell, shelves in self.shelves.items():
            summed = d1[:, cell // len(self.second)] + d2[:, cell % len(self.second)]
            for s in shelves:
                np.minimum(out[:, s], summed, out=out[:, s])
        return out - (d1.min(1) + d2.min(1))[:, None]

    def close(self, x: np.ndarray, distance: float) -> np.ndarray:
        """By query and shelf: whether the plane half way to the shelf is within half of ``distance``."""
        d = _distances(x, self.centres)
        own = d.argmin(1)
        from_plane = (d - d[np.arange(len(x)), own][:, None]) / (2 * self.gap[own])
        near = from_plane <= distance / 2 + SLACK
        near[np.arange(len(x)), own] = True
        return near


def _walk(d1: np.ndarray, d2: np.ndarray, held: dict[int, tuple[int, ...]], reach: float) -> list[int]:
    """Cells that hold entries, by summed distance, until it exceeds the least by more than ``reach``: the multi-sequence algorithm with a heap."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2, l1, l2 = d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist()
    k2, heap, visited, most = len(l2), [(s1[0] + s2[0], 0, 0)], [], s1[0] + s2[0] + reach
    while heap:
        summed, a, b = heapq.heappop(heap)
        if summed > most:
            break
        if (cell := l1[a] * k2 + l2[b]) in held:
            visited.append(cell)
        if b + 1 < k2:
            heapq.heappush(heap, (s1[a] + s2[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(l1):
            heapq.heappush(heap, (s1[a + 1] + s2[0], a + 1, 0))
    return visited


def _matrix(v: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(v.to_pylist()), dtype=np.float32)
    return flat.reshape(len(v), -1)


def _placer(index: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("v").flatten(), dtype=np.float32).reshape(batch.num_rows, -1)
            cell, shelf = index.value.place(x)
            packed = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("asks"), packed, pa.array(cell), pa.array(shelf)], names=["key", "asks", "v", "cell", "shelf"])

    return run


def _visitor(index: Broadcast, reach: float, distance: float | None):
    """Adds the shelves that each row visits: none if it doesn't ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                asks = np.flatnonzero(batch.column("asks").to_numpy(zero_copy_only=False))
                x = _matrix(batch.column("v").take(pa.array(asks)))
                visits: list[set[int]] = [set() for _ in range(batch.num_rows)]
                if len(asks):
                    for r, found in zip(asks.tolist(), index.value.walked(x, reach)):
                        visits[r] = found
                    if distance is not None:
                        for r, c in np.argwhere(index.value.close(x, distance)).tolist():
                            visits[int(asks[r])].add(c)
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("v"), batch.column("shelf"), pa.array([sorted(s) for s in visits], pa.list_(pa.int32()))], names=["key", "v", "shelf", "visits"])

    return run


class _Best:
    """The best ``k`` entries so far of each query, by cosine, then by the entry's place; those below ``at_least`` don't count."""

    def __init__(self, q: np.ndarray, k: int, at_least: float | None = None):
        self.q, self.k, self.seen = q, k, 0
        self.none = -2.0 if at_least is None else float(np.nextafter(at_least, -2.0))
        self.cosine, self.entry = np.full((len(q), k), self.none), np.zeros((len(q), k), dtype=np.int64)

    def meet(self, e: np.ndarray, step: int = 512) -> None:
        first, self.seen = self.seen, self.seen + len(e)
        for at in range(0, len(self.q), step):
            q, best, entry = (x[at : at + step] for x in (self.q, self.cosine, self.entry))
            near = q @ e.T
            floor = best[:, -1]
            if floor.min() < -1.5 and len(e) > self.k:  # not full yet
                floor = np.maximum(floor, np.partition(near, len(e) - self.k, axis=1)[:, len(e) - self.k] - MARGIN)
            rows, cols = np.divmod(np.flatnonzero(near >= (floor - MARGIN).astype(np.float32)[:, None]), len(e))
            if not len(rows):
                continue
            exact = np.einsum("ij,ij->i", q[rows].astype(np.float64), e[cols].astype(np.float64))
            hit = np.unique(rows)
            row = np.concatenate([np.repeat(hit, self.k), rows])
            cosine, number = np.concatenate([best[hit].ravel(), exact]), np.concatenate([entry[hit].ravel(), first + cols])
            order = np.lexsort((number, -cosine, row))
            begins = np.searchsorted(row[order], hit)
            kept = order[begins[:, None] + np.arange(self.k)]
            best[hit], entry[hit] = cosine[kept], number[kept]


_MET = "a string, x array<struct<far: double, b: string>>"


#: What a row is in a part: a visitor, an entry that streams past the visitors, or an entry of a shelf of one piece, which may itself ask.
VISITOR, STREAMED, KEPT, KEPT_ASKS = range(4)


def _meeting(k: int, at_least: float | None = None, step: int = 4096):
    """Over rows of ``part``, ``kind``, ``key``, ``v``, of each part first the visitors, then the entries by key; the best of each query."""

    def result(names: list[pa.Array], best: _Best, entries: list[pa.Array]) -> pa.RecordBatch:
        there = best.cosine > best.none
        some = there.any(1)
        held = pa.chunked_array(entries).combine_chunks()
        pairs = pa.StructArray.from_arrays([pa.array(-best.cosine[there]), held.take(pa.array(best.entry[there]))], names=["far", "b"])
        offsets = np.concatenate([[0], np.cumsum(there[some].sum(1))]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.chunked_array(names).combine_chunks().filter(pa.array(some)), pa.ListArray.from_arrays(pa.array(offsets), pairs)], names=["a", "x"])

    def meet(best: _Best, x: np.ndarray) -> None:
        for at in range(0, len(x), step):
            best.meet(x[at : at + step])

    def ended(names: list, vectors: list, kept: list, best: _Best | None, entries: list) -> Iterator[pa.RecordBatch]:
        if kept and vectors:
            best, entries = _Best(np.concatenate(vectors), k, at_least), [key for key, _ in kept]
            meet(best, np.concatenate([x for _, x in kept]))
        if best:
            yield result(names, best, entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, vectors, kept, best, entries = None, [], [], [], None, []
        for batch in batches:
            parts, kind, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            x = _matrix(batch.column(3))
            new = np.flatnonzero((parts[1:] != parts[:-1]) | ((kind[1:] > VISITOR) != (kind[:-1] > VISITOR))) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(parts)]):
                if hi == lo:
                    continue
                if parts[lo] != part:
                    yield from ended(names, vectors, kept, best, entries)
                    part, names, vectors, kept, best, entries = parts[lo], [], [], [], None, []
                if kind[lo] == STREAMED:
                    if best is None:
                        if not names:  # entries that nobody visits
                            continue
                        best = _Best(np.concatenate(vectors), k, at_least)
                    entries.append(keys.slice(lo, hi - lo))
                    meet(best, x[lo:hi])
                    continue
                if kind[lo] != VISITOR:
                    kept.append((keys.slice(lo, hi - lo), x[lo:hi]))
                asking = lo + np.flatnonzero((kind[lo:hi] == VISITOR) | (kind[lo:hi] == KEPT_ASKS))
                if len(asking):
                    names.append(keys.take(pa.array(asking)))
                    vectors.append(x[asking])
        yield from ended(names, vectors, kept, best, entries)

    return run


def _asker(queries: np.ndarray, k: int):
    """The best ``k`` rows of a partition for each of a few queries, with their shelves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, shelves = _Best(queries, k), []
        for batch in batches:
            if batch.num_rows:
                best.meet(_matrix(batch.column("v")))
                shelves.append(batch.column("shelf").to_numpy())
        if shelves:
            r, c = np.nonzero(best.cosine > best.none)
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(best.cosine[r, c]), pa.array(np.concatenate(shelves)[best.entry[r, c]])], names=["query", "cosine", "shelf"])

    return run


def measured_reach(index: Index, placed: DataFrame, queries: np.ndarray, k: int, recall: float) -> float:
    """The reach with which walks lead to ``recall`` of the queries' true neighbours, found by comparing them with all rows."""
    best = placed.mapInArrow(_asker(queries, k), "query int, cosine double, shelf int")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine")))
    true = best.withColumn("place", place).where(F.col("place").between(2, k)).select("query", "shelf").collect()  # k - 1 rows for each of a few queries: themselves don't count
    if not true:
        return 0.0
    needed = np.sort(index.reaches(queries)[[r["query"] for r in true], [r.shelf for r in true]])
    return float(needed[int(np.ceil(recall * len(needed))) - 1]) + SLACK


def _met(placed: DataFrame, visits: DataFrame, shelves: int, k: int, at_least: float | None = None) -> DataFrame:
    """The best ``k`` entries of each query among those of the shelves that it visits, piece by piece. ``placed`` lists each row's visits, ``visits`` has a row for each of them, or one without a shelf."""
    spark = placed.sparkSession
    met = cut(visits.groupBy("home", "shelf").agg(F.count(F.lit(1)).alias("asked"), F.count_if(F.coalesce("place", F.lit(0)) == 0).alias("held")))
    held, asked = ({r.shelf: r.n for r in met.groupBy(F.col(by).alias("shelf")).agg(F.sum(of).alias("n")).collect()} for by, of in (("home", "held"), ("shelf", "asked")))  # a row for each shelf
    entries, queries = (np.array([max(1, -(-of.get(s, 0) // most)) for s in range(shelves)]) for of, most in ((held, ENTRY_PIECE), (asked, QUERY_PIECE)))
    first = np.concatenate([[0], np.cumsum(entries * queries)])
    at = lambda values, s: F.get(F.array(*(F.lit(int(v)) for v in values)), s)
    own = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
    part = lambda s, e, q: (at(first[:-1], s) + e * at(queries, s) + q).cast("int")
    one_piece, shelf = at((entries * queries == 1).astype(int), F.col("shelf")) == 1, F.col("shelf")
    kind = F.when(~one_piece, STREAMED).when(F.array_contains("visits", shelf), KEPT_ASKS).otherwise(KEPT)
    as_entry = F.transform(F.sequence(F.lit(0), at(queries, shelf) - 1), lambda q: F.struct(part(shelf, own(at(entries, shelf)), q).alias("part"), kind.alias("kind")))
    elsewhere = F.filter("visits", lambda s: ~one_piece | (s != shelf))
    as_visitor = F.flatten(F.transform(elsewhere, lambda s: F.transform(F.sequence(F.lit(0), at(entries, s) - 1), lambda e: F.struct(part(s, e, own(at(queries, s))).alias("part"), F.lit(VISITOR).alias("kind")))))
    dealt = placed.select("key", "v", F.explode(F.concat(as_entry, as_visitor)).alias("to")).select("to.part", "to.kind", "key", "v")
    # Few bytes are much work here: tasks are many, and where the parts are few enough to be weighed, each gets about as much work as any other.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    task = F.pmod(F.xxhash64("part"), F.lit(tasks)).cast("int")
    if first[-1] <= 4096:
        work = np.concatenate([np.repeat((held.get(s, 0) / e) * (asked.get(s, 0) / q), e * q) for s, (e, q) in enumerate(zip(entries.tolist(), queries.tolist()))])
        task = F.get(F.array(*(F.lit(t) for t in _spread_evenly(work, tasks))), F.col("part"))
    dealt = dealt.repartitionById(tasks, task).sortWithinPartitions("part", F.col("kind") > VISITOR, "key")
    met = dealt.mapInArrow(_meeting(k, at_least), _MET)
    return met.groupBy("a").agg(F.slice(F.sort_array(F.flatten(F.collect_list("x"))), 1, k).alias("x"))


def _spread_evenly(work: np.ndarray, tasks: int) -> list[int]:
    """A task for each part: the largest first, each to the task that has least so far."""
    loads = [(0.0, t) for t in range(tasks)]
    out = [0] * len(work)
    for k in np.argsort(-work, kind="stable").tolist():
        load, t = heapq.heappop(loads)
        out[k] = t
        heapq.heappush(loads, (load + float(work[k]) + 1.0, t))
    return out


def _distinct(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries (``key``, ``v``, ``asks``: is it the first of its class), the keys of larger classes (``key``, ``a``: the class's first), and those classes (``a``, ``n`` keys).

    A class is the keys of one vector, told by two hashes of 64 bits. Of a class the
    first k + 1 keys are entries, as no list needs more of it.
    """
    for seed in range(0, 16, 2):
        held = cut(vectors.select(F.col("key").cast("string").alias("key"), "v", F.xxhash64(F.lit(seed), "v").alias("id")))
        other = F.xxhash64(F.lit(seed + 1), "v")
        larger = cut(held.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(other).alias("low"), F.max(other).alias("high"), F.min("key").alias("a")).where("n > 1"))
        if larger.where("low <> high").isEmpty():
            break
    else:
        raise ValueError("eight hash functions in turn gave different vectors one value")
    names, ids = larger.select("id", "a"), larger.select("id")
    if larger.count() <= BROADCAST_CLASSES:
        many, single = held.join(F.broadcast(names), "id"), held.join(F.broadcast(ids), "id", "left_anti")
    else:
        many, single = keyed_join(held, larger.select("id", "a", "n"), "id", "n", held.count()), held.join(ids, "id", "left_anti")
    place = F.row_number().over(Window.partitionBy("id").orderBy("key"))  # cut off before the shuffle by the limit below
    first = cut(many.withColumn("place", place).where(F.col("place") <= k + 1).select("key", "v", (F.col("place") == 1).alias("asks")))
    return single.select("key", "v", F.lit(True).alias("asks")).union(first), many.select("key", "a"), larger.select("a", "n")


def nearest(
    vectors: DataFrame, k: int = 10, alike: float | None = None, recall: float = RECALL, reach: float | None = None, centroids: int | None = None, shelves: int | None = None, fit_rows: int = FIT_ROWS,
    at_least: float | None = None,
) -> DataFrame:
    """The ``k`` most similar other keys of every key by cosine.

    ``vectors`` is what :func:`clean_vectors` gives. Returns ``a``, ``b``,
    ``cosine`` and ``rank_no`` (by cosine descending, then ``b``). Keys with
    equal vectors are neighbours of each other like any others. Fewer than ``k``
    other keys give fewer rows; an empty table gives none.

    Walks go as far as leads to ``recall`` of the true neighbours of a sample of
    queries, unless a ``reach`` is given (infinity: through all cells, which is
    exact). With ``alike``, every pair of at
    least that cosine is compared, without exception; such a pair is in the list
    of one of the two or of both, see :func:`alike`. With ``at_least``, the rows
    of a lower cosine are left out, before anything is written.
    """
    spark = vectors.sparkSession
    entries, members, classes = _distinct(vectors, k)
    count = entries.count()
    if not count:
        return spark.createDataFrame([], "a string, b string, cosine double, rank_no int")
    sample = np.array([r.v for r in entries.where("asks").orderBy(F.xxhash64("key"), "key").limit(fit_rows).select("v").collect()], dtype=np.float32)
    index = Index(sample, centroids or centroid_count(count), shelves or int(np.clip(count // SHELF, 1, MOST_SHELVES)))
    shared = spark.sparkContext.broadcast
    placed = spread(entries).mapInArrow(_placer(shared(index)), "key string, asks boolean, v binary, cell int, shelf int")
    counts = cut(placed.groupBy("cell", "shelf").count())
    best = lambda of, by: counts.groupBy(of).agg(F.max_by(by, F.struct("count", by)).alias(by)).select("cell", "shelf")
    index.fill([(r.cell, r.shelf) for r in best("cell", "shelf").union(best("shelf", "cell")).collect()])  # a row for each occupied cell and each shelf
    reach = measured_reach(index, placed, sample[:FIT_QUERIES], k + 1, recall) if reach is None else reach
    distance = None if alike is None else float(np.sqrt(max(0.0, 2 - 2 * alike)))
    visiting = placed.mapInArrow(_visitor(shared(index), reach, distance), "key string, v binary, shelf int, visits array<int>")
    visits = visiting.select(F.col("shelf").alias("home"), F.posexplode_outer("visits").alias("place", "shelf"))
    near = cut(_met(visiting, visits, len(index.centres), k + 1, **({} if at_least is None else {"at_least": at_least})))  # read twice below
    lists = near.select(F.col("a").alias("key"), "x")
    if not classes.isEmpty():  # all keys of a class have its one list
        own = near.join(F.broadcast(classes) if classes.count() <= BROADCAST_CLASSES else classes, "a")
        alike_lists = keyed_join(members.where("key <> a"), own, "a", "n", max(count, members.count()))
        lists = lists.union(alike_lists.select("key", "x"))
    # a list holds the key itself, unless k + 1 keys of its class come before it
    ranked = lists.select("key", F.posexplode(F.slice(F.filter("x", lambda e: e["b"] != F.col("key")), 1, k)).alias("place", "e"))
    return ranked.select(F.col("key").alias("a"), F.col("e.b").alias("b"), (-F.col("e.far")).alias("cosine"), (F.col("place") + 1).alias("rank_no"))


def alike(neighbours: DataFrame, at_least: float = 0.9) -> DataFrame:
    """Unordered pairs ``node_a`` < ``node_b`` of at least that cosine among the neighbours."""
    close = neighbours.where(F.col("cosine") >= at_least)
    return close.select(F.least("a", "b").alias("node_a"), F.greatest("a", "b").alias("node_b"), F.round("cosine", 4).alias("cosine")).groupBy("node_a", "node_b").agg(F.max("cosine").alias("cosine"))
