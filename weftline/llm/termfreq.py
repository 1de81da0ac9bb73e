"""Frequency of every distinct term: occurrences, records that hold it, and marks for the too rare and the too common.

1. A global dictionary gives every distinct term a dense integer. Blocks of
   records name their terms, each once, so a hub term reaches the dictionary as
   one row a block.
2. Terms are encoded: a block's records become arrays of the dictionary's integers.
3. Each block accumulates two count arrays over its integers, of occurrences
   and of records, cut by range of identifiers.
4. The arrays of a range are summed, a bounded number at a time, until one is left.

Text is shuffled once, when deliveries of one record are brought together; from
then on only a block's distinct terms and integers move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Identifiers in one range: the length of a count array.
RANGE = 4096
#: Characters of records in one block, about.
BLOCK_CHARS = 4_000_000
#: Count arrays of one range that one task sums at once.
FAN_IN = 64

#: White space of Unicode, as Java's and Python's classes differ.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def dictionary(terms: DataFrame, parts: int | None = None) -> DataFrame:
    """``term`` (distinct) and ``id``: 0, 1, 2 ... without gaps.

    Terms are spread by hash and sorted within their part; a part's first
    identifier is the number of terms in the parts before it. Only one count
    per part passes through the driver.
    """
    spark = terms.sparkSession
    distinct = terms.select("term").distinct()
    spread = distinct.select("term", F.pmod(F.xxhash64("term"), F.lit(parts or int(spark.conf.get("spark.sql.shuffle.partitions")))).alias("part"))
    spread = cut(spread)
    sizes = spread.groupBy("part").agg(F.count(F.lit(1)).alias("terms"))
    starts = sizes.select("part", (F.sum("terms").over(Window.orderBy("part")) - F.col("terms")).alias("start"))  # a row per part
    place = F.row_number().over(Window.partitionBy("part").orderBy("term"))
    return cut(spread.join(F.broadcast(starts), "part").select("term", (F.col("start") + place - 1).alias("id")))


def _blocks(most: int):
    """Blocks of records: their distinct terms, and each token as the place of its term in that list, with the number of tokens of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        chars = 0

        def block() -> pa.RecordBatch:
            place: dict[str, int] = {}
            tokens, sizes = [], []
            for text in held:
                own = text.split(" ")
                sizes.append(len(own))
                tokens += [place.setdefault(t, len(place)) for t in own]
            arrays = [np.array(x, dtype=np.int32).tobytes() for x in (tokens, sizes)]
            return pa.RecordBatch.from_arrays([pa.array([list(place)], pa.list_(pa.string())), pa.array([arrays[0]], pa.binary()), pa.array([arrays[1]], pa.binary())], names=["terms", "tokens", "sizes"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(text)
                chars += len(text)
                if chars >= most:
                    yield block()
                    held, chars = [], 0
        if held:
            yield block()

    return run


def count_arrays(ids: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct identifiers in order, and of each its occurrences and the records that hold it; ``ids``: of each place, ``tokens``: places, ``sizes``: of the records."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    encoded = rank[tokens]  # the block's identifiers, numbered in order
    occurrences = np.bincount(encoded, minlength=len(ids))
    held = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(ids) + encoded)  # record and identifier, each once
    return ids[order], occurrences, np.bincount(held % len(ids), minlength=len(ids))


_ARRAYS = "id_range bigint, part bigint, slots binary, occurrences binary, records binary"


def _cut_by_range(width: int, part: int, ids: np.ndarray, occurrences: np.ndarray, records: np.ndarray) -> list[dict]:
    begins = np.flatnonzero(np.diff(ids // width, prepend=-1))
    pieces = zip(begins.tolist(), [*begins[1:].tolist(), len(ids)])
    return [
        {"id_range": int(ids[b] // width), "part": part, "slots": (ids[b:e] % width).astype(np.int16).tobytes(), "occurrences": occurrences[b:e].astype(np.int64).tobytes(), "records": records[b:e].astype(np.int64).tobytes()}
        for b, e in pieces
    ]


def _counter(width: int):
    """Encodes blocks by the dictionary and accumulates their count arrays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, ids, tokens, sizes in zip(batch["block"], batch["ids"], batch["tokens"], batch["sizes"]):
                counted = count_arrays(np.frombuffer(ids, dtype=np.int64), np.frombuffer(tokens, dtype=np.int32), np.frombuffer(sizes, dtype=np.int32))
                yield pd.DataFrame(_cut_by_range(width, int(block), *counted))

    return run


def _summer(width: int):
    """The sum of a range's arrays; slots that no block touched stay out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        occurrences, records = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for slots, n, r in zip(pdf["slots"], pdf["occurrences"], pdf["records"]):
            at = np.frombuffer(slots, dtype=np.int16)
            occurrences[at] += np.frombuffer(n, dtype=np.int64)
            records[at] += np.frombuffer(r, dtype=np.int64)
        touched = np.flatnonzero(occurrences)
        base = int(pdf["id_range"].iloc[0]) * width
        return pd.DataFrame(_cut_by_range(width, int(pdf["part"].iloc[0]), base + touched, occurrences[touched], records[touched]))

    return run


def _slots(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for base, slots, n, r in zip(batch["id_range"], batch["slots"], batch["occurrences"], batch["records"]):
                yield pd.DataFrame({"id": base * width + np.frombuffer(slots, dtype=np.int16).astype(np.int64), "occurrences": np.frombuffer(n, dtype=np.int64), "records": np.frombuffer(r, dtype=np.int64)})

    return run


def _ids_of(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("place")
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "ids": [pdf["id"].to_numpy(dtype=np.int64).tobytes()]})


def term_frequencies(
    records: DataFrame, record_id: str, text: str, rare_below: int = 5, common_above: int = 10, width: int = RANGE, block_chars: int = BLOCK_CHARS, fan_in: int = FAN_IN
) -> DataFrame:
    """Counts of every term over all records.

    A term is a maximal run of characters that are not white space, compared
    exactly. Rows that share a record id are deliveries of one record and count
    once (they hold the same terms; the least text is read). Rows with a NULL
    id are one record for each different text. Records without a term (NULL, empty, blank)
    don't count. Returns ``id`` (the term's dense number), ``term``,
    ``occurrences``, ``records`` (that hold it) and ``mark``: ``rare`` below
    ``rare_below`` occurrences, else ``common`` if more than one record in
    ``common_above`` holds it, else NULL. An empty table gives no rows.
    """
    source = records.select(records[record_id].cast("string").alias("r"), F.trim(F.regexp_replace(records[text], SPACE, " ")).alias("t")).where(F.length("t") > 0)
    once = source.groupBy("r", F.when(F.col("r").isNull(), F.col("t")).alias("own")).agg(F.min("t").alias("t")).select("t")
    blocks = cut(once.mapInArrow(_blocks(block_chars), "terms array<string>, tokens binary, sizes binary").withColumn("block", F.monotonically_increasing_id()))
    named = blocks.select("block", F.posexplode("terms").alias("place", "term"))
    ids = dictionary(named)
    encoders = named.join(ids, "term").groupBy("block").applyInPandas(_ids_of, "block bigint, ids binary")  # a block's terms are bounded by its characters
    arrays = cut(blocks.select("block", "tokens", "sizes").join(encoders, "block").mapInPandas(_counter(width), _ARRAYS))
    most = blocks.count()
    while True:
        # block numbers are dealt out, so that a range never meets more than about fan_in arrays at once
        groups = -(-most // fan_in)
        arrays = arrays.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(groups)) if groups > 1 else F.lit(0).cast("bigint"))
        arrays = arrays.groupBy("id_range", "part").applyInPandas(_summer(width), _ARRAYS)
        if groups <= 1:
            break
        arrays, most = cut(arrays), groups
    summed = arrays.select("id_range", "slots", "occurrences", "records").mapInPandas(_slots(width), "id bigint, occurrences bigint, records bigint")
    total = blocks.agg(F.coalesce(F.sum(F.length("sizes") / 4), F.lit(0)).cast("bigint").alias("total"))
    mark = F.when(F.col("occurrences") < rare_below, "rare").when(F.col("records") * common_above > F.col("total"), "common")
    return (
        summed.join(ids, "id")
        .crossJoin(F.broadcast(total))  # one row
        .select("id", "term", "occurrences", "records", mark.alias("mark"))
    )
