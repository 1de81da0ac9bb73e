"""Sinks: delimited text, partitioned tables, embeddings, key-to-list stores."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import Any, Protocol
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.scalar import text_of


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "append"


def text_lines(df: DataFrame, field_delimiter: str = "\t", collection_delimiter: str = ",") -> DataFrame:
    """One ``value`` a row: the columns as text, arrays joined."""
    kinds = dict(df.dtypes)
    fields = [text_of(F.col(c), collection_delimiter) if kinds[c].startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(field_delimiter, *fields).alias("value"))


def write_text(df: DataFrame, path: str, overwrite: bool = False, field_delimiter: str = "\t", collection_delimiter: str = ",", options: dict[str, str] | None = None) -> None:
    """Scores, top-N lists, walks or embeddings as delimited lines. ``options``: of Spark's text writer, such as ``compression``, which readers tell by the files' names."""
    text_lines(df, field_delimiter, collection_delimiter).write.mode(_mode(overwrite)).options(**options or {}).text(path)


def write_table(df: DataFrame, table: str, overwrite: bool = False, names: dict[str, str] | None = None, partition: tuple[str, str] | None = None, dynamic: bool = False, fmt: str = "parquet") -> None:
    """A table, its columns renamed, with a constant partition column if ``partition`` = (name, value).

    ``overwrite`` replaces the whole table, other partitions included, unless
    ``dynamic``, which replaces only the partitions that are written.
    """
    out = df.withColumnsRenamed(names or {})
    if partition and partition[0]:
        out = out.withColumn(partition[0], F.lit(partition[1]))
    spark = df.sparkSession
    if overwrite and dynamic and partition and spark.catalog.tableExists(table):
        columns = spark.table(table).columns
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            out.select(*columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(setting, before)
        return
    writer = out.write.format(fmt).mode(_mode(overwrite))
    if partition and partition[0]:
        writer = writer.partitionBy(partition[0])
    writer.saveAsTable(table)


def write_walks(walks: DataFrame, target: str, overwrite: bool = False, as_table: bool = False, path_delimiter: str = " ", path_name: str = "path", partition: tuple[str, str] | None = None) -> None:
    """Walks as delimited paths, in one write for all rounds."""
    paths = walks.select(text_of(F.col("path"), path_delimiter).alias("path"))
    if as_table:
        write_table(paths, target, overwrite, {"path": path_name}, partition)
    else:
        paths.write.mode(_mode(overwrite)).text(target)


def write_embeddings(
    vectors: DataFrame, target: str, overwrite: bool = False, as_table: bool = False, field_delimiter: str = "\t", embed_delimiter: str = " ", names: dict[str, str] | None = None, partition: tuple[str, str] | None = None
) -> None:
    """``node``, ``embedding`` as lines, or as a table that holds the vector as delimited text."""
    flat = vectors.select("node", text_of(F.col("embedding"), embed_delimiter).alias("embedding"))
    if as_table:
        write_table(flat, target, overwrite, names, partition)
    else:
        write_text(flat, target, overwrite, field_delimiter)


def export_model(by_mode: dict[str, DataFrame], folder: str, stamp: str, mode: str = "all", info: dict[str, Any] | None = None) -> list[str]:
    """Embeddings as ``<stamp>_embeddings_<mode>`` and the model's facts as JSON beside them. A mode that isn't held writes all."""
    modes = [mode] if mode in by_mode else list(by_mode)
    if not modes:
        raise ValueError("no embeddings: the model is not trained")
    for m in modes:
        write_embeddings(by_mode[m], f"{folder}/{stamp}_embeddings_{m}", overwrite=True)
    if info is not None:
        spark = by_mode[modes[0]].sparkSession
        spark.createDataFrame([(json.dumps(info),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{stamp}_model_info")
    return [f"{folder}/{stamp}_embeddings_{m}" for m in modes]


def scatter_plot(points: DataFrame, path: str, label: str = "label", point: str = "point", side: int = 1296) -> int:
    """Draws each row's point with its label beside it, as SVG; returns the number of points.

    ``points`` is what a map of a bounded sample gives (see ``embedding.tsne``):
    its rows come to the driver.
    """
    rows = [r for r in points.select(label, point).collect() if r[1] is not None]
    xs, ys = [r[1][0] for r in rows] or [0.0], [r[1][1] for r in rows] or [0.0]
    edge = 40

    def scaled(v: float, of: list[float]) -> float:
        return edge + (side - 2 * edge) * (v - min(of)) / ((max(of) - min(of)) or 1.0)

    shapes = []
    for k, (text, at) in enumerate(rows):
        x, y = scaled(at[0], xs), side - scaled(at[1], ys)
        shapes.append(f'<circle cx="{x:.1f}" cy="{y:.1f}" r="4" fill="hsl({k * 137 % 360},60%,45%)"/><text x="{x - 5:.1f}" y="{y - 2:.1f}" text-anchor="end">{escape(str(text))}</text>')
    Path(path).write_text(f'<svg xmlns="http://www.w3.org/2000/svg" width="{side}" height="{side}" font-size="10" font-family="sans-serif">\n' + "\n".join(shapes) + "\n</svg>\n", encoding="utf-8")
    return len(rows)


class ListStore(Protocol):
    """What a key-to-list store must do; all calls of one batch may be pipelined until ``flush``."""

    def replace(self, key: str, values: list[str], expire_seconds: int) -> None: ...
    def flush(self) -> None: ...
    def close(self) -> None: ...


class RedisStore:
    """A list per key in Redis: delete, push, expire, in pipelines. Needs the ``redis`` package where it runs."""

    def __init__(self, host: str, port: int = 6379, password: str | None = None, timeout: float = 10.0):
        import redis

        self._client = redis.Redis(host=host, port=port, password=password or None, socket_timeout=timeout)
        self._pipe = self._client.pipeline(transaction=False)

    def replace(self, key: str, values: list[str], expire_seconds: int) -> None:
        self._pipe.delete(key)
        if values:
            self._pipe.rpush(key, *values)
            self._pipe.expire(key, expire_seconds)

    def flush(self) -> None:
        self._pipe.execute()

    def close(self) -> None:
        self._client.close()


def write_lists(df: DataFrame, connect: Callable[[], ListStore], prefix: str = "", expire_seconds: int = 86400, tries: int = 3, partitions: int = 500, batch: int = 500) -> None:
    """Column 0 (key, after ``prefix``) and column 1 (array) of every row into a list store.

    Each partition has one connection and flushes every ``batch`` rows; replacing
    a list is idempotent, so a failed batch, or a task that Spark runs again, is
    simply sent anew. After ``tries`` failures in a row the error is raised.
    """
    key, values = df.columns[:2]
    rows = df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("k"), F.transform(values, lambda x: x.cast("string")).alias("v")).where("k IS NOT NULL AND v IS NOT NULL")

    def send(part: Iterable[Row]) -> None:
        store: ListStore | None = None
        held: list[Row] = []

        def flush() -> None:
            nonlocal store
            for attempt in range(tries):
                try:
                    store = store or connect()
                    for row in held:
                        store.replace(row.k, [v for v in row.v if v is not None], expire_seconds)
                    store.flush()
                    return
                except Exception:
                    store = None
                    if attempt + 1 == tries:
                        raise

        for row in part:
            held.append(row)
            if len(held) >= batch:
                flush()
                held.clear()
        if held:
            flush()
        if store:
            store.close()

    rows.repartition(partitions).foreachPartition(send)
