"""Rows of a database outside Spark: small reads and changes over any DB-API driver. Large tables go through ``readers.jdbc``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import closing
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


class RowClient:
    """One connection. ``connect`` makes it, e.g. ``lambda: sqlite3.connect(path)`` or a MySQL driver's ``connect`` with its arguments bound."""

    def __init__(self, connect: Callable[[], Any]):
        self._connection = connect()

    def __enter__(self) -> RowClient:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _run(self, cursor: Any, sql: str, arguments: Sequence | None) -> None:
        cursor.execute(sql) if arguments is None else cursor.execute(sql, arguments)

    def query(self, sql: str, arguments: Sequence | None = None, as_pandas: bool = False) -> list[dict] | pd.DataFrame:
        """The result's rows as dictionaries by column name, or as a pandas frame (with its columns even if there are no rows)."""
        with closing(self._connection.cursor()) as cursor:
            self._run(cursor, sql, arguments)
            names = [c[0] for c in cursor.description]
            rows = cursor.fetchall()
        if as_pandas:
            return pd.DataFrame([tuple(r) for r in rows], columns=names)
        return [dict(zip(names, r)) for r in rows]

    def execute(self, sql: str, arguments: Sequence | None = None) -> None:
        """Runs a change and commits it; a failed one is rolled back."""
        with closing(self._connection.cursor()) as cursor:
            try:
                self._run(cursor, sql, arguments)
            except Exception:
                self._connection.rollback()
                raise
        self._connection.commit()

    def frame(self, spark: SparkSession, sql: str, schema: str, arguments: Sequence | None = None) -> DataFrame:
        """A small result as a DataFrame."""
        return spark.createDataFrame([tuple(r.values()) for r in self.query(sql, arguments)], schema)

    def close(self) -> None:
        self._connection.close()
