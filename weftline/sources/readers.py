"""Sources: SQL files, databases, delimited text, embeddings, edges, labels, properties."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def sql_file(spark: SparkSession, path: str) -> DataFrame:
    """The result of the file's one statement. Line breaks and comments mean what they mean in SQL; a final semicolon may stand."""
    return spark.sql(Path(path).read_text(encoding="utf-8").strip().rstrip(";"))


def jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None, driver: str | None = None, user: str | None = None, password: str | None = None, split: tuple | None = None, **options) -> DataFrame:
    """A table or query of a database. ``split`` = (column, lower, upper, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").option("url", url)
    named = {"dbtable": table, "query": query, "driver": driver, "user": user, "password": password}
    if split:
        named |= dict(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split))
    for key, value in (named | options).items():
        if value is not None:
            reader = reader.option(key, value)
    return reader.load()


def sequences(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """``items`` (array<string>) of each line."""
    return spark.read.text(path).select(F.split("value", _literal(delimiter), -1).alias("items"))


def line_count(spark: SparkSession, path: str) -> int:
    """Lines of the text; 0 of an empty file."""
    return spark.read.text(path).count()


def _literal(delimiter: str) -> str:
    return "\\Q" + delimiter + "\\E"


def parse_embeddings(
    lines: DataFrame, field_delimiter: str = "\t", element_delimiter: str = " ", strict: bool = False, order: str | None = None, id_func: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``id``, ``embedding`` (array<float>) of lines ``id <field> v1 <element> v2 ...`` in column ``value``.

    Tolerant: lines of another form are skipped; of a repeated id the line of
    greatest ``order`` counts (without one, each stays). Strict: the first and
    the last field count, numbers are split at any blanks, and a line of
    another form is an error.
    """
    fields, kept = F.split("value", _literal(field_delimiter), -1), [F.col(order).alias("_order")] if order else []
    if strict:
        numbers = F.split(F.trim(F.element_at(fields, -1)), r"\s+", -1)
        return lines.select(F.get(fields, F.lit(0)).alias("id"), F.transform(numbers, lambda x: x.cast("float")).alias("embedding"), *kept)
    numbers = F.transform(F.split(F.get(fields, F.lit(1)), _literal(element_delimiter), -1), lambda x: F.trim(x).try_cast("float"))
    name = F.get(fields, F.lit(0))
    rows = lines.where(F.size(fields) == 2).select((id_func(name) if id_func else name).alias("id"), numbers.alias("embedding"), *kept)
    rows = rows.where(F.col("id").isNotNull() & F.forall("embedding", lambda x: x.isNotNull()))
    if not order:
        return rows
    return rows.groupBy("id").agg(F.max_by("embedding", "_order").alias("embedding"), F.min("_order").alias("place"))


def embeddings(
    spark: SparkSession, path: str, field_delimiter: str = "\t", element_delimiter: str = " ", strict: bool = False, id_func: str | Callable[[Column], Column] = "string", place: bool = False
) -> DataFrame:
    """Embeddings of a text file, as :func:`parse_embeddings`; the last line of a repeated id counts.

    ``id_func`` makes the id of its text: a type to cast it to, or a function
    from column to column. A tolerant read skips lines for which it gives NULL,
    and counts lines as repeated by what it gives. With ``place``, the rows have
    one more column of that name, by which they stand in the order of the file
    (a repeated id where it stood first).
    """
    lines = spark.read.text(path).select("value", F.struct(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n")).alias("at"))
    named = id_func if callable(id_func) else lambda c: c.try_cast(id_func)
    if strict:
        parsed = parse_embeddings(lines, field_delimiter, element_delimiter, True, "at" if place else None)
        return parsed.withColumn("id", id_func(F.col("id")) if callable(id_func) else F.col("id").cast(id_func)).withColumnsRenamed({"_order": "place"})
    parsed = parse_embeddings(lines, field_delimiter, element_delimiter, order="at", id_func=named)
    return parsed if place else parsed.drop("place")


def edge_list(spark: SparkSession, path: str, weighted: bool = False) -> DataFrame:
    """``src``, ``dst``, ``weight`` (1.0 if unweighted) of lines of blank-separated fields; comments after # and lines of fewer fields go."""
    fields = F.split(F.trim(F.regexp_replace("value", "#.*", "")), r"\s+")
    rows = spark.read.text(path).where(F.size(fields) >= (3 if weighted else 2))
    return rows.select(F.get(fields, F.lit(0)).alias("src"), F.get(fields, F.lit(1)).alias("dst"), (F.get(fields, F.lit(2)).try_cast("double") if weighted else F.lit(1.0)).alias("weight"))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """``item_id``, ``item_label`` of a CSV file with a header."""
    return spark.read.csv(path, header=True).select("item_id", "item_label")


def properties(path: str) -> dict[str, str]:
    """Keys and values of a properties file: ``key=value`` or ``key: value``; # and ! begin comments."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if line and line[0] not in "#!":
            cut = min((k for k in (line.find("="), line.find(":")) if k >= 0), default=len(line))
            out[line[:cut].strip()] = line[cut + 1 :].strip()
    return out


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of greatest ``order`` of each key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")
