"""Collaborative-filtering counts that follow a stream of new interactions.

An extension: co-counts are additive, so each micro-batch adds the pairs that
its new (user, item) rows make with what their users already hold. State is two
tables, written in versions, so a batch that runs again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, path: str, like: str) -> DataFrame:
    try:
        return spark.read.schema(like).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], like)
        raise


def apply_batch(spark: SparkSession, batch: DataFrame, folder: str, batch_id: int) -> None:
    """Adds a batch of ``u``, ``i`` rows: writes ``held/batch=n`` (its new rows) and ``pairs/batch=n`` (the pair counts they add).

    Both partitions are overwritten as a whole. Rows of the batch itself are
    left out of what is held before, so running a batch twice gives the same.
    """
    held = _read(spark, f"{folder}/held", "u string, i bigint, batch bigint").where(F.col("batch") < batch_id).select("u", "i")
    new = batch.select(F.col("u").cast("string").alias("u"), F.col("i").cast("bigint").alias("i")).where("u IS NOT NULL AND i IS NOT NULL").distinct()
    new = new.join(held, ["u", "i"], "left_anti")
    new.write.mode("overwrite").parquet(f"{folder}/held/batch={batch_id}")
    new = spark.read.parquet(f"{folder}/held/batch={batch_id}")
    users = new.select("u").distinct()
    before = held.join(users, "u", "left_semi").select("u", F.col("i").alias("j"))
    across = new.join(before, "u").select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
    within = new.join(new.select("u", F.col("i").alias("j")), "u").where("i < j").select(F.col("i").alias("a"), F.col("j").alias("b"))
    counts = across.union(within).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{folder}/pairs/batch={batch_id}")


def pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``a`` < ``b``, ``n``: users that hold both, over all batches so far."""
    return _read(spark, f"{folder}/pairs", "a bigint, b bigint, n bigint, batch bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def follow(stream: DataFrame, folder: str, checkpoint: str, **trigger):
    """Starts the query that applies each micro-batch of ``u``, ``i`` rows."""
    spark = stream.sparkSession
    writer = stream.writeStream.foreachBatch(lambda batch, n: apply_batch(spark, batch, folder, n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def refreshed(spark: SparkSession, path: str, key: str, vector: str):
    """A corpus of vectors read anew: what a service calls on its timer instead of keeping a stale one."""
    from ..operators.vectors import normalise

    spark.catalog.refreshByPath(path)
    return normalise(spark.read.parquet(path), key, vector)
