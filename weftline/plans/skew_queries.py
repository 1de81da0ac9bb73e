"""Queries on tables in which a few keys own most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eager


def _states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events, sims = spark.read.parquet(f"{folder}/interactions.parquet"), spark.read.parquet(f"{folder}/cf_sim.parquet")
    return eager.eager_join_aggregate(events, sims, "item", "i", "rating", "score"), events, sims


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The keys with at least one two-hundredth of all rows of their table."""
    states, events, sims = _states(spark, folder)
    return eager.overloaded_keys(states, events, sims, "item", "i", 200)


def p2_key_results(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and sums of every key of both tables and of their join."""
    states, _, _ = _states(spark, folder)
    sums = [c for c in states.columns if c.endswith("_sum")]
    return states.withColumns({c: F.round(c, 6) for c in sums})


def p2_length_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The join's counts rolled up by the length of the key."""
    states, _, _ = _states(spark, folder)
    rolled = eager.roll_up(states, F.length("key_value"), "key_length")
    return rolled.select("key_length", "left_rows", "right_rows", "joined_rows")


_STATES = """
WITH a AS (SELECT CAST(item AS VARCHAR) AS key_value, count(*) AS left_rows, count(rating) FILTER (isfinite(rating)) AS left_values,
                  coalesce(sum(rating) FILTER (isfinite(rating)), 0) AS left_sum FROM interactions GROUP BY 1),
     b AS (SELECT i AS key_value, count(*) AS right_rows, count(score) FILTER (isfinite(score)) AS right_values,
                  coalesce(sum(score) FILTER (isfinite(score)), 0) AS right_sum FROM cf_sim GROUP BY 1),
     s AS (SELECT coalesce(a.key_value, b.key_value) AS key_value, coalesce(left_rows, 0) AS left_rows, coalesce(left_values, 0) AS left_values,
                  coalesce(left_sum, 0) AS left_sum, coalesce(right_rows, 0) AS right_rows, coalesce(right_values, 0) AS right_values,
                  coalesce(right_sum, 0) AS right_sum FROM a FULL OUTER JOIN b ON a.key_value = b.key_value)
"""

QUERIES = {f.__name__: f for f in (p2_found, p2_key_results, p2_length_rollup)}

SQL = {
    "p2_found": """
SELECT 'item' AS field_name, CAST(item AS VARCHAR) AS key_value FROM interactions WHERE item IS NOT NULL GROUP BY item
HAVING count(*) * 200 >= (SELECT count(*) FROM interactions)
UNION ALL
SELECT 'i', i FROM cf_sim WHERE i IS NOT NULL GROUP BY i HAVING count(*) * 200 >= (SELECT count(*) FROM cf_sim)""",
    "p2_key_results": _STATES + """
SELECT key_value, left_rows, left_values, round(left_sum, 6) AS left_sum, right_rows, right_values, round(right_sum, 6) AS right_sum,
       left_rows * right_rows AS joined_rows, round(left_sum * right_rows, 6) AS joined_left_sum,
       round(right_sum * left_rows, 6) AS joined_right_sum, round(left_sum * right_sum, 6) AS joined_product_sum FROM s""",
    "p2_length_rollup": _STATES + """
SELECT CAST(length(key_value) AS INTEGER) AS key_length, CAST(sum(left_rows) AS BIGINT) AS left_rows, CAST(sum(right_rows) AS BIGINT) AS right_rows,
       CAST(sum(left_rows * right_rows) AS BIGINT) AS joined_rows FROM s GROUP BY 1""",
}
