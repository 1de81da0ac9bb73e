"""The queries of the training-data operators and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from . import cooccur, leaks, neighbours, packing, sentences, termfreq, topn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- 1: top N


def _right_lists(spark: SparkSession, folder: str) -> DataFrame:
    sims = _table(spark, folder, "item_sim").where("item_i <> item_j")
    return topn.top_n(sims, "item_i", "item_j", "score", 20)


def p1_top_items(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best item_j of every item_i."""
    return _right_lists(spark, folder).select(F.col("g").alias("item_i"), "rank_no", F.col("j").alias("item_j"), "score")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The places of the right lists that the published lists don't hold."""
    wrong = topn.list_differences(_right_lists(spark, folder), _table(spark, folder, "topn_lists"), "item", "item_list")
    return wrong.select(F.col("g").alias("item_i"), "rank_no", F.col("j").alias("item_j"))


_RIGHT = """
WITH best AS (SELECT item_i, item_j, max(score) AS score FROM item_sim
              WHERE item_i IS NOT NULL AND item_j IS NOT NULL AND item_i <> item_j AND isfinite(score) GROUP BY 1, 2),
     ranked AS (SELECT item_i, CAST(row_number() OVER (PARTITION BY item_i ORDER BY score DESC, item_j) AS INTEGER) AS rank_no, item_j, score FROM best),
     top AS (SELECT * FROM ranked WHERE rank_no <= 20)
"""

# ---------------------------------------------------------------- 3: term frequencies


def _node_counts(spark: SparkSession, folder: str) -> DataFrame:
    return termfreq.term_frequencies(_table(spark, folder, "walks"), "walk_id", "path", rare_below=5, common_above=10)


def p3_node_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Occurrences, walks and mark of every node."""
    return _node_counts(spark, folder).select(F.col("term").alias("node"), "occurrences", "records", "mark")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes too rare or too common to train on."""
    return _node_counts(spark, folder).where("mark IS NOT NULL").select(F.col("term").alias("node"), "mark")


_NODES = r"""
WITH texts AS (SELECT walk_id, min(path) AS path FROM walks GROUP BY walk_id),
     tokens AS (SELECT walk_id, unnest(string_split_regex(trim(regexp_replace(path, '[\s]+', ' ', 'g')), ' ')) AS node FROM texts),
     kept AS (SELECT * FROM tokens WHERE node <> ''),
     counts AS (SELECT node, count(*) AS occurrences, count(DISTINCT walk_id) AS records FROM kept GROUP BY node),
     marked AS (SELECT node, occurrences, records, CASE WHEN occurrences < 5 THEN 'rare'
                WHEN records * 10 > (SELECT count(DISTINCT walk_id) FROM kept) THEN 'common' END AS mark FROM counts)
"""

# ---------------------------------------------------------------- 4: nearest neighbours


def _nearest_nodes(spark: SparkSession, folder: str, at_least: float | None = None) -> DataFrame:
    vectors = neighbours.clean_vectors(_table(spark, folder, "node_vectors"), "node", "embedding", "loaded_at", 64)
    return neighbours.nearest(vectors, 10, alike=0.9, at_least=at_least)


def p4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 most similar nodes of every node."""
    near = _nearest_nodes(spark, folder)
    return near.select(F.col("a").alias("node"), "rank_no", F.col("b").alias("neighbour"), F.round("cosine", 5).alias("cosine"))


def p4_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the index finds nine tenths of the true neighbours, against the same over one shelf, where every vector meets every other."""
    vectors = cut(neighbours.clean_vectors(_table(spark, folder, "node_vectors"), "node", "embedding", "loaded_at", 64))
    last = neighbours.nearest(vectors, 10, reach=float("inf"), shelves=1).groupBy("a").agg(F.min("cosine").alias("last"), F.count(F.lit(1)).alias("k"))
    found = neighbours.nearest(vectors, 10, alike=0.9).groupBy("a").agg(F.collect_list("cosine").alias("cosines"))
    hits = last.join(found, "a", "left").select("k", F.size(F.filter(F.coalesce("cosines", F.array()), lambda c: c >= F.col("last") - 1e-6)).alias("hits"))
    return hits.agg((F.coalesce(F.sum("hits"), F.lit(0)) >= 0.9 * F.coalesce(F.sum("k"), F.lit(0))).alias("reaches_nine_tenths"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of nodes close enough to count as alike."""
    return neighbours.alike(_nearest_nodes(spark, folder, 0.9), 0.9).select("node_a", "node_b")


_ALIKE = """
WITH latest AS (SELECT node, arg_max(embedding, loaded_at) AS e, max_by(embedding IS NULL, loaded_at) AS gone FROM node_vectors GROUP BY node),
     fit AS (SELECT node, e::DOUBLE[] AS e FROM latest WHERE NOT gone AND len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     unit AS (SELECT node, e, sqrt(list_dot_product(e, e)) AS norm FROM fit WHERE list_dot_product(e, e) > 0)
SELECT a.node AS node_a, b.node AS node_b FROM unit a JOIN unit b ON a.node < b.node WHERE list_dot_product(a.e, b.e) >= 0.9 * a.norm * b.norm
"""

# ---------------------------------------------------------------- 5: items that appear together


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of items that at least 5 users share, ten times as many as by chance."""
    found = cooccur.associations(_table(spark, folder, "interactions"), "user_id", "item", min_pairs=5, min_lift=10)
    return found.select(F.col("i").alias("item_i"), F.col("j").alias("item_j"))


def p5_item_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs that two users or more share, with their lift."""
    pairs = cooccur.associations(_table(spark, folder, "interactions"), "user_id", "item", min_pairs=2)
    return pairs.select(F.col("i").alias("item_i"), F.col("j").alias("item_j"), "n_ij", F.round("lift", 6).alias("lift"), F.round("pmi", 6).alias("pmi"))


_PAIRS = """
WITH held AS (SELECT DISTINCT user_id AS b, item AS x FROM interactions WHERE user_id IS NOT NULL AND item IS NOT NULL),
     n AS (SELECT count(DISTINCT b) AS n FROM held),
     c AS (SELECT x, count(*) AS n_x FROM held GROUP BY x),
     p AS (SELECT l.x AS item_i, r.x AS item_j, count(*) AS n_ij FROM held l JOIN held r ON l.b = r.b AND l.x < r.x GROUP BY 1, 2),
     s AS (SELECT p.*, ci.n_x AS n_i, cj.n_x AS n_j, n.n, n_ij::DOUBLE * n.n / (ci.n_x::DOUBLE * cj.n_x) AS lift
           FROM p JOIN c ci ON ci.x = item_i JOIN c cj ON cj.x = item_j, n)
"""
# ---------------------------------------------------------------- 6: packing


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    sizes = packing.token_sizes(_table(spark, folder, "documents"), "doc_id", "text")
    return packing.pack(sizes, _table(spark, folder, "container_sizes"))


def p6_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's place in containers of each capacity."""
    return _packed(spark, folder)


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return packing.fill_report(_packed(spark, folder), _table(spark, folder, "container_sizes"))


def p6_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Of each container: whether all tokens are packed, no bin is too full, and no text is cut that fits in one."""
    sizes = cut(packing.token_sizes(_table(spark, folder, "documents"), "doc_id", "text"))
    kinds = _table(spark, folder, "container_sizes")
    packed = cut(packing.pack(sizes, kinds).join(F.broadcast(kinds.select("container", "capacity")), "container"))
    total = sizes.agg(F.sum("tokens").alias("total"), F.sum(F.lit(1)).alias("items"))
    bins = packed.groupBy("container", "capacity", "bin").agg(F.sum("tokens").alias("fill")).groupBy("container").agg(F.sum("fill").alias("packed"), F.max(F.col("fill") - F.col("capacity")).alias("excess"))
    texts = packed.groupBy("container", "capacity", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("tokens"))
    cuts = texts.groupBy("container").agg(F.max(F.col("pieces") - F.ceil(F.col("tokens") / F.col("capacity"))).alias("needless"), F.count(F.lit(1)).alias("texts"))
    return bins.join(cuts, "container").crossJoin(F.broadcast(total)).select(  # one row
        "container", (F.col("packed") == F.col("total")).alias("nothing_lost"), (F.col("excess") <= 0).alias("none_too_full"), ((F.col("needless") == 0) & (F.col("texts") == F.col("items"))).alias("none_cut_needlessly"),
    )


# ---------------------------------------------------------------- 7: leaks


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation items of which a text carries a passage."""
    return leaks.leaks(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"), "doc_id", "text", "item_id", "text")


def p7_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """How many texts carry each leaked item."""
    return p7_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))

# ---------------------------------------------------------------- 8: sentences


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """The end of every sentence of every text."""
    return sentences.sentence_ends(_table(spark, folder, "documents"), "doc_id", "text")


def p8_sentence_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences of every text."""
    return p8_found(spark, folder).groupBy("doc_id").agg(F.count(F.lit(1)).alias("sentences"), F.max("end_pos").alias("last_end"))


def p8_rules(spark: SparkSession, folder: str) -> DataFrame:
    """How many sentences end twice at one place, beyond their text, or at a blank: none."""
    texts = _table(spark, folder, "documents").select("doc_id", "text")
    ends = p8_found(spark, folder).groupBy("doc_id").agg(F.collect_list("end_pos").alias("ends"))
    wrong = ends.join(texts, "doc_id", "left").select(
        F.coalesce(F.size("ends") - F.size(F.array_distinct("ends")) + F.size(F.filter("ends", lambda e: (e < 1) | (e > F.length("text")) | F.substr("text", e, F.lit(1)).rlike(r"^\s$"))), F.lit(1)).alias("n")
    )
    return wrong.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("wrong"))


QUERIES = {f.__name__: f for f in (p1_found, p1_top_items, p3_found, p3_node_counts, p4_found, p4_nearest, p4_recall, p5_found, p5_item_pairs, p6_packed, p6_fill, p6_rules, p7_found, p7_leaked_items, p8_found, p8_sentence_counts, p8_rules)}

SQL = {
    "p1_found": _RIGHT + """, published AS (SELECT DISTINCT item, item_list FROM topn_lists)
SELECT item_i, rank_no, item_j FROM top LEFT JOIN published ON item = item_i WHERE item_list[rank_no] IS DISTINCT FROM item_j""",
    "p1_top_items": _RIGHT + "SELECT item_i, rank_no, item_j, score FROM top",
    "p3_found": _NODES + "SELECT node, mark FROM marked WHERE mark IS NOT NULL",
    "p3_node_counts": _NODES + "SELECT node, occurrences, records, mark FROM marked",
    "p4_found": _ALIKE,
    "p4_recall": "SELECT true AS reaches_nine_tenths",
    "p6_rules": "SELECT container, true AS nothing_lost, true AS none_too_full, true AS none_cut_needlessly FROM container_sizes",
    "p8_rules": "SELECT CAST(0 AS BIGINT) AS wrong",
    "p5_found": _PAIRS + "SELECT item_i, item_j FROM s WHERE n_ij >= 5 AND n_ij * n >= 10 * n_i * n_j",
    "p5_item_pairs": _PAIRS + "SELECT item_i, item_j, n_ij, round(lift, 6) AS lift, round(ln(lift), 6) AS pmi FROM s WHERE n_ij >= 2",
}
