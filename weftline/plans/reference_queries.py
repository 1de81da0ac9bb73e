"""Queries of the recommendation, graph, sequence and vector operators, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import average, chunk_sizes, hash_uniform
from ..operators import embedding, graph, item2vec, sampling, sequences, sgns, similarity, swing, vectors, walk
from ..operators.interactions import interactions, roles
from ..sources import readers, sinks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- collaborative filtering

_R = """r AS (SELECT o_custkey AS u, l_partkey AS i, CAST(sum(l_quantity) AS DOUBLE) AS r
     FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2)"""


def _bought(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "orders").join(_table(spark, folder, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return interactions(lines, "o_custkey", "l_partkey", "l_quantity", dedupe="sum")


def _cosine_sql(left: str, x: str, tail: str = "SELECT i, j, score FROM s", rows: str = _R) -> str:
    return f"""WITH {rows}, n AS (SELECT {x} AS x, sqrt(sum(r * r)) AS n FROM r GROUP BY 1),
 p AS (SELECT a.{x} AS a, b.{x} AS b, sum(a.r * b.r) AS d FROM r a JOIN r b ON a.{left} = b.{left} AND a.{x} < b.{x} GROUP BY 1, 2),
 h AS (SELECT a, b, round(d / (m.n * n.n), 6) AS score FROM p JOIN n m ON m.x = a JOIN n ON n.x = b WHERE m.n > 0 AND n.n > 0),
 s AS (SELECT CAST(a AS VARCHAR) AS i, CAST(b AS VARCHAR) AS j, score FROM h UNION ALL SELECT CAST(b AS VARCHAR), CAST(a AS VARCHAR), score FROM h)
{tail}"""


def _jaccard_sql(left: str, x: str, penalty: bool) -> str:
    weight = "sum(1 / ln(1.0::DOUBLE + k))" if penalty else "count(*)::DOUBLE"
    return f"""WITH {_R}, n AS (SELECT {x} AS x, count(*) AS n FROM r GROUP BY 1), d AS (SELECT {left} AS l, count(*) AS k FROM r GROUP BY 1),
 p AS (SELECT a.{x} AS a, b.{x} AS b, count(*) AS c, {weight} AS w FROM r a JOIN r b ON a.{left} = b.{left} AND a.{x} < b.{x} JOIN d ON d.l = a.{left} GROUP BY 1, 2),
 h AS (SELECT a, b, round(w / (m.n + n.n - c), 6) AS score FROM p JOIN n m ON m.x = a JOIN n ON n.x = b)
SELECT CAST(a AS VARCHAR) AS i, CAST(b AS VARCHAR) AS j, score FROM h UNION ALL SELECT CAST(b AS VARCHAR), CAST(a AS VARCHAR), score FROM h"""


_TOP = """, t AS (SELECT i, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS INTEGER) AS rank_no, j FROM s)
SELECT i AS id, rank_no, j AS rec FROM t WHERE rank_no <= 20"""


def _scores(spark: SparkSession, folder: str, model: str, formula: str) -> DataFrame:
    return similarity.similarity(roles(_bought(spark, folder), model), formula).select("i", "j", F.round("score", 6).alias("score"))


def _best_scores(spark: SparkSession, folder: str, model: str, n: int) -> DataFrame:
    """The cosines among which are the ``n`` best of each entity, once rounded."""
    return similarity.candidates(roles(_bought(spark, folder), model), "cosine", n, 2e-6).select("i", "j", F.round("score", 6).alias("score"))


def _lists(scores: DataFrame, n: int) -> DataFrame:
    return similarity.top_n(scores, n).select("id", F.posexplode("rec_list").alias("pos", "rec")).select("id", (F.col("pos") + 1).alias("rank_no"), "rec")


@_query(_cosine_sql("u", "i"))
def cf_item_cosine(spark, folder):
    """Cosine of parts by customers' quantities."""
    return _scores(spark, folder, "item", "cosine")


@_query(_cosine_sql("i", "u"))
def cf_user_cosine(spark, folder):
    """Cosine of customers by the quantities of parts."""
    return _scores(spark, folder, "user", "cosine")


@_query(_jaccard_sql("u", "i", False))
def cf_item_jaccard(spark, folder):
    """Jaccard of parts by customers."""
    return _scores(spark, folder, "item", "jaccard")


@_query(_jaccard_sql("i", "u", False))
def cf_user_jaccard(spark, folder):
    """Jaccard of customers by parts."""
    return _scores(spark, folder, "user", "jaccard")


@_query(_jaccard_sql("u", "i", True))
def cf_item_jaccard_penalty(spark, folder):
    """Jaccard of parts; customers of many parts count less."""
    return _scores(spark, folder, "item", "jaccard-penalty")


@_query(_jaccard_sql("i", "u", True))
def cf_user_jaccard_penalty(spark, folder):
    """Jaccard of customers; parts of many customers count less."""
    return _scores(spark, folder, "user", "jaccard-penalty")


@_query(_cosine_sql("u", "i", _TOP))
def cf_item_topn(spark, folder):
    """The 20 most alike parts of every part."""
    return _lists(_best_scores(spark, folder, "item", 20), 20)


@_query(_cosine_sql("i", "u", _TOP))
def cf_user_topn(spark, folder):
    """The 20 most alike customers of every customer."""
    return _lists(_best_scores(spark, folder, "user", 20), 20)


_SEEN = """r AS (SELECT user_id AS u, item AS i, max(rating) AS r FROM interactions WHERE user_id IS NOT NULL AND item IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating) GROUP BY 1, 2)"""


@_query(_cosine_sql("u", "i", _TOP, _SEEN))
def cf_interactions_topn(spark, folder):
    """The 20 most alike items of every item of the raw interactions, by the highest rating of each user."""
    rows = interactions(_table(spark, folder, "interactions"), "user_id", "item", "rating", dedupe="max")
    return _lists(similarity.cosine(roles(rows, "item")).select("i", "j", F.round("score", 6).alias("score")), 20)


# ---------------------------------------------------------------- Swing


_HELD = "SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM orders JOIN lineitem ON o_orderkey = l_orderkey"


def _held_sql(cap: int | None, source: str = _HELD) -> str:
    plain = f"e0 AS ({source})"
    if cap is None:
        return plain + ", e AS (SELECT * FROM e0)"
    return plain + f""", e AS (SELECT u, i FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY md5(concat_ws('|', '7', CAST(u AS VARCHAR), CAST(i AS VARCHAR))), u) AS k FROM e0) WHERE k <= {cap})"""


def _swing_sql(cap: int | None, tail: str, source: str = _HELD) -> str:
    return f"""WITH {_held_sql(cap, source)},
 c AS (SELECT a.u AS ua, b.u AS ub, a.i AS i FROM e a JOIN e b ON a.i = b.i AND a.u < b.u),
 n AS (SELECT ua, ub, count(*) AS n FROM c GROUP BY 1, 2 HAVING count(*) > 1),
 h AS (SELECT x.i AS a, y.i AS b, round(sum(1.0::DOUBLE / (1 + n)), 6) AS score FROM c x JOIN c y ON x.ua = y.ua AND x.ub = y.ub AND x.i < y.i JOIN n ON n.ua = x.ua AND n.ub = x.ub GROUP BY 1, 2),
 s AS (SELECT a AS item_i, b AS item_j, score FROM h UNION ALL SELECT b, a, score FROM h)
{tail}"""


def _pairs_held(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "orders").join(_table(spark, folder, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return interactions(lines, "o_custkey", "l_partkey", with_rating=False)


def _swing(spark, folder, cap):
    return swing.swing(_pairs_held(spark, folder), cap).select("item_i", "item_j", F.round("score", 6).alias("score"))


@_query(_swing_sql(None, "SELECT * FROM s"))
def swing_score(spark, folder):
    """Swing of parts; the cap of 800 customers a part cuts nothing here."""
    return _swing(spark, folder, 800)


@_query(_swing_sql(20, "SELECT * FROM s"))
def swing_score_capped(spark, folder):
    """Swing under a seeded cap of 20 customers a part."""
    return _swing(spark, folder, 20)


@_query(
    _swing_sql(
        None,
        """, t AS (SELECT item_i, CAST(row_number() OVER (PARTITION BY item_i ORDER BY score DESC, item_j) AS INTEGER) AS rank_no, item_j FROM s)
SELECT item_i AS id, rank_no, item_j AS rec FROM t WHERE rank_no <= 100""",
    )
)
def swing_topn(spark, folder):
    """The 100 most alike parts of every part by Swing."""
    lists = similarity.top_n(_swing(spark, folder, 800), 100, "item_i", "item_j", "score", "id", "rec_list")
    return lists.select("id", F.posexplode("rec_list").alias("pos", "rec")).select("id", (F.col("pos") + 1).alias("rank_no"), "rec")


@_query(_swing_sql(800, "SELECT * FROM s", "SELECT DISTINCT user_id AS u, item AS i FROM interactions WHERE user_id IS NOT NULL AND item IS NOT NULL"))
def swing_interactions(spark, folder):
    """Swing of the raw interactions' items, under the usual cap of 800 users an item: one item holds a tenth of the rows."""
    rows = interactions(_table(spark, folder, "interactions"), "user_id", "item", with_rating=False)
    return swing.swing(rows, 800).select("item_i", "item_j", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- graphs and walks

_EDGES = """t AS (SELECT json_extract_string(props, '$.k') AS k, lead(json_extract_string(props, '$.k')) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
 e AS (SELECT k AS src, n AS dst, CAST(count(*) AS DOUBLE) AS weight FROM t WHERE n IS NOT NULL GROUP BY 1, 2)"""


def _graph_sql(source: str = "SELECT src, dst, weight FROM e", degree: int = 30) -> str:
    return f"""{_EDGES}, g0 AS (SELECT DISTINCT src, dst, weight FROM ({source})),
 g1 AS (SELECT src, dst, weight, row_number() OVER (PARTITION BY src ORDER BY weight DESC, dst) AS k FROM g0),
 g AS (SELECT src, dst, sum(weight) AS weight FROM g1 WHERE k <= {degree} GROUP BY 1, 2)"""


_BOTH = "SELECT src, dst, weight FROM e UNION ALL SELECT dst, src, weight FROM e"


def _followed(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    steps = _table(spark, folder, "events").select(k.alias("src"), F.lead(k).over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("dst"))
    return steps.where("dst IS NOT NULL").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def _graph(spark, folder, degree=30, **more):
    return graph.build_graph(_followed(spark, folder), degree=degree, **more)


@_query(f"WITH {_graph_sql(degree=1_000_000)} SELECT src, dst, weight FROM g")
def graph_directed(spark, folder):
    """What users look at next, all edges."""
    return _graph(spark, folder, 1_000_000)


@_query(f"WITH {_graph_sql(_BOTH, 1_000_000)} SELECT src, dst, weight FROM g")
def graph_undirected(spark, folder):
    """The same in both directions."""
    return _graph(spark, folder, 1_000_000, directed=False)


@_query(f"WITH {_graph_sql('SELECT src, dst, 1.0::DOUBLE AS weight FROM e', 1_000_000)} SELECT src, dst, weight FROM g")
def graph_unweighted(spark, folder):
    """The same without weights."""
    return _graph(spark, folder, 1_000_000, weighted=False)


@_query(f"WITH {_graph_sql()} SELECT src, dst, weight FROM g")
def graph_degree_cap(spark, folder):
    """The 30 heaviest edges of every node."""
    return _graph(spark, folder)


@_query(f"WITH {_graph_sql()} SELECT src, dst, round(weight / sum(weight) OVER (PARTITION BY src), 6) AS prob FROM g")
def node_transitions(spark, folder):
    """Probabilities of the first hop."""
    return graph.node_transitions(_graph(spark, folder)).withColumn("prob", F.round("prob", 6))


_SECOND = """tr AS (SELECT a.src AS prev, a.dst AS cur, b.dst AS nxt, CASE WHEN b.dst = a.src THEN b.weight / 0.5 WHEN c.dst IS NOT NULL THEN b.weight ELSE b.weight / 2.0 END AS w
     FROM g a JOIN g b ON b.src = a.dst LEFT JOIN g c ON c.src = a.src AND c.dst = b.dst)"""


@_query(f"WITH {_graph_sql()}, {_SECOND} SELECT prev, cur, nxt, round(w / sum(w) OVER (PARTITION BY prev, cur), 6) AS prob FROM tr")
def edge_transitions_pq(spark, folder):
    """Probabilities of later hops with p = 0.5 and q = 2."""
    return graph.edge_transitions(_graph(spark, folder), 0.5, 2.0).withColumn("prob", F.round("prob", 6))


_U = "(('0x' || substr(md5(concat_ws('|', '7', CAST({walk} AS VARCHAR), {start}, CAST({step} AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _walk_sql(first_order: bool, rounds: int, hops: int, tail: str, starts: str = "SELECT src AS start FROM g") -> str:
    u0, u = _U.format(walk="s.walk", start="s.start", step="0"), _U.format(walk="w.walk", start="w.start", step="w.step")
    table, key = ("nc", "e.src = w.cur") if first_order else ("ec", "e.prev = w.prev AND e.cur = w.cur")
    return f"""WITH RECURSIVE {_graph_sql()}, {_SECOND},
 nc AS MATERIALIZED (SELECT src, dst AS nxt, hi - weight AS lo, hi, tot FROM (SELECT *, sum(weight) OVER (PARTITION BY src ORDER BY dst) AS hi, sum(weight) OVER (PARTITION BY src) AS tot FROM g)),
 ec AS MATERIALIZED (SELECT prev, cur, nxt, hi - w AS lo, hi, tot FROM (SELECT *, sum(w) OVER (PARTITION BY prev, cur ORDER BY nxt) AS hi, sum(w) OVER (PARTITION BY prev, cur) AS tot FROM tr)),
 s AS (SELECT DISTINCT CAST(k.walk AS INTEGER) AS walk, start FROM ({starts}), (SELECT unnest(range({rounds})) AS walk) k),
 walk(walk, start, step, prev, cur) AS (
  SELECT s.walk, s.start, 1, s.start, c.nxt FROM s JOIN nc c ON c.src = s.start AND {u0} * tot >= lo AND {u0} * tot < hi
  UNION ALL
  SELECT w.walk, w.start, w.step + 1, w.cur, e.nxt FROM walk w JOIN {table} e ON {key} AND {u} * e.tot >= e.lo AND {u} * e.tot < e.hi WHERE w.step < {hops}),
 v AS (SELECT walk, start, 0 AS step, start AS node FROM s UNION ALL SELECT walk, start, step, cur FROM walk)
{tail}"""


def _walks(spark, folder, p, q, **more):
    found = walk.random_walks(_graph(spark, folder), 10, 80, p, q, seed=7, **more)
    return found.select("walk", "start", F.posexplode("path").alias("step", "node"))


@_query(_walk_sql(True, 10, 81, "SELECT walk, start, step, node FROM v"))
def deepwalk_walks(spark, folder):
    """Ten first-order walks of up to 82 nodes from every node, the usual parameters."""
    return _walks(spark, folder, 1.0, 1.0)


@_query(_walk_sql(False, 10, 81, "SELECT walk, start, step, node FROM v"))
def node2vec_walks(spark, folder):
    """Ten second-order walks (p = 0.5, q = 2) of up to 82 nodes from every node."""
    return _walks(spark, folder, 0.5, 2.0)


@_query(_walk_sql(True, 10, 79, "SELECT walk, start, step, node FROM v", "SELECT src AS start FROM g UNION SELECT dst FROM g"))
def deepwalk_exact(spark, folder):
    """The second form of such walks: exactly up to 80 nodes, from nodes without out-edges too."""
    return _walks(spark, folder, 1.0, 1.0, exact_nodes=True, sinks=True)


@_query(_walk_sql(True, 10, 81, "SELECT node, count(*) AS visits, count(DISTINCT (walk, start)) AS walks FROM v GROUP BY 1"))
def walk_visit_counts(spark, folder):
    """How often walks visit each node."""
    return _walks(spark, folder, 1.0, 1.0).groupBy("node").agg(F.count(F.lit(1)).alias("visits"), F.count_distinct("walk", "start").alias("walks"))


@_query(f"WITH {_graph_sql()} SELECT src, dst, round(weight / sum(weight) OVER (PARTITION BY src), 6) AS prob FROM g")
def alias_invariant(spark, folder):
    """The probabilities that alias tables give are those of the weights."""
    return sampling.alias_tables(_graph(spark, folder)).select("src", "dst", F.round("prob", 6).alias("prob"))


# ---------------------------------------------------------------- sequences

_SEQ = """s0 AS (SELECT user_id AS seq_id, list(json_extract_string(props, '$.k') ORDER BY ts, event_id) AS items FROM events GROUP BY 1)"""
_CUT = _SEQ + ", s AS (SELECT seq_id, CASE WHEN len(items) > 40 THEN items[len(items) - 39:] ELSE items END AS items FROM s0 WHERE len(items) >= 3)"
_TOKENS = _CUT + ", tk AS (SELECT seq_id, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS pos, unnest(items) AS item FROM s)"
_COUNTS = _TOKENS + ", c AS (SELECT item, count(*) AS cnt FROM tk GROUP BY 1)"


def _vocab_sql(kept: str) -> str:
    return _COUNTS + f", kept AS ({kept}), vo AS (SELECT item, cnt, row_number() OVER (ORDER BY cnt DESC, item) AS ix FROM kept)"


#: The least count that stays: the mean, so that the rule fires at every size.
_MEAN = "(SELECT CAST(floor(avg(cnt)) AS BIGINT) FROM c)"
_VOCAB = _vocab_sql(f"SELECT * FROM c WHERE cnt >= {_MEAN}")


def _sequences(spark, folder, last=None):
    events = _table(spark, folder, "events")
    return sequences.build_sequences(events.withColumn("item", F.get_json_object("props", "$.k")), "user_id", "item", "ts", "event_id", last=last)


@_query(f"WITH {_SEQ} SELECT seq_id, CASE WHEN len(items) > 40 THEN items[len(items) - 39:] ELSE items END AS items FROM s0")
def seq_last(spark, folder):
    """Every user's last 40 items, cut off before the sequences are built."""
    return _sequences(spark, folder, 40)


def _cut_sequences(spark, folder):
    return sequences.truncate(_sequences(spark, folder), 3, 40, "left")


def _counts(spark, folder):
    return sequences.item_counts(_cut_sequences(spark, folder))


def _vocab(spark, folder, **more):
    counts = _counts(spark, folder)
    least = counts.agg(F.floor(F.avg("cnt"))).first()[0] or 0
    return sequences.vocabulary(counts, min_count=least, **more)


def _pool(spark, folder):
    return _table(spark, folder, "customer").select(F.col("c_nationkey").cast("string").alias("item")).distinct()


_POOL = "(SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS item FROM customer)"


@_query(f"WITH {_SEQ} SELECT seq_id, items FROM s0")
def seq_build(spark, folder):
    """Every user's items in order."""
    return _sequences(spark, folder)


@_query(f"WITH {_CUT} SELECT seq_id, items FROM s")
def seq_truncate_left(spark, folder):
    """The last 40 items of sequences of 3 or more."""
    return _cut_sequences(spark, folder)


@_query(f"WITH {_SEQ} SELECT seq_id, items[:40] AS items FROM s0 WHERE len(items) >= 3")
def seq_truncate_right(spark, folder):
    """The first 40 items of sequences of 3 or more."""
    return sequences.truncate(_sequences(spark, folder), 3, 40, "right")


@_query(f"WITH {_CUT} SELECT count(*) AS num_seq, round(coalesce(avg(len(items)), 0), 6) AS mean_len FROM s")
def seq_stats(spark, folder):
    """Number and mean length of the sequences."""
    return sequences.sequence_stats(_cut_sequences(spark, folder)).withColumn("mean_len", F.round("mean_len", 6))


@_query(f"WITH {_COUNTS} SELECT item, cnt FROM c")
def item_counts(spark, folder):
    """Occurrences of every item."""
    return _counts(spark, folder)


@_query(f"WITH {_vocab_sql(f'SELECT * FROM c WHERE cnt >= {_MEAN} AND cnt <= {_MEAN} + 10')} SELECT item, cnt, ix FROM vo")
def vocab_minmax(spark, folder):
    """Items whose count lies between two limits."""
    counts = _counts(spark, folder)
    least = counts.agg(F.floor(F.avg("cnt"))).first()[0] or 0
    return sequences.vocabulary(counts, least, least + 10)


@_query(f"WITH {_vocab_sql(f'SELECT item, coalesce(cnt, 0) AS cnt FROM {_POOL} LEFT JOIN c USING (item)')} SELECT item, cnt, ix FROM vo")
def vocab_pool_replace(spark, folder):
    """A given pool as vocabulary."""
    return _vocab(spark, folder, pool=_pool(spark, folder), pool_mode="replace")


@_query(f"WITH {_vocab_sql(f'SELECT * FROM c WHERE cnt >= {_MEAN} AND item IN {_POOL}')} SELECT item, cnt, ix FROM vo")
def vocab_pool_intersect(spark, folder):
    """The vocabulary narrowed to a pool."""
    return _vocab(spark, folder, pool=_pool(spark, folder), pool_mode="intersect")


_KEEP = ", kp AS (SELECT ix, item, sqrt(0.003::DOUBLE * (SELECT sum(cnt) FROM vo) / cnt) AS keep FROM vo)"
_INDEXED = ", ixs AS (SELECT seq_id, pos, CAST(coalesce(ix, 0) AS BIGINT) AS ix FROM tk LEFT JOIN vo USING (item))"


@_query(f"WITH {_VOCAB} {_KEEP} SELECT item, round(keep, 6) AS keep FROM kp")
def subsample_keep_prob(spark, folder):
    """How likely each item survives subsampling."""
    return sequences.keep_probability(_vocab(spark, folder), 0.003).select("item", F.round("keep", 6).alias("keep"))


_SUB_U = "(('0x' || substr(md5(concat_ws('|', '7', '0', CAST(seq_id AS VARCHAR), CAST(pos AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@_query(f"WITH {_VOCAB} {_KEEP} {_INDEXED} SELECT seq_id, pos, CASE WHEN coalesce({_SUB_U} < keep, true) THEN ixs.ix ELSE 0 END AS ix FROM ixs LEFT JOIN kp ON kp.ix = ixs.ix")
def subsample_sequences(spark, folder):
    """Subsampled sequences; dropped items become 0."""
    vocab = _vocab(spark, folder)
    indexed = sequences.index_sequences(_cut_sequences(spark, folder), vocab)
    return sequences.subsample(indexed, sequences.keep_probability(vocab, 0.003))


@_query(f"WITH {_VOCAB} {_INDEXED} SELECT seq_id, pos, ix FROM ixs")
def ix_sequences_replace(spark, folder):
    """Sequences as numbers; unknown items are 0."""
    return sequences.index_sequences(_cut_sequences(spark, folder), _vocab(spark, folder))


@_query(f"WITH {_VOCAB} SELECT seq_id, CAST(row_number() OVER (PARTITION BY seq_id ORDER BY pos) - 1 AS INTEGER) AS pos, ix FROM tk JOIN vo USING (item)")
def ix_sequences_remove(spark, folder):
    """Sequences as numbers without unknown items."""
    return sequences.index_sequences(_cut_sequences(spark, folder), _vocab(spark, folder), "remove")


def _pairs_sql(window: str, where: str = "true", distinct: str = "") -> str:
    return f"""WITH {_VOCAB} {_INDEXED}, w AS (SELECT *, {window} AS w FROM ixs),
 p AS (SELECT {distinct} a.seq_id, a.pos, a.ix AS centre, b.ix AS target FROM w a JOIN ixs b ON a.seq_id = b.seq_id AND b.pos BETWEEN a.pos - a.w AND a.pos + a.w AND a.pos <> b.pos WHERE {where})
SELECT centre, target, count(*) AS n FROM p GROUP BY 1, 2"""


def _pairs(spark, folder, window, **more):
    indexed = sequences.index_sequences(_cut_sequences(spark, folder), _vocab(spark, folder))
    return sequences.skip_grams(indexed, window, **more).groupBy("centre", "target").agg(F.count(F.lit(1)).alias("n"))


@_query(_pairs_sql("2"))
def skipgram_pairs(spark, folder):
    """Counts of centre and target within 2 places."""
    return _pairs(spark, folder, 2)


@_query(_pairs_sql("3", "a.ix <> 0 AND b.ix <> 0", "DISTINCT"))
def skipgram_distinct(spark, folder):
    """The same within 3 places, each target once for a place, without the replacement token."""
    return _pairs(spark, folder, 3, distinct_targets=True, train_with_zero=False)


_WINDOW_U = "(('0x' || substr(md5(concat_ws('|', '7', CAST(seq_id AS VARCHAR), CAST(pos AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@_query(_pairs_sql(f"CAST(floor({_WINDOW_U} * 4) + 1 AS INTEGER)"))
def skipgram_random_window(spark, folder):
    """The same within a random window of 1 to 4 for each place."""
    return _pairs(spark, folder, sequences.random_window(5))


@_query(f"WITH {_TOKENS}, o AS (SELECT seq_id, pos, item, row_number() OVER (ORDER BY md5(concat_ws('|', '11', CAST(seq_id AS VARCHAR), CAST(pos AS VARCHAR))), seq_id, pos) AS k FROM tk) SELECT seq_id, pos, item FROM o WHERE k <= 500")
def shuffled_sample(spark, folder):
    """500 places drawn without replacement by a seeded order."""
    places = sequences.positions(_cut_sequences(spark, folder))
    return sequences.shuffled(places, 11, "seq_id", "pos").limit(500)


@_query("SELECT CAST(k AS INTEGER) AS k, round(('0x' || substr(md5(concat_ws('|', '7', CAST(k AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 9) AS u FROM (SELECT event_id AS k FROM events)")
def hash_uniform_numbers(spark, folder):
    """The seeded uniform number of every event."""
    return _table(spark, folder, "events").select(F.col("event_id").cast("int").alias("k"), F.round(hash_uniform(7, F.col("event_id")), 9).alias("u"))


# ---------------------------------------------------------------- vectors

_UNIT = "v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings)"


def _corpus(spark, folder):
    return vectors.normalise(_table(spark, folder, "embeddings"), "vec_id", "embedding")


@_query(f"WITH {_UNIT} SELECT id, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS k, round(unnest(e) / norm, 5) AS x FROM v")
def vec_normalize(spark, folder):
    """Unit vectors."""
    return _corpus(spark, folder).select("id", F.posexplode("v").alias("k", "x")).withColumn("x", F.round("x", 5))


_KNN = """WITH {unit}, d AS (SELECT q.id AS query, c.id AS id, 2 - 2 * list_dot_product(q.e, c.e) / (q.norm * c.norm) AS distance FROM v q JOIN v c ON {on}),
 t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, id) AS INTEGER) AS rank_no FROM d) SELECT query, rank_no, id, round(distance, 5) AS distance FROM t WHERE rank_no <= 10"""


@_query(_KNN.format(unit=_UNIT, on="q.id <> c.id AND q.id % 20 = 0"))
def knn_by_id(spark, folder):
    """The 10 nearest others of every vector whose id 20 divides."""
    ids = _table(spark, folder, "embeddings").where("vec_id % 20 = 0").select("vec_id")
    return vectors.search_by_ids(_corpus(spark, folder), ids, 10).select("query", "rank_no", "id", F.round("distance", 5).alias("distance"))


@_query(_KNN.format(unit=_UNIT, on="q.id % 20 = 0"))
def knn_by_vector(spark, folder):
    """The 10 nearest of given vectors, stored equals included."""
    given = _table(spark, folder, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x * 3).alias("v"))
    return vectors.search_by_vectors(_corpus(spark, folder), given, 10).select("query", "rank_no", "id", F.round("distance", 5).alias("distance"))


@_query("SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 25")
def list_ids(spark, folder):
    """The first 25 ids (the limit is the feature)."""
    return vectors.first_ids(_table(spark, folder, "embeddings"), "vec_id", 25)


@_query("SELECT p_brand AS item_label, count(*) AS n, round(avg(embedding[1]::DOUBLE), 5) AS mean_first FROM embeddings JOIN part ON p_partkey = vec_id GROUP BY 1")
def vec_label_join(spark, folder):
    """Vectors with the labels of another table."""
    labels = _table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("item_label"))
    named = _table(spark, folder, "embeddings").join(labels, F.col("vec_id") == F.col("item_id"))
    return named.groupBy("item_label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("embedding")[0].cast("double")), 5).alias("mean_first"))


@_query("SELECT CAST(vec_id AS VARCHAR) AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS k, round(unnest(embedding)::DOUBLE, 6) AS x FROM embeddings")
def embed_text_codec(spark, folder):
    """Embeddings written as lines and read again; a malformed line is skipped."""
    lines = sinks.text_lines(_table(spark, folder, "embeddings").select("vec_id", "embedding"), "\t", " ")
    broken = spark.createDataFrame([("no fields",), ("7\t1.0 x",)], "value string")
    return readers.parse_embeddings(lines.union(broken)).select("id", F.posexplode("embedding").alias("k", "x")).withColumn("x", F.round(F.col("x").cast("double"), 6))


@_query("SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS k, round((unnest(embedding)::DOUBLE + unnest(list_reverse(embedding))::DOUBLE) / 2, 6) AS x FROM embeddings")
def embedding_average(spark, folder):
    """The mean of two embeddings."""
    both = _table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"), F.reverse("embedding").cast("array<double>").alias("b"))
    return both.select(F.col("vec_id").alias("id"), F.posexplode(average("a", "b")).alias("k", "x")).withColumn("x", F.round("x", 6))


@_query("SELECT CAST(user_id AS VARCHAR) AS key, list(json_extract_string(props, '$.k') ORDER BY ts, event_id) AS vals FROM events GROUP BY 1")
def collect_list_payload(spark, folder):
    """Every user's items, repeats included: the payload of a list store."""
    events = _table(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return sequences.key_lists(events, "user_id", "k", "ts", "event_id").select(F.col("key").cast("string").alias("key"), F.col("values").alias("vals"))


@_query("WITH t AS (SELECT count(*) AS n FROM customer), c AS (SELECT unnest(range(7)) AS chunk) SELECT CAST(chunk AS INTEGER) AS chunk, n // 7 AS size FROM c, t UNION ALL SELECT 7, n % 7 FROM t WHERE n % 7 > 0")
def partition_num(spark, folder):
    """Customers in seven even chunks and a rest."""
    sizes = chunk_sizes(_table(spark, folder, "customer").count(), 7)
    return spark.createDataFrame(list(enumerate(sizes)), "chunk int, size bigint")


# ---------------------------------------------------------------- embeddings (trained: SQL says only which have vectors, and how many numbers)


def _dims(vectors, key):
    """Of each vector its size, if all its numbers are finite."""
    return vectors.select(key, F.when(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.size("embedding")).alias("dims"))


@_query(f"WITH {_COUNTS} SELECT item, 16 AS dims FROM c WHERE cnt >= 5")
def word2vec_vectors(spark, folder):
    """Which items have vectors from users' sequences: those that occur five times."""
    return _dims(embedding.train(_cut_sequences(spark, folder), "items", dim=16, max_iter=1, partitions=1).select(F.col("node").alias("item"), "embedding"), "item")


@_query(_walk_sql(True, 10, 81, "SELECT node, 16 AS dims FROM v GROUP BY 1 HAVING count(*) >= 5"))
def word2vec_from_walks(spark, folder):
    """Which nodes have vectors from random walks: those that occur five times."""
    return _dims(embedding.train(walk.deepwalk(_graph(spark, folder), 10, 80), dim=16, max_iter=1, partitions=1), "node")


def _sgns(spark, folder):
    vocab = _vocab(spark, folder)
    indexed = sequences.index_sequences(_cut_sequences(spark, folder), vocab)
    return sgns.train(sequences.skip_grams(indexed, 3), vocab, dim=16, epochs=2, batch=512, rate=0.01, parts=2)


@_query(f"WITH {_VOCAB} SELECT item AS node, 16 AS dims FROM vo")
def sgns_vectors(spark, folder):
    """Which items have vectors by skip-grams with sampled negatives: the whole vocabulary."""
    return _dims(sgns.read_vectors(_sgns(spark, folder)[0], "avg"), "node")


@_query("SELECT 2 AS epochs, true AS falls")
def sgns_losses(spark, folder):
    """The mean loss of an epoch is less than that of the one before."""
    epochs = _sgns(spark, folder)[1]
    return epochs.agg(F.count(F.lit(1)).cast("int").alias("epochs"), (F.max_by("loss", "epoch") < F.min_by("loss", "epoch")).alias("falls"))


def _item2vec(spark, folder, feed_type):
    settings = item2vec.Item2Vec(embed_dim=16, window_size=3, item_min_count=5, seq_max_len=40, subsample_thr=0.003, lr=0.01)
    return settings.train(_sequences(spark, folder), feed_type, epochs=2, batch_size=512 if feed_type == "list" else 16)


_OFTEN = f"WITH {_COUNTS} SELECT item AS node, 16 AS dims FROM c WHERE cnt >= 5"


@_query(_OFTEN)
def item2vec_list(spark, folder):
    """Which items have vectors of a whole run: those that occur five times in sequences cut to their last 40."""
    return _dims(_item2vec(spark, folder, "list").embeddings("avg"), "node")


@_query(_OFTEN + " UNION ALL SELECT '<zero>', 16")
def item2vec_file(spark, folder):
    """The same with items subsampled anew each epoch, batches of sequences, and the replacement token kept."""
    return _dims(_item2vec(spark, folder, "file").embeddings("embed", True), "node")


@_query("SELECT vec_id, 2 AS dims FROM embeddings")
def embedding_projection(spark, folder):
    """All vectors in two dimensions, by principal components."""
    points = embedding.project(_table(spark, folder, "embeddings"), "vec_id", "embedding", 2, most=None)
    return _dims(points.withColumnsRenamed({"point": "embedding"}), "vec_id")


@_query("SELECT vec_id, 2 AS dims FROM embeddings ORDER BY md5(concat_ws('|', '7', CAST(vec_id AS VARCHAR))), vec_id LIMIT 1000")
def tsne_map(spark, folder):
    """A thousand vectors (the sample is the feature) in two dimensions, by t-SNE."""
    points = embedding.tsne(_table(spark, folder, "embeddings"), "vec_id", "embedding", 1000, iterations=300)
    return _dims(points.withColumnsRenamed({"point": "embedding"}), "vec_id")
