"""Queries that write by a sink and read by a source what they wrote, so that SQL can say what must come back."""

from __future__ import annotations

import json
import sqlite3
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embedding, graph, vectors, walk
from ..session import shared_folder
from ..sources import database, readers, sinks
from . import reference_queries as core

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def keep(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return keep


def _local(name: str, text: str) -> str:
    """A small file that only the driver reads."""
    path = Path(tempfile.mkdtemp(prefix="weftline-")) / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def _in_database(spark: SparkSession, table: str) -> str:
    """The name of a new table in a database of its own, kept in the shared folder."""
    folder = shared_folder(spark)
    database_name = "w" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database_name} LOCATION '{folder}'")
    return f"{database_name}.{table}"


_NATIONS = "SELECT n_regionkey AS region, n_name AS nation, CAST(n_nationkey AS DOUBLE) / 4 AS score FROM nation"


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    return core._table(spark, folder, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("nation"), (F.col("n_nationkey").cast("double") / 4).alias("score"))


@_query("SELECT n_regionkey AS region, count(*) AS nations FROM nation GROUP BY 1")
def io_sql_file(spark, folder):
    """A statement of several lines with a comment, read from a file."""
    core._table(spark, folder, "nation").createOrReplaceTempView("weftline_nation")
    return readers.sql_file(spark, _local("q.sql", "SELECT n_regionkey AS region, -- by region\n       count(*) AS nations\nFROM weftline_nation\nGROUP BY n_regionkey;\n"))


@_query(_NATIONS)
def io_jdbc(spark, folder):
    """A table of a database over JDBC, read in parallel. The driver writes it and backs it up to the shared folder; each JVM that reads restores a copy of its own into its memory."""
    copies, name = shared_folder(spark).removeprefix("file:"), f"w{uuid.uuid4().hex}"
    driver, java = "org.apache.derby.iapi.jdbc.AutoloadedDriver", spark.sparkContext._jvm.java
    java.lang.Class.forName(driver, True, java.lang.Thread.currentThread().getContextClassLoader())
    connection = java.sql.DriverManager.getConnection(f"jdbc:derby:memory:{name};create=true")
    try:
        connection.createStatement().execute('CREATE TABLE nations ("region" INTEGER, "nation" VARCHAR(255), "score" DOUBLE)')
        row = connection.prepareStatement("INSERT INTO nations VALUES (?, ?, ?)")
        for r in _nations(spark, folder).collect():  # 25 rows
            for place, value in enumerate(r, 1):
                row.setObject(place, value)
            row.execute()
        backup = connection.prepareCall("CALL SYSCS_UTIL.SYSCS_BACKUP_DATABASE(?)")
        backup.setString(1, copies)
        backup.execute()
    finally:
        connection.close()
    return readers.jdbc(spark, f"jdbc:derby:memory:{name};createFrom={copies}/{name}", table="nations", driver=driver, split=("region", 0, 5, 2))


@_query("SELECT CAST(n_nationkey AS BIGINT) AS nationkey, n_name AS nation FROM nation")
def io_row_client(spark, folder):
    """Rows of a database through a row client."""
    with database.RowClient(lambda: sqlite3.connect(":memory:")) as client:
        client.execute("CREATE TABLE n (nationkey INTEGER, nation TEXT)")
        for r in core._table(spark, folder, "nation").collect():  # 25 rows
            client.execute("INSERT INTO n VALUES (?, ?)", (r.n_nationkey, r.n_name))
        return client.frame(spark, "SELECT nationkey, nation FROM n", "nationkey bigint, nation string")


@_query(f"WITH {core._SEQ} SELECT items, (SELECT count(*) FROM s0) AS lines FROM s0")
def io_sequences(spark, folder):
    """Sequences as comma-separated lines, and the number of lines."""
    path = shared_folder(spark)
    core._sequences(spark, folder).select(F.array_join("items", ",").alias("value")).write.text(path)
    return readers.sequences(spark, path).withColumn("lines", F.lit(readers.line_count(spark, path)).cast("bigint"))


@_query(core._graph_sql().join(("WITH ", " SELECT src, dst, weight FROM g")))
def io_edge_list(spark, folder):
    """Edges as blank-separated lines."""
    path = shared_folder(spark)
    core._graph(spark, folder).select(F.concat_ws(" ", "src", "dst", "weight").alias("value")).write.text(path)
    return readers.edge_list(spark, path, True)


@_query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS item_label FROM part")
def io_labels(spark, folder):
    """Labels of items in a CSV file with a header and a further column."""
    path = shared_folder(spark)
    core._table(spark, folder, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("item_label"), "p_size").write.csv(path, header=True)
    return readers.labels(spark, path)


@_query("SELECT 'redis.host' AS key, 'h' AS value UNION ALL SELECT 'redis.port', '6379' UNION ALL SELECT 'empty', ''")
def io_properties(spark, folder):
    """Keys and values of a properties file."""
    found = readers.properties(_local("p.properties", "# c\nredis.host = h\nredis.port:6379\n\n! d\nempty\n"))
    return spark.createDataFrame(sorted(found.items()), "key string, value string")


@_query(core._cosine_sql("u", "i", "SELECT i, j, score FROM s"))
def io_scores_text(spark, folder):
    """Scores as tab-separated lines, compressed: lines are many times the rows they come from."""
    path = shared_folder(spark)
    sinks.write_text(core._scores(spark, folder, "item", "cosine"), path, True, options={"compression": "gzip", "zlib.compress.level": "BEST_SPEED"})
    return spark.read.csv(path, sep="\t", schema="i string, j string, score double")


@_query(core._cosine_sql("u", "i", core._TOP))
def io_lists_text(spark, folder):
    """Top-N lists as lines: the id, a tab and its list."""
    path = shared_folder(spark)
    sinks.write_text(core.similarity.top_n(core._best_scores(spark, folder, "item", 20), 20), path)
    lines = spark.read.csv(path, sep="\t", schema="id string, rec_list string")
    return lines.select("id", F.posexplode(F.split("rec_list", ",")).alias("pos", "rec")).select("id", (F.col("pos") + 1).alias("rank_no"), "rec")


@_query("SELECT n_regionkey AS left_id, n_name AS nation, CAST(n_nationkey AS DOUBLE) / 4 AS score, d.dt FROM nation, (SELECT '1' AS dt UNION ALL SELECT '2') d")
def io_scores_table(spark, folder):
    """Scores in a table with a renamed column and a partition: written, appended to, and one partition replaced."""
    table, rows = _in_database(spark, "scores"), _nations(spark, folder)
    sinks.write_table(rows, table, True, {"region": "left_id"}, ("dt", "1"))
    sinks.write_table(rows.limit(3), table, False, {"region": "left_id"}, ("dt", "2"))
    sinks.write_table(rows, table, True, {"region": "left_id"}, ("dt", "2"), dynamic=True)
    return spark.table(table).withColumn("dt", F.col("dt").cast("string"))


@_query("SELECT n_regionkey AS id, list(n_name ORDER BY n_name) AS recs FROM nation GROUP BY 1")
def io_lists_table(spark, folder):
    """Lists in a table; writing anew replaces it whole."""
    table = _in_database(spark, "lists")
    lists = _nations(spark, folder).groupBy("region").agg(F.sort_array(F.collect_list("nation")).alias("recs"))
    sinks.write_table(lists, table, True, {"region": "id"}, ("dt", "old"))
    sinks.write_table(lists, table, True, {"region": "id"})
    return spark.table(table)


_PATHS = core._walk_sql(True, 2, 6, "SELECT string_agg(node, ' ' ORDER BY step) AS path FROM v GROUP BY walk, start")


def _paths(spark, folder):
    return walk.deepwalk(core._graph(spark, folder), 2, 5)


@_query(_PATHS)
def io_walks_text(spark, folder):
    """Walks as lines."""
    path = shared_folder(spark)
    sinks.write_walks(_paths(spark, folder), path)
    return spark.read.text(path).select(F.col("value").alias("path"))


@_query(_PATHS.replace("' '", "'>'").replace(" AS path", " AS nodes, 'x' AS dt"))
def io_walks_table(spark, folder):
    """Walks in a partitioned table, with another delimiter and column name."""
    table = _in_database(spark, "walks")
    sinks.write_walks(_paths(spark, folder), table, True, True, ">", "nodes", ("dt", "x"))
    return spark.table(table)


_NUMBERS = "SELECT CAST(vec_id AS VARCHAR) AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS k, round(unnest(embedding)::DOUBLE, 6) AS x FROM embeddings"


def _named(spark, folder):
    return core._table(spark, folder, "embeddings").select(F.col("vec_id").alias("node"), "embedding")


def _numbers(found: DataFrame) -> DataFrame:
    return found.select("id", F.posexplode("embedding").alias("k", "x")).withColumn("x", F.round(F.col("x").cast("double"), 6))


@_query(_NUMBERS)
def io_embeddings_text(spark, folder):
    """Embeddings as lines, read back by the tolerant reader."""
    path = shared_folder(spark)
    sinks.write_embeddings(_named(spark, folder), path)
    return _numbers(readers.embeddings(spark, path))


@_query(_NUMBERS)
def io_embeddings_strict(spark, folder):
    """The same by the strict reader."""
    path = shared_folder(spark)
    sinks.write_embeddings(_named(spark, folder), path)
    return _numbers(readers.embeddings(spark, path, strict=True))


@_query(_NUMBERS)
def io_embeddings_table(spark, folder):
    """Embeddings in a table that holds them as delimited text."""
    table = _in_database(spark, "vectors")
    sinks.write_embeddings(_named(spark, folder), table, True, True, embed_delimiter=";", names={"node": "item"})
    return _numbers(spark.table(table).select(F.col("item").cast("string").alias("id"), F.split("embedding", ";").cast("array<float>").alias("embedding")))


@_query(f"{_NUMBERS}, (SELECT unnest(['embed', 'softmax']) AS mode) m".replace("SELECT CAST", "SELECT m.mode, CAST"))
def io_export(spark, folder):
    """All modes of a model, since the one that is asked for isn't there, and its facts."""
    path = shared_folder(spark)
    named = _named(spark, folder)
    made = sinks.export_model({"embed": named, "softmax": named}, path, "2024_1_2_3_4", "other", {"dim": 64})
    if json.loads(spark.read.text(f"{path}/2024_1_2_3_4_model_info").first().value) != {"dim": 64}:
        raise ValueError("the model's facts did not come back")
    parts = [_numbers(readers.embeddings(spark, p)).withColumn("mode", F.lit(p.rsplit("_", 1)[1])) for p in made]
    return parts[0].unionByName(parts[1])


class _FolderStore:
    """A key-to-list store of one JSON file a key, in a folder that all tasks share."""

    def __init__(self, folder: str):
        self.folder, self.held = Path(folder.removeprefix("file:")), []
        self.folder.mkdir(parents=True, exist_ok=True)

    def replace(self, key: str, values: list[str], expire_seconds: int) -> None:
        self.held.append((key, values, expire_seconds))

    def flush(self) -> None:
        for key, values, seconds in self.held:
            (self.folder / key).write_text(json.dumps({"key": key, "vals": values, "seconds": seconds}))
        self.held = []

    def close(self) -> None:
        pass


@_query("SELECT 'u_' || CAST(user_id AS VARCHAR) AS key, list(json_extract_string(props, '$.k') ORDER BY ts, event_id) AS vals, CAST(60 AS BIGINT) AS seconds FROM events GROUP BY 1")
def io_list_store(spark, folder):
    """Every user's items in a list store."""
    path = shared_folder(spark)
    sinks.write_lists(core.collect_list_payload(spark, folder), lambda: _FolderStore(path), "u_", 60, partitions=4)
    return spark.read.schema("key string, vals array<string>, seconds bigint").json(path)


@_query("SELECT vec_id AS id FROM embeddings ORDER BY vec_id DESC LIMIT 25")
def io_stored_order(spark, folder):
    """The first 25 ids in the order of their file, which is not that of the ids (the limit is the feature)."""
    path = shared_folder(spark)
    sinks.write_embeddings(_named(spark, folder).coalesce(1).sortWithinPartitions(F.desc("node")), path)
    corpus = vectors.normalise(readers.embeddings(spark, path, id_func=lambda c: c.cast("bigint"), place=True), "id", "embedding", "place")
    return vectors.first_ids(corpus, "id", 25)


@_query("SELECT least(count(*), 1000) AS points FROM embeddings JOIN part ON p_partkey = vec_id")
def io_scatter_plot(spark, folder):
    """A map of at most a thousand labelled vectors, drawn to a file."""
    named = core._table(spark, folder, "embeddings").join(core._table(spark, folder, "part"), F.col("vec_id") == F.col("p_partkey")).select("vec_id", "p_brand", "embedding")
    points = embedding.tsne(named, "vec_id", "embedding", 1000, iterations=50)
    path = _local("map.svg", "")
    sinks.scatter_plot(points.join(named.select("vec_id", "p_brand"), "vec_id"), path, "p_brand")
    return spark.createDataFrame([(Path(path).read_text().count("<circle"),)], "points bigint")


@_query(f"WITH {core._graph_sql()} SELECT src, count(*) AS edges FROM g GROUP BY 1")
def io_graph_of_file(spark, folder):
    """A graph built of a file of edges."""
    path = shared_folder(spark)
    core._followed(spark, folder).select(F.concat_ws("\t", "src", "dst", "weight").alias("value")).write.text(path)
    return graph.build_graph(readers.edge_list(spark, path, True)).groupBy("src").agg(F.count(F.lit(1)).alias("edges"))
