"""Sources, sinks, command line and streaming: round trips."""

import json
import sqlite3
import threading
import urllib.error
import urllib.request

import pytest

from weftline import cli
from weftline.operators import embedding, vectors
from weftline.plans import io_queries
from weftline.service import NeighbourService
from weftline.sources import database, readers, sinks
from weftline.streaming import incremental


def test_sql_file_and_properties(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT 1 AS a, -- a comment\n 'x;y' AS b\nFROM range(2);\n")
    assert [tuple(r) for r in readers.sql_file(spark, str(tmp_path / "q.sql")).collect()] == [(1, "x;y")] * 2
    (tmp_path / "p.properties").write_text("# c\nredis.host = h\nredis.port:6379\n\n! d\nempty\n")
    assert readers.properties(str(tmp_path / "p.properties")) == {"redis.host": "h", "redis.port": "6379", "empty": ""}


def test_text_sources(spark, tmp_path):
    (tmp_path / "s.txt").write_text("a,b,c\n\nx\n")
    assert [r["items"] for r in readers.sequences(spark, str(tmp_path / "s.txt")).collect()] == [["a", "b", "c"], [""], ["x"]]
    assert readers.line_count(spark, str(tmp_path / "s.txt")) == 3
    (tmp_path / "e.txt").write_text("1\t0.5 1\nbad line\n2\t1 x\n1\t7 8\n")
    assert [(r.id, r.embedding) for r in readers.embeddings(spark, str(tmp_path / "e.txt")).collect()] == [("1", [7.0, 8.0])]
    (tmp_path / "f.txt").write_text("9\t1 2\nx\t1 2\n3\t1  2\n4\t5 6\n9\t7 8\n")
    held = readers.embeddings(spark, str(tmp_path / "f.txt"), id_func=lambda c: c.try_cast("bigint") * 2, place=True)
    assert [(r.id, r.embedding) for r in held.orderBy("place").collect()] == [(18, [7.0, 8.0]), (8, [5.0, 6.0])]
    assert [r.id for r in readers.embeddings(spark, str(tmp_path / "f.txt"), strict=True, place=True).orderBy("place").collect()] == ["9", "x", "3", "4", "9"]
    (tmp_path / "g.txt").write_text("a b 2.5\n# note\nb c 1\nlonely\n")
    assert sorted(map(tuple, readers.edge_list(spark, str(tmp_path / "g.txt"), True).collect())) == [("a", "b", 2.5), ("b", "c", 1.0)]
    (tmp_path / "l.csv").write_text("item_id,item_label,x\n1,red,0\n")
    assert readers.labels(spark, str(tmp_path / "l.csv")).first().item_label == "red"


def test_jdbc_options(spark):
    with pytest.raises(Exception, match="(?i)driver|connection|jdbc"):
        readers.jdbc(spark, "jdbc:none://nowhere/db", table="t", user="u", password="p")


def test_table_sink(spark):
    df = spark.createDataFrame([("a", "b", 0.5)], "i string, j string, score double")
    sinks.write_table(df, "scores", True, {"i": "left_id"}, ("dt", "1"))
    sinks.write_table(df, "scores", False, {"i": "left_id"}, ("dt", "2"))
    assert sorted(r.dt for r in spark.table("scores").collect()) == ["1", "2"]
    sinks.write_table(df, "scores", True, {"i": "left_id"}, ("dt", "2"), dynamic=True)
    assert sorted(r.dt for r in spark.table("scores").collect()) == ["1", "2"]
    sinks.write_table(df, "scores", True, {"i": "left_id"}, ("dt", "3"))
    assert [r.dt for r in spark.table("scores").collect()] == ["3"]


class Store:
    """A list store in files: one per key, so that tasks in other processes can write it."""

    def __init__(self, folder, fail=0):
        self.folder, self.fail, self.held = folder, fail, []

    def replace(self, key, values, expire_seconds):
        self.held.append((key, values, expire_seconds))

    def flush(self):
        mark = self.folder / "failures"
        n = int(mark.read_text()) if mark.exists() else 0
        if n < self.fail:
            mark.write_text(str(n + 1))
            raise ConnectionError("lost")
        for key, values, ttl in self.held:
            (self.folder / key).write_text(json.dumps([values, ttl]))
        self.held = []

    def close(self):
        pass


def test_list_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, [3, 4, None]), (2, []), (None, [1]), (3, None)], "k bigint, v array<bigint>")
    sinks.write_lists(df, lambda: Store(tmp_path, 2), "p:", 60, tries=3, partitions=1)
    assert json.loads((tmp_path / "p:1").read_text()) == [["3", "4"], 60] and (tmp_path / "p:2").exists()
    with pytest.raises(Exception, match="lost"):
        sinks.write_lists(df, lambda: Store(tmp_path, 99), "p:", tries=2, partitions=1)


def test_command_line(spark, tmp_path):
    rows = [("u1", 1, 1.0), ("u1", 2, 2.0), ("u2", 1, 3.0), ("u2", 2, 1.0)]
    spark.createDataFrame(rows, "user string, item bigint, rating double").createOrReplaceTempView("rated")
    spark.createDataFrame([("a", "b", 1.0), ("b", "a", 2.0), ("b", "c", 1.0), ("c", "a", 1.0)], "s string, d string, w double").createOrReplaceTempView("edges")
    (tmp_path / "r.sql").write_text("SELECT * FROM rated")
    (tmp_path / "e.sql").write_text("SELECT * FROM edges")
    r, e = str(tmp_path / "r.sql"), str(tmp_path / "e.sql")
    cli.run(spark, ["cf", "-f", r, "-m", "text", "-t", "item", "--formula", "jaccard", "-o", str(tmp_path / "top"), "topn", "--n", "1", "--save-score", str(tmp_path / "score")])
    assert sorted(x.value for x in spark.read.text(str(tmp_path / "top")).collect()) == ["1\t2", "2\t1"]
    assert sorted(x.value for x in spark.read.text(str(tmp_path / "score")).collect()) == ["1\t2\t1.0", "2\t1\t1.0"]
    cli.run(spark, ["swing", "-f", r, "-m", "hive", "-o", "swing_scores", "-r", "true", "--partition-col", "dt", "--partition-val", "x", "score"])
    assert [(x.item_i, x.item_j, x.dt) for x in spark.table("swing_scores").orderBy("item_i").collect()] == [(1, 2, "x"), (2, 1, "x")]
    cli.run(spark, ["node2vec", "-f", e, "-m", "text", "-o", str(tmp_path / "w"), "-p", "0.5", "--num-walks", "2", "--walk-length", "3", "random-walk"])
    assert spark.read.text(str(tmp_path / "w")).count() == 6
    cli.run(spark, ["deepwalk", "-f", e, "-m", "hive", "-o", "vectors", "--num-walks", "5", "embedding", "--embed-dim", "4", "--min-count", "1", "--num-partition", "1", "--save-path", "paths"])
    assert sorted(spark.table("vectors").columns) == ["embedding", "item"] and spark.table("vectors").count() == 3
    assert spark.table("paths").count() == 15
    (tmp_path / "c.properties").write_text("redis.expire_time=5\n")
    (tmp_path / "l.sql").write_text("SELECT user, collect_list(item) AS items FROM rated GROUP BY user")
    folder = tmp_path / "lists"
    folder.mkdir()
    cli.run(spark, ["lists", "-f", str(tmp_path / "l.sql"), "-p", "x_", "--config", str(tmp_path / "c.properties")], connect=lambda: Store(folder))
    assert json.loads((folder / "x_u1").read_text())[1] == 5


def test_export(spark, tmp_path):
    v = spark.createDataFrame([("n", [1.0, 2.0])], "node string, embedding array<float>")
    made = sinks.export_model({"embed": v, "avg": v}, str(tmp_path), "2024_1_2_3_4", "other", {"dim": 2})
    assert len(made) == 2 and readers.embeddings(spark, made[0]).first().embedding == [1.0, 2.0]
    with pytest.raises(ValueError):
        sinks.export_model({}, str(tmp_path), "x")


def test_incremental_counts(spark, tmp_path):
    folder = str(tmp_path / "state")
    schema = "u string, i bigint"
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 3)], schema)
    second = spark.createDataFrame([("a", 2), ("a", 3), ("b", 2), ("b", 2)], schema)
    incremental.apply_batch(spark, first, folder, 0)
    for _ in range(2):  # a batch may run twice
        incremental.apply_batch(spark, second, folder, 1)
    assert sorted(map(tuple, incremental.pair_counts(spark, folder).collect())) == [(1, 2, 2), (1, 3, 1), (2, 3, 1)]


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([("a", 1), ("a", 2)], "u string, i bigint").write.parquet(str(source))
    stream = spark.readStream.schema("u string, i bigint").parquet(str(source))
    query = incremental.follow(stream, str(tmp_path / "state"), str(tmp_path / "cp"), availableNow=True)
    query.awaitTermination(60)
    assert [tuple(r) for r in incremental.pair_counts(spark, str(tmp_path / "state")).collect()] == [(1, 2, 1)]


def test_row_client(spark, tmp_path):
    with database.RowClient(lambda: sqlite3.connect(tmp_path / "d.db")) as client:
        client.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        client.execute("INSERT INTO t VALUES (?, ?)", (1, "x"))
        assert client.query("SELECT * FROM t WHERE a = ?", (1,)) == [{"a": 1, "b": "x"}]
        assert list(client.query("SELECT * FROM t WHERE a = 9", as_pandas=True).columns) == ["a", "b"]
        assert client.frame(spark, "SELECT b FROM t", "b string").first().b == "x"
        with pytest.raises(sqlite3.Error):
            client.execute("INSERT INTO nowhere VALUES (1)")


def test_service(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0])]
    held = {"rows": rows}
    service = NeighbourService(lambda: vectors.normalise(spark.createDataFrame(held["rows"], "id bigint, e array<double>"), "id", "e"))
    server = service.server(port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"

    def ask(path, body=None):
        data = None if body is None else json.dumps(body).encode()
        try:
            with urllib.request.urlopen(urllib.request.Request(base + path, data=data), timeout=60) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode()

    try:
        assert ask("/ping") == (200, "pong")
        assert list(json.loads(ask("/search_by_id", {"ids": [1], "k": 2})[1])["1"][0]) == ["2"]
        assert [list(x)[0] for x in json.loads(ask("/search_by_vector", {"vectors": [[0, 5]], "k": 1})[1])["0"]] == ["3"]
        assert ask("/get_goods_id", {"n": 2}) == (200, "[1, 2]")
        assert ask("/search_by_id", {"ids": [77], "k": 2})[0] == 500 and ask("/search_by_id", {})[0] == 500
        held["rows"] = rows + [(4, [0.0, 2.0])]
        service.refresh()
        assert "4" in ask("/search_by_id", {"ids": [3], "k": 1})[1]
    finally:
        server.shutdown()
        service.stop()


def test_stored_order_and_plot(spark, tmp_path):
    rows = [(3, [1.0, 0.0], 0), (1, [0.0, 1.0], 1), (2, [1.0, 1.0], 2)]
    service = NeighbourService(lambda: vectors.normalise(spark.createDataFrame(rows, "id bigint, e array<double>, at int"), "id", "e", "at"))
    assert service.get_goods_id(2) == [3, 1]
    service.stop()
    points = spark.createDataFrame([("a<b", [1.0, 2.0]), ("c", [0.0, 0.0]), ("d", None)], "label string, point array<double>")
    assert sinks.scatter_plot(points, str(tmp_path / "p.svg")) == 2 and "a&lt;b" in (tmp_path / "p.svg").read_text()
    assert sinks.scatter_plot(points.limit(0), str(tmp_path / "q.svg")) == 0


def test_projection(spark):
    df = spark.createDataFrame([(k, [float(k), 1.0, 0.5 * k]) for k in range(30)] + [(99, None)], "node bigint, embedding array<double>")
    points = embedding.project(df, most=10).collect()
    assert len(points) <= 10 and all(len(r.point) == 2 for r in points)
    assert embedding.project(df.where("node = 99")).count() == 0


def test_jdbc_query_reads_where_its_database_is_not(spark, monkeypatch):
    """Executors of their own don't share the driver's memory: the reader must find the rows under a name that no database of this JVM has."""
    real = readers.jdbc
    monkeypatch.setattr(readers, "jdbc", lambda spark, url, **more: real(spark, url.replace("memory:", "memory:elsewhere-"), **more))
    assert io_queries.io_jdbc(spark, "/root/testdata/sf0.001").count() == 25


def test_scores_text_is_compressed_and_whole(spark, tmp_path, monkeypatch):
    path = tmp_path / "scores"
    monkeypatch.setattr(io_queries, "shared_folder", lambda spark: f"file://{path}")
    rows = io_queries.io_scores_text(spark, "/root/testdata/sf0.001")
    lines = [r.value for r in spark.read.text(str(path)).collect()]
    whole = io_queries.core.cf_item_cosine(spark, "/root/testdata/sf0.001")
    assert sorted(lines) == sorted(r.value for r in sinks.text_lines(whole).collect())
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, whole.collect()))
    assert sum(p.stat().st_size for p in path.glob("part-*")) < 0.5 * sum(len(x) + 1 for x in lines)
