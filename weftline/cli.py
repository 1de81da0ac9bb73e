"""python -m weftline.cli JOB ...: cf, swing, node2vec, deepwalk and lists, each fed by a file of one SQL statement."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from .operators import embedding, graph, similarity, swing, walk
from .operators.interactions import interactions, roles
from .session import build_session
from .sources import readers, sinks

log = logging.getLogger("weftline")


def _flag(text: str) -> bool:
    if text.lower() in ("true", "1", "yes"):
        return True
    if text.lower() in ("false", "0", "no"):
        return False
    raise argparse.ArgumentTypeError(f"{text}: true or false")


def _common(p: argparse.ArgumentParser, overwrite: bool) -> None:
    p.add_argument("-f", "--hql", required=True, help="file of one SQL statement")
    p.add_argument("-m", "--save-mode", required=True, choices=("hive", "text"))
    p.add_argument("-o", "--out", required=True, help="table or folder")
    p.add_argument("-r", "--overwrite", type=_flag, default=overwrite)
    p.add_argument("--partition-col", default="")
    p.add_argument("--partition-val", default="")
    p.add_argument("--field-delimiter", default="\t")


def _scored(p: argparse.ArgumentParser, names: tuple[str, str, str, str, str], n: int) -> None:
    i, j, score, main, rec = names
    flags = ("--item-i", "--item-j", "--item-col", "--itemlist-col") if main == "item" else ("--col-i", "--col-j", "--main-col", "--rec-col")
    p.add_argument(flags[0], dest="col_i", default=i)
    p.add_argument(flags[1], dest="col_j", default=j)
    p.add_argument("--score-col", default=score)
    p.add_argument("--collection-delimiter", default=",")
    tasks = p.add_subparsers(dest="task", required=True)
    tasks.add_parser("score", help="similarity only")
    top = tasks.add_parser("topn", help="the best of each")
    top.add_argument("--n", type=int, default=n)
    top.add_argument("--save-score", default="", help="where to keep the similarity, if at all")
    top.add_argument(flags[2], dest="main_col", default=main)
    top.add_argument(flags[3], dest="rec_col", default=rec)


def _walked(p: argparse.ArgumentParser, biased: bool) -> None:
    if biased:
        p.add_argument("-p", "--return-param", dest="p", type=float, default=1.0)
        p.add_argument("-q", "--inout-param", dest="q", type=float, default=1.0)
    p.add_argument("-d", "--degree", type=int, default=30)
    p.add_argument("-n", "--num-walks", type=int, default=10)
    p.add_argument("-l", "--walk-length", type=int, default=80)
    p.add_argument("--directed", type=_flag, default=True)
    p.add_argument("--weighted", type=_flag, default=True)
    p.add_argument("--seed", type=int, default=7)
    p.add_argument("--path-col", default="path")
    p.add_argument("--path-delimiter", default=" ")
    tasks = p.add_subparsers(dest="task", required=True)
    tasks.add_parser("random-walk", help="walks only")
    e = tasks.add_parser("embedding", help="walks and vectors")
    e.add_argument("--save-path", default="", help="where to keep the walks, if at all")
    e.add_argument("--node-col", default="node" if biased else "item")
    e.add_argument("--embed-col", default="embedding")
    e.add_argument("--embed-delimiter", default=" ")
    e.add_argument("--embed-dim", type=int, default=32)
    e.add_argument("--max-iter", type=int, default=3)
    e.add_argument("--min-count", type=int, default=5)
    e.add_argument("--window-size", type=int, default=5)
    e.add_argument("--step-size", type=float, default=0.025)
    e.add_argument("--num-partition", type=int, default=64)


def parser() -> argparse.ArgumentParser:
    """All jobs and their defaults."""
    top = argparse.ArgumentParser(prog="weftline")
    jobs = top.add_subparsers(dest="job", required=True)
    cf = jobs.add_parser("cf", help="collaborative filtering")
    _common(cf, False)
    cf.add_argument("-t", "--model-type", required=True, choices=("user", "item"))
    cf.add_argument("--formula", required=True, choices=similarity.FORMULAS)
    _scored(cf, ("i", "j", "score", "id", "rec_list"), 20)
    sw = jobs.add_parser("swing", help="Swing similarity")
    _common(sw, False)
    sw.add_argument("-u", "--max-user", type=int, default=800)
    _scored(sw, ("item_i", "item_j", "score", "item", "item_list"), 100)
    for name, biased in (("node2vec", True), ("deepwalk", False)):
        p = jobs.add_parser(name, help="random walks and vectors")
        _common(p, True)
        _walked(p, biased)
    lists = jobs.add_parser("lists", help="key-to-list rows into Redis")
    lists.add_argument("-f", "--hql", required=True)
    lists.add_argument("-p", "--prefix", required=True)
    lists.add_argument("--config", required=True, help="properties: redis.host, redis.port, redis.password, redis.timeout, redis.expire_time, redis.try_times")
    return top


def _save(df: DataFrame, a: argparse.Namespace, out: str, names: dict[str, str]) -> None:
    if a.save_mode == "hive":
        sinks.write_table(df, out, a.overwrite, names, (a.partition_col, a.partition_val))
    else:
        sinks.write_text(df, out, a.overwrite, a.field_delimiter, a.collection_delimiter)


def _pairs_job(a: argparse.Namespace, df: DataFrame) -> None:
    if a.job == "cf":
        scores, keys = similarity.similarity(roles(interactions(df), a.model_type), a.formula), ("i", "j", "id", "rec_list")
    else:
        scores, keys = swing.swing(interactions(df, with_rating=False), a.max_user), ("item_i", "item_j", "item", "item_list")
    i, j, main, rec = keys
    renamed = {i: a.col_i, j: a.col_j, "score": a.score_col}
    if a.task == "score":
        _save(scores, a, a.out, renamed)
        return
    if a.save_score:
        scores = scores.persist()
        _save(scores, a, a.save_score, renamed)
    _save(similarity.top_n(scores, a.n, i, j, "score", main, rec), a, a.out, {main: a.main_col, rec: a.rec_col})
    if a.save_score:
        scores.unpersist()


def _walk_job(a: argparse.Namespace, df: DataFrame) -> None:
    built = graph.build_graph(df, a.directed, a.weighted, a.degree).persist()
    walks = walk.random_walks(built, a.num_walks, a.walk_length, getattr(a, "p", 1.0), getattr(a, "q", 1.0), a.seed)
    table, part = a.save_mode == "hive", (a.partition_col, a.partition_val)
    if a.task == "random-walk":
        sinks.write_walks(walks, a.out, a.overwrite, table, a.path_delimiter, a.path_col, part)
    else:
        walks = walks.persist()
        if a.save_path:
            sinks.write_walks(walks, a.save_path, a.overwrite, table, a.path_delimiter, a.path_col, part)
        vectors = embedding.train(walks, "path", a.embed_dim, a.max_iter, a.min_count, a.window_size, a.step_size, a.num_partition, a.seed)
        sinks.write_embeddings(vectors, a.out, a.overwrite, table, a.field_delimiter, a.embed_delimiter, {"node": a.node_col, "embedding": a.embed_col}, part)
        walks.unpersist()
    built.unpersist()


def run(spark: SparkSession, arguments: list[str], connect=None) -> None:
    """Runs a job in a session; ``connect`` makes the list store, if not Redis."""
    a = parser().parse_args(arguments)
    df = readers.sql_file(spark, a.hql)
    log.info("%s: %s", a.job, vars(a))
    if a.job in ("cf", "swing"):
        _pairs_job(a, df)
    elif a.job == "lists":
        c = readers.properties(a.config)

        def redis() -> sinks.RedisStore:
            return sinks.RedisStore(c["redis.host"], int(c.get("redis.port", 6379)), c.get("redis.password"), float(c.get("redis.timeout", 10_000)) / 1000)

        sinks.write_lists(df, connect or redis, a.prefix, int(c.get("redis.expire_time", 86_400)), int(c.get("redis.try_times", 3)))
    else:
        _walk_job(a, df)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    run(build_session("weftline", hive=True), sys.argv[1:])
