"""The inverted multi-index."""

import numpy as np
import pytest

from weftline.llm import neighbours

SCHEMA = "node string, embedding array<float>, loaded_at int, key string, v int"


def test_cleaning(spark):
    good = [3.0, 4.0]
    rows = [
        ("a", good, 1), ("a", None, 2), ("b", None, 1), ("b", good, 2), ("c", [1.0], 1), ("d", [0.0, 0.0], 1), ("e", [float("nan"), 1.0], 1), ("f", [float("inf"), 1.0], 1),
        ("g", [None, 1.0], 1), ("h", good, None), (None, good, 1), ("i", [1e-30, 0.0], 1), ("j", good, 1), ("j", good, 1), ("k", [3e38, -0.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = {r.key: r.v for r in neighbours.clean_vectors(df, "node", "embedding", "loaded_at", 2).collect()}
    assert set(got) == {"b", "h", "i", "j", "k"}
    assert got["b"] == pytest.approx([0.6, 0.8]) and got["i"] == [1.0, 0.0] and got["k"] == [1.0, 0.0]


def frame(spark, x):
    df = spark.createDataFrame([(f"n{k:05d}", v.tolist(), 0, "", 0) for k, v in enumerate(x)], SCHEMA)
    return neighbours.clean_vectors(df, "node", "embedding", "loaded_at", x.shape[1])


def cosines(x):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    out = u @ u.T
    np.fill_diagonal(out, -2)
    return out


def recall_of(near, cosine, k):
    """Share of the k nearest that are found; ties at the last place count."""
    last = np.sort(cosine, axis=1)[:, -k]
    a, b = near.a.str[1:].astype(int), near.b.str[1:].astype(int)
    return (cosine[a, b] >= last[a] - 1e-6).sum() / (k * len(cosine))


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_all_cells_are_exact(spark, monkeypatch, broadcast):
    """With every cell walked, hot pieces split and many copies, the result is the exact one."""
    monkeypatch.setattr(neighbours, "BROADCAST_CLASSES", broadcast)
    monkeypatch.setattr(neighbours, "ENTRY_PIECE", 16)
    monkeypatch.setattr(neighbours, "QUERY_PIECE", 8)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 8)).astype(np.float32)
    x[60:90] = x[0] + rng.normal(size=(30, 8)).astype(np.float32) * 0.01  # one dense shelf
    x[90:] = x[1]  # many copies
    near = neighbours.nearest(frame(spark, x), 5, reach=float("inf"), centroids=4, shelves=3).collect()
    best = np.sort(cosines(x), axis=1)[:, ::-1]
    assert len(near) == 600 and len({(r.a, r.b) for r in near}) == 600
    for r in near:
        assert r.a != r.b and r.cosine == pytest.approx(best[int(r.a[1:]), r.rank_no - 1], abs=1e-5)
    copies = [f"n{k:05d}" for k in (1, *range(90, 120))]
    for a in copies:  # the first other copies by name
        assert [r.b for r in sorted(near, key=lambda r: r.rank_no) if r.a == a] == [c for c in copies if c != a][:5]
    pairs = {(r.node_a, r.node_b) for r in neighbours.alike(neighbours.nearest(frame(spark, x), 5, 0.9999), 0.9999).collect()}
    assert all(a < b for a, b in pairs) and ("n00001", "n00090") in pairs


def test_small_inputs(spark):
    empty = spark.createDataFrame([], "key string, v array<float>")
    assert neighbours.nearest(empty).count() == 0
    one = spark.createDataFrame([("a", [1.0, 0.0])], "key string, v array<float>")
    assert neighbours.nearest(one).count() == 0
    two = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0])], "key string, v array<float>")
    assert {(r.a, r.b, r.rank_no) for r in neighbours.nearest(two).collect()} == {("a", "b", 1), ("b", "a", 1)}


def test_recall_where_little_is_compared(spark):
    """Clusters as in the tables: recall of at least 0.9 while a query meets a small part of the rows."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    x = (centres[rng.integers(0, 60, 6000)] + 0.8 * rng.normal(size=(6000, 32))).astype(np.float32)
    met = []
    real = neighbours._met
    try:
        neighbours._met = lambda placed, visits, shelves, k: met.append(visits.groupBy("shelf").count().join(placed.groupBy("shelf").agg({"*": "count"}), "shelf").selectExpr("sum(count * `count(1)`)").first()[0]) or real(placed, visits, shelves, k)
        near = neighbours.nearest(frame(spark, x), 10, shelves=60).toPandas()
    finally:
        neighbours._met = real
    assert met[0] / 6000**2 < 0.1
    assert len(near) == 60_000 and not near.duplicated(["a", "b"]).any() and (near.a != near.b).all()
    assert recall_of(near, cosines(x), 10) >= 0.9


def test_alike_pairs_are_found_without_exception(spark):
    """Vectors without any clusters, where a walk alone would miss many: every pair of cosine 0.9 or more is found."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 12)).astype(np.float32)
    x[1500:] = x[:1500] + 0.13 * np.linalg.norm(x[:1500], axis=1, keepdims=True) * rng.normal(size=(1500, 12))  # cosines around 0.9
    cosine = cosines(x)
    wanted = {(f"n{a:05d}", f"n{b:05d}") for a, b in np.argwhere(cosine >= 0.9 + 1e-6) if a < b}
    found = {(r.node_a, r.node_b) for r in neighbours.alike(neighbours.nearest(frame(spark, x), 10, 0.9, reach=0.0, centroids=16, shelves=40), 0.9).collect()}
    assert len(wanted) > 300 and wanted <= found and len(found - wanted) < 3
    without = neighbours.alike(neighbours.nearest(frame(spark, x), 10, None, reach=0.0, centroids=16, shelves=40), 0.9).count()
    assert without < len(wanted)


def test_walk_is_by_summed_distance():
    """The heap pops cells in the order in which a full sort has them."""
    rng = np.random.default_rng(1)
    d1, d2 = rng.random(7).astype(np.float32), rng.random(5).astype(np.float32)
    held = {c: (0,) for c in range(35) if c % 3}
    summed = sorted((float(d1[c // 5]) + float(d2[c % 5]), c) for c in range(35))
    reach = summed[20][0] - summed[0][0] + 1e-9
    assert neighbours._walk(d1, d2, held, reach) == [c for s, c in summed[:21] if c in held]


def test_vectors_are_written_once(spark, monkeypatch):
    """Vectors go to the checkpoint folder once, a shelf's own entries are not sent to it again, and a least cosine leaves the other rows as they are."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6, 8))[rng.integers(0, 6, 400)] + rng.normal(size=(400, 8)) * 0.1
    x[390:] = x[0]
    written, sent = [], []
    cut, meeting = neighbours.cut, neighbours._meeting
    monkeypatch.setattr(neighbours, "cut", lambda df: written.append("v" in df.columns) or cut(df))
    monkeypatch.setattr(neighbours, "_meeting", lambda *args: sent.append(args) or meeting(*args))
    vectors = frame(spark, x.astype(np.float32))
    every = {(r.a, r.b): (r.rank_no, r.cosine) for r in neighbours.nearest(vectors, 5, 0.95, centroids=4, shelves=6).collect()}
    assert sum(written) == 2 and len(every) == 2000  # all vectors, and the first of equal ones
    close = {(r.a, r.b): (r.rank_no, r.cosine) for r in neighbours.nearest(vectors, 5, 0.95, centroids=4, shelves=6, at_least=0.99).collect()}
    assert sent[1][1] == 0.99 and close == {pair: found for pair, found in every.items() if found[1] >= 0.99} and 0 < len(close) < 2000
    monkeypatch.setattr(neighbours, "ENTRY_PIECE", 16)  # shelves of several pieces give the same
    monkeypatch.setattr(neighbours, "QUERY_PIECE", 8)
    assert every == {(r.a, r.b): (r.rank_no, r.cosine) for r in neighbours.nearest(vectors, 5, 0.95, centroids=4, shelves=6).collect()}
