"""Similarity, Swing, graphs, walks, sequences and vectors by hand."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions.scalar import chunk_sizes, hash_uniform, stamp
from weftline.operators import eager, embedding, graph, item2vec, pairing, sampling, sequences, sgns, similarity, swing, vectors, walk
from weftline.operators.interactions import interactions, roles

RATED = [("u1", 1, 1.0), ("u1", 2, 2.0), ("u1", 3, 1.0), ("u2", 1, 3.0), ("u2", 2, 1.0), ("u3", 1, 1.0), ("u3", 2, 2.0), ("u3", 3, 1.0)]


def rated(spark, rows=RATED):
    return interactions(spark.createDataFrame(rows, "user string, item bigint, rating double"))


def table(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


@pytest.mark.parametrize(
    "formula, values",
    [("cosine", (0.703526, 0.426401, 0.942809)), ("jaccard", (1.0, 0.666667, 0.666667)), ("jaccard-penalty", (0.784311, 0.480898, 0.480898))],
)
def test_formulas(spark, formula, values):
    got = table(similarity.similarity(roles(rated(spark)), formula), "i", "j")
    assert len(got) == 6
    for pair, value in zip((("1", "2"), ("1", "3"), ("2", "3")), values):
        assert got[pair].score == pytest.approx(value, abs=1e-6) == got[pair[::-1]].score


def test_swing_by_hand(spark):
    rows = rated(spark).select("u", "i")
    got = table(swing.swing(rows), "item_i", "item_j")
    assert {k: round(r.score, 6) for k, r in got.items() if k[0] < k[1]} == {(1, 2): 0.916667, (1, 3): 0.25, (2, 3): 0.25}
    assert len(got) == 6
    assert swing.swing(rows.limit(0)).count() == 0
    capped = swing.cap_users(rows, 2)
    assert capped.groupBy("i").count().agg(F.max("count")).first()[0] == 2
    assert sorted(map(tuple, capped.collect())) == sorted(map(tuple, swing.cap_users(rows.repartition(3), 2).collect()))


def test_similarity_edges(spark):
    rows = rated(spark, [("a_b,c", 1, 0.0), ("a_b,c", 2, 1.0), ("x", 2, 2.0), (None, 3, 1.0), ("y", None, 1.0), ("z", 9, None), ("z", 8, float("nan"))])
    assert similarity.cosine(roles(rows)).count() == 0  # item 1 has norm 0
    assert similarity.jaccard(roles(rows)).count() == 2
    assert similarity.cosine(roles(rows.limit(0))).count() == 0
    twice = rated(spark, [("u", 1, 1.0), ("u", 1, 2.0), ("u", 2, 1.0)])
    assert twice.where("i = 1").first().r == 3.0
    users = similarity.similarity(roles(rated(spark), "user"), "jaccard")
    assert table(users, "i", "j")[("u1", "u3")].score == 1.0
    with pytest.raises(ValueError):
        similarity.similarity(roles(rated(spark)), "other")


def test_top_n_ties(spark):
    scores = spark.createDataFrame([("a", "c", 1.0), ("a", "b", 1.0), ("a", "d", 2.0), ("b", "x", 0.5)], "i string, j string, score double")
    got = table(similarity.top_n(scores, 2), "id")
    assert got[("a",)].rec_list == ["d", "b"] and got[("b",)].rec_list == ["x"]


EDGES = [("a", "b", 1.0), ("a", "c", 1.0), ("b", "a", 1.0), ("b", "c", 1.0), ("b", "d", 1.0), ("c", "a", 1.0)]


def test_second_order_weights(spark):
    g = graph.build_graph(spark.createDataFrame(EDGES, "s string, d string, w double"))
    got = {(r.prev, r.cur, r.nxt): r.prob for r in graph.edge_transitions(g, 0.5, 2.0).collect()}
    assert [got["a", "b", x] for x in "acd"] == pytest.approx([4 / 7, 2 / 7, 1 / 7])
    assert not [k for k in got if k[1] == "d"]


def test_graph_edges(spark):
    rows = [("a", str(k), float(k)) for k in range(1, 5)] + [("a", "4", 4.0), ("a", "4", 1.0), (None, "x", 1.0), ("b", "c", None), ("b", "c", -1.0)]
    df = spark.createDataFrame(rows, "s string, d string, w double")
    assert {(r.dst, r.weight) for r in graph.build_graph(df, degree=3).collect()} == {("4", 4.0), ("3", 3.0), ("2", 2.0)}
    assert {(r.dst, r.weight) for r in graph.build_graph(df, degree=5).collect()} == {("4", 5.0), ("3", 3.0), ("2", 2.0), ("1", 1.0)}
    assert graph.build_graph(df.limit(0)).count() == 0
    both = graph.build_graph(spark.createDataFrame([("a", "b"), ("b", "a")], "s string, d string"), directed=False, weighted=False)
    assert sorted(map(tuple, both.collect())) == [("a", "b", 1.0), ("b", "a", 1.0)]


@pytest.mark.parametrize("p, q", [(1.0, 1.0), (0.5, 2.0)])
def test_walks_agree(spark, p, q):
    g = graph.build_graph(spark.createDataFrame(EDGES, "s string, d string, w double"))
    near = sorted(map(tuple, walk.random_walks(g, 4, 11, p, q).collect()))
    far = sorted(map(tuple, walk.random_walks(g, 4, 11, p, q, broadcast_edges=0).collect()))
    assert near == far and len(near) == 12
    known = {(a, b) for a, b, _ in EDGES}
    for _, start, path in near:
        assert path[0] == start and len(path) <= 13 and all(e in known for e in zip(path, path[1:]))
        assert len(path) == 13 or path[-1] == "d"
    assert max(len(r.path) for r in walk.deepwalk(g, 2, 5, exact_nodes=True, sinks=True).collect()) <= 5
    assert walk.random_walks(g.limit(0), 2, 3).count() == 0


def test_alias_table():
    weights = np.array([5.0, 1, 3, 1])
    accept, alias = sampling.alias_table(weights)
    mass = accept.copy()
    np.add.at(mass, alias, 1 - accept)
    assert mass / 4 == pytest.approx(weights / 10)
    rng = np.random.default_rng(1)
    drawn = np.bincount(sampling.alias_draw(accept, alias, rng.random(40_000), rng.random(40_000)), minlength=4) / 40_000
    assert drawn == pytest.approx(weights / 10, abs=0.01)


def test_sequences(spark):
    seqs = spark.createDataFrame([(1, list("12345")), (2, list("12")), (3, None)], "seq_id bigint, items array<string>")
    assert sequences.truncate(seqs, 3, 3, "left").first()["items"] == ["3", "4", "5"]
    assert sequences.truncate(seqs, 3, 3, "right").first()["items"] == ["1", "2", "3"]
    assert sequences.truncate(seqs, 3, 3, "none").first()["items"] == list("12345")
    assert sequences.sequence_stats(seqs.limit(0)).first().asDict() == {"num_seq": 0, "mean_len": 0.0}
    ix = spark.createDataFrame([(1, k, k + 1) for k in range(3)], "seq_id bigint, pos int, ix bigint")
    pairs = sorted((r.centre, r.target) for r in sequences.skip_grams(ix, 1).collect())
    assert pairs == [(1, 2), (2, 1), (2, 3), (3, 2)]
    with pytest.raises(ValueError):
        sequences.random_window(1)
    vocab = sequences.vocabulary(spark.createDataFrame([("a", 5), ("b", 7), ("c", 5), ("d", 1)], "item string, cnt bigint"), 3)
    assert [(r.item, r.ix) for r in vocab.orderBy("ix").collect()] == [("b", 1), ("a", 2), ("c", 3)]
    assert sequences.sample(spark.range(50), "id", 7).count() == 7


def test_subsampling_is_stable(spark):
    ix = spark.range(2000).selectExpr("id AS seq_id", "0 AS pos", "1L AS ix")
    keep = spark.createDataFrame([(1, "a", 0.3)], "ix bigint, item string, keep double")
    first = sequences.subsample(ix, keep)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, sequences.subsample(ix.repartition(7), keep).collect()))
    assert first.where("ix = 1").count() / 2000 == pytest.approx(0.3, abs=0.04)
    assert sequences.subsample(ix, keep, mode="remove").count() == first.where("ix = 1").count()


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 5.0]), (4, [0.0, 0.0]), (5, None), (None, [1.0, 1.0])]
    corpus = vectors.normalise(spark.createDataFrame(rows, "id bigint, e array<double>"), "id", "e")
    assert corpus.count() == 3
    near = vectors.search_by_ids(corpus, spark.createDataFrame([(1,), (99,)], "id bigint"), 1).collect()
    assert [(r["query"], r.id, round(r.distance, 6)) for r in near] == [(1, 2, 0.0)]
    given = spark.createDataFrame([("q", [9.0, 0.1])], "id string, v array<double>")
    assert [r.id for r in vectors.search_by_vectors(corpus, given, 5).orderBy("rank_no").collect()] == [1, 2, 3]
    assert vectors.search_by_ids(corpus, spark.createDataFrame([], "id bigint")).count() == 0


def test_stamp(spark):
    assert re.fullmatch(r"\d{4}(_\d{1,2}){4}", spark.range(1).select(stamp()).first()[0])


def test_hash_uniform_and_chunks(spark):
    u = [r.u for r in spark.range(1000).select(hash_uniform(7, F.col("id")).alias("u")).collect()]
    assert 0 <= min(u) and max(u) < 1 and sum(u) / 1000 == pytest.approx(0.5, abs=0.05)
    assert chunk_sizes(10, 5) == [2] * 5 and chunk_sizes(11, 5) == [2] * 5 + [1]


def test_eager_aggregation(spark):
    left = spark.createDataFrame([("a", 1.0, 0)] * 3 + [("b", None, 0), (None, 2.0, 0), ("b", float("nan"), 0), ("b", float("inf"), 0)], "k string, v double, left_rows int")
    right = spark.createDataFrame([("a", 2.0), ("a", 3.0), (None, 1.0), ("c", 1.0)], "k string, w double")
    states = eager.eager_join_aggregate(left, right, "k", "k", "v", "w")
    got = {r.key_value: r for r in states.where("key_value IS NOT NULL").collect()}
    assert (got["a"].joined_rows, got["a"].joined_left_sum, got["a"].joined_right_sum, got["a"].joined_product_sum) == (6, 6.0, 15.0, 15.0)
    assert (got["b"].left_rows, got["b"].left_values, got["b"].joined_rows) == (3, 0, 0)
    assert got["c"].right_rows == 1 and states.where("key_value IS NULL").count() == 2
    named = {(r.field_name, r.key_value) for r in eager.overloaded_keys(states, left, right, "l", "r", 2).collect()}
    assert named == {("r", "a")}
    assert eager.eager_join_aggregate(left.limit(0), right.limit(0), "k", "k", "v", "w").count() == 0
    rolled = eager.roll_up(states, F.length("key_value")).where("group_name = 1").first()
    assert rolled.joined_rows == 6


def topics(spark):
    """Sequences of two topics: items 1 to 4, and 5 to 8."""
    rows = [(s, p, 1 + (s % 2) * 4 + (s * 7 + p * 3) % 4) for s in range(120) for p in range(6)]
    vocab = spark.createDataFrame([(f"i{k}", k) for k in range(1, 9)], "item string, ix bigint")
    return spark.createDataFrame(rows, "seq_id bigint, pos int, ix bigint"), vocab


def apart(trained):
    """How much more items predict those of their own topic than the other's."""
    v = {r.node: np.array(r.embedding) for r in sgns.read_vectors(trained, "embed").collect()}
    w = {r.node: np.array(r.embedding) for r in sgns.read_vectors(trained, "softmax").collect()}
    score = {(a, b): v[f"i{a}"] @ w[f"i{b}"] for a in range(1, 9) for b in range(1, 9) if a != b}
    same = np.mean([x for (a, b), x in score.items() if (a < 5) == (b < 5)])
    return same - np.mean([x for (a, b), x in score.items() if (a < 5) != (b < 5)])


@pytest.mark.parametrize("loss, parts", [("sampled_softmax", 1), ("sampled_softmax", 3), ("nce", 1), ("nce", 3)])
def test_sgns(spark, loss, parts):
    """Items predict those of their own topic rather than the other's, the loss falls, and a run repeats itself."""
    ix, vocab = topics(spark)
    pairs = sequences.skip_grams(ix, 2)
    settings = {"dim": 8, "epochs": 4, "batch": 32, "n_sampled": 4, "loss": loss, "rate": 0.05, "parts": parts}
    trained, losses = sgns.train(pairs, vocab, **settings)
    again, _ = sgns.train(pairs.repartition(5), vocab, **settings)
    v = {r.node: np.array(r.embedding) for r in sgns.read_vectors(trained, "embed").collect()}
    assert all(np.allclose(v[r.node], r.embedding) for r in sgns.read_vectors(again, "embed").collect())
    values = [r.loss for r in losses.orderBy("epoch").collect()]
    assert apart(trained) > 1 and values[-1] < values[0] and len(values) == 4
    assert sgns.read_vectors(trained, "avg").count() == 8


def test_sgns_options(spark):
    ix, vocab = topics(spark)
    pairs = sequences.skip_grams(ix, 2)
    empty, none = sgns.train(pairs.limit(0), vocab, dim=4, epochs=1, replace_value="<zero>")
    assert {r.node for r in empty.collect()} == {"<zero>", *(f"i{k}" for k in range(1, 9))} and none.count() == 0
    given = ([1, 3, 5, 7], [1.0] * 4, 1.0)
    for more in ({"negatives": given}, {"negatives": given, "parts": 2}, {"shuffle": False}, {"by_sequence": True, "batch": 8}, {"remove_hits": False}):
        trained, losses = sgns.train(lambda epoch: pairs, vocab, **({"dim": 8, "epochs": 3, "batch": 32, "n_sampled": 4, "rate": 0.05} | more))
        values = [r.loss for r in losses.orderBy("epoch").collect()]
        assert values[-1] < values[0], more
    with pytest.raises(ValueError):
        sgns.read_vectors(trained, "other")
    with pytest.raises(ValueError):
        sgns.train(pairs, vocab, loss="other")


def test_adam_by_hand():
    """A step of one pair against one negative, as the formulas give it."""
    w = np.array([[1.0, 0.0], [0.5, 0.5]])
    zero = np.zeros_like(w).tobytes()
    row = {"w": w.tobytes(), "m": zero, "v": zero, "bias": np.zeros(2).tobytes(), "bias_m": np.zeros(2).tobytes(), "bias_v": np.zeros(2).tobytes()}
    inputs, outputs = sgns._Side(dict(row), 2), sgns._Side(dict(row), 2)
    value = sgns._batch(inputs, outputs, np.array([0]), np.array([1]), (np.array([0]), np.array([1.0]), np.array([1.0])), "sampled_softmax", True, 0.1)
    assert value == pytest.approx(np.log(1 + np.exp(1.0 - 0.5)))
    # Adam's first step moves each number by the (corrected) rate against its gradient's sign
    scale = np.sqrt(1 - 0.999) / (1 - 0.9)
    assert inputs.w[0] == pytest.approx([1.0 - 0.1 / scale, 0.0 + 0.1 / scale], abs=1e-4) and (inputs.w[1] == w[1]).all()
    assert outputs.bias == pytest.approx([-0.1 / scale, 0.1 / scale], abs=1e-4)


def test_item2vec(spark, tmp_path):
    """A whole run of either kind: from sequences of names to vectors, their files and facts."""
    rows = [(s, [f"i{1 + (s % 2) * 4 + (s * 7 + p * 3) % 4}" for p in range(6)]) for s in range(120)] + [(200, ["rare", "i1"]), (201, ["rare", "i1", "i2"]), (202, None)]
    seqs = spark.createDataFrame(rows, "seq_id bigint, items array<string>")
    settings = item2vec.Item2Vec(embed_dim=8, window_size=2, item_min_count=2, subsample_thr=1.0, n_sampled=4, lr=0.05)
    made = settings.train(seqs, epochs=4, batch_size=32)
    assert apart(made.vectors.where("node <> '<zero>'")) > 1 and made.info["history_loss"][-1] < made.info["history_loss"][0]
    assert {r.node for r in made.embeddings("avg").collect()} == {f"i{k}" for k in range(1, 9)}  # "rare" is in one sequence that counts
    assert made.embeddings("softmax", keep_replace_value=True).where("node = '<zero>'").count() == 1
    assert len(made.save(str(tmp_path), "s", "all")) == 3
    (tmp_path / "f.txt").write_text("\n".join(",".join(r[1]) for r in rows if r[1]) + "\n")
    by_file = item2vec.Item2Vec(embed_dim=8, window_size=3, random_window=True, distinct_targets=True, item_filter_method="remove", subsample_thr=0.1, n_sampled=4, lr=0.05, train_with_replace_value=False)
    made = by_file.train(str(tmp_path / "f.txt"), "file", epochs=3, batch_size=8, item_pools=["i1", "i2", "i5", "none"], spark=spark)
    assert {r.node for r in made.embeddings().collect()} == {"i1", "i2", "i5", "none"} and len(made.info["history_loss"]) == 3
    nothing = settings.train(seqs.limit(0), epochs=1)
    assert nothing.embeddings().count() == 0 and nothing.losses.count() == 0
    with pytest.raises(ValueError):
        settings.train(seqs, "stream")


def all_pairs(rows):
    held = {}
    for key, x in rows:
        held.setdefault(key, []).append(x)
    return {(key, a, b) for key, xs in held.items() for a in xs for b in xs if a < b}


def test_self_join_of_a_hot_key(spark):
    """A key far above the chunk: every pair once, and no unit larger than two chunks."""
    rows = [("hot", k) for k in range(300)] + [(f"k{k % 40}", k) for k in range(160)]
    df = spark.createDataFrame(rows, "l string, x int").withColumn("r", F.col("x") * 2)
    got = pairing.self_join(df, "l", "x", ("r",), chunk=16).collect()
    assert len(got) == len({(r.l, r.a, r.b) for r in got}) and {(r.l, r.a, r.b) for r in got} == all_pairs(rows)
    assert all(r.r_a == 2 * r.a and r.r_b == 2 * r.b for r in got)
    assert pairing.self_join(df.limit(0), "l", "x").count() == 0


def test_keyed_join(spark):
    rows = spark.createDataFrame([("hot", k) for k in range(90)] + [("a", 1), ("b", 2), (None, 3)], "k string, x int")
    lookup = spark.createDataFrame([("hot", 90, "H"), ("a", 1, "A")], "k string, n bigint, y string")
    for hot in (1, 2, 1000):
        assert pairing.keyed_join(rows, lookup, "k", "n", 93, hot_keys=hot).groupBy("y").count().where("y = 'H'").first()[1] == 90
        assert pairing.keyed_join(rows, lookup, "k", "n", 93, "left", hot).where("y IS NULL").count() == 2
        assert pairing.keyed_join(rows, lookup, "k", "n", 93, "left_semi", hot).columns == ["k", "x"]


def test_similarity_with_a_hot_neighbour(spark):
    """One left key of 50,000 entities: the pairs of a narrow band of them, computed in chunks, are those of the plain formula."""
    few = spark.createDataFrame([("u", k, 1.0 + k % 3) for k in range(120)] + [("v", k, 2.0) for k in range(0, 120, 2)], "l string, x int, r double")
    for f in (similarity.cosine, similarity.jaccard, lambda rows, chunk=4096: similarity.jaccard(rows, True, chunk)):
        plain, chunked = (table(f(few, chunk=c), "i", "j") for c in (4096, 8))
        assert len(plain) == 120 * 119 and {k: round(r.score, 9) for k, r in plain.items()} == {k: round(r.score, 9) for k, r in chunked.items()}
    hot = spark.range(50_000).select(F.lit("u").alias("l"), F.col("id").alias("x"))
    chunks = pairing.chunks_of(hot, "l").first().chunks
    own = hot.groupBy(F.pmod(F.xxhash64("x"), F.lit(chunks)).alias("c")).count().agg(F.max("count")).first()[0]
    assert chunks == 13 and own < 1.2 * pairing.CHUNK


def test_swing_of_users_with_many_items(spark):
    """Users who share many items: the products of their chunks are those of the whole lists."""
    rows = [("a", k) for k in range(60)] + [("b", k) for k in range(20, 80)] + [("c", k) for k in range(0, 80, 7)] + [("d", 1), ("d", 8)]
    df = spark.createDataFrame(rows, "u string, i int")
    plain, chunked = (table(swing.swing(df, None, chunk=c), "item_i", "item_j") for c in (512, 8))
    assert len(plain) > 500 and {k: round(r.score, 9) for k, r in plain.items()} == {k: round(r.score, 9) for k, r in chunked.items()}


def test_many_queries_meet_the_corpus_in_blocks(spark):
    rng = np.random.default_rng(5)
    corpus = vectors.normalise(spark.createDataFrame([(k, [float(x) for x in rng.normal(size=4)]) for k in range(80)], "id bigint, e array<double>"), "id", "e")
    near, far = (sorted(map(tuple, vectors.nearest(corpus, corpus, 3, True, block, 30).collect())) for block in (100, 20))
    assert len(near) == 240 and [x[:2] + x[3:] for x in near] == [x[:2] + x[3:] for x in far]


def test_lists_and_places(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 2, 3), ("a", None, 0), (None, 5, 0), ("b", None, 0)], "k string, x int, t int")
    assert table(sequences.key_lists(df, "k", "x", "t"), "key")[("a",)]["values"] == [2, 1, 2]
    assert table(sequences.key_lists(df, "k", "x"), "key")[("a",)]["values"] == [1, 2, 2]
    assert table(sequences.key_lists(df, "k", "x"), "key")[(None,)]["values"] == [5] and table(sequences.key_lists(df, "k", "x"), "key")[("b",)]["values"] == []


def test_tsne(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(3, 10)) * 5
    x = np.concatenate([c + rng.normal(size=(20, 10)) * 0.3 for c in centres])
    y = embedding.tsne_points(x, 10, 400)
    d = ((y[:, None] - y[None]) ** 2).sum(2) + np.eye(60) * 1e9
    assert (d.argmin(1) // 20 == np.arange(60) // 20).all()
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(99, None), (None, [1.0] * 10)], "node bigint, embedding array<double>")
    points = embedding.tsne(df, most=30, iterations=50).collect()
    assert len(points) == 30 and all(len(r.point) == 2 for r in points)
    assert embedding.tsne(df.limit(0)).count() == 0 and embedding.tsne(df.limit(2)).first().point == [0.0, 0.0]


def test_pairs_are_not_shuffled(spark, monkeypatch):
    """In tiles, with an entity of more pairs than are made at a time, and by a join where a bucket is too large, scores are the same; tiles write rows, not pairs."""
    rng = np.random.default_rng(8)
    held = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 90, 3000), 40 * rng.random(3000) ** 3)})
    rows = roles(rated(spark, [(f"u{u}", i, float((u + i) % 4)) for u, i in held]))
    named = rows.withColumn("x", F.concat(F.lit("é"), F.col("x").cast("string")))
    found = {}
    for formula in similarity.FORMULAS:
        joined = similarity._joined_cosine(rows, 16) if formula == "cosine" else similarity._joined_jaccard(rows, formula != "jaccard", 16)
        want = {pair: r.score for pair, r in table(joined, "i", "j").items()}
        for pairs, tile in ((2_000_000, 9_000_000), (50, 700), (2_000, 9_000_000), (50, 10)):
            monkeypatch.setattr(similarity.tiles, "PAIRS", pairs)
            monkeypatch.setattr(similarity.tiles, "TILE_ROWS", tile)
            monkeypatch.setattr(similarity.tiles, "PACK_ROWS", pairs)
            frame = similarity.similarity(rows, formula)
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            assert ("Aggregate" in plan) == (tile == 10)
            got = [(r.i, r.j, r.score) for r in frame.collect()]
            assert len(got) == len(want) and {(i, j): s for i, j, s in got} == pytest.approx(want)
            best = table(similarity.ranked(similarity.candidates(rows, formula, 5, 2e-6).withColumn("score", F.round("score", 6)), 5), "i", "rank_no")
            found.setdefault(formula, {k: r.j for k, r in table(similarity.ranked(joined.withColumn("score", F.round("score", 6)), 5), "i", "rank_no").items()})
            assert {k: r.j for k, r in best.items()} == found[formula]
        monkeypatch.undo()
        assert {(r.i[1:], r.j[1:]): r.score for r in similarity.similarity(named, formula).collect()} == pytest.approx(want)
    assert similarity.candidates(rows.limit(0), "jaccard", 5).count() == 0


def test_blocks_are_read_where_they_are(spark, monkeypatch):
    """Tiles read their two blocks without an exchange, so a block is on disk once however many tiles there are; also where blocks are empty, and for lists of the best."""
    rng = np.random.default_rng(9)
    held = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 90, 1500), rng.integers(0, 40, 1500))})
    rows = roles(rated(spark, [(f"u{u}", i, float(1 + (u + i) % 4)) for u, i in held]))
    for some, tile in ((rows, 500), (rows.where("x < 2"), 9_000_000)):
        monkeypatch.setattr(similarity.tiles, "TILE_ROWS", tile)
        want = {pair: r.score for pair, r in table(similarity._joined_cosine(some), "i", "j").items()}
        for pairs in (similarity.cosine(some), similarity.tiles.scored(some.select("l", "x", "r"), "cosine", 5)):
            plan = pairs._jdf.queryExecution()
            assert "Exchange" not in plan.executedPlan().toString() and "Repartition" not in plan.optimizedPlan().toString()
        got = [(r.i, r.j, r.score) for r in similarity.cosine(some).collect()]
        assert len(got) == len(want) > 0 and {(i, j): s for i, j, s in got} == pytest.approx(want)
        tops = similarity.ranked(similarity.candidates(some, "cosine", 5, 2e-6).withColumn("score", F.round("score", 6)), 5)
        joined = similarity.ranked(similarity._joined_cosine(some).withColumn("score", F.round("score", 6)), 5)
        assert {k: r.j for k, r in table(tops, "i", "rank_no").items()} == {k: r.j for k, r in table(joined, "i", "rank_no").items()}
