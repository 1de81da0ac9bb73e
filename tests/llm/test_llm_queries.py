"""The training-data queries against their SQL on the small tables, or against brute force where SQL is too weak."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import recall_of_leaks
from compare import spark_rows, sql_rows

from weftline.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, DATA)) == sql_rows(DATA, queries.SQL[name])


def test_packing_of_the_texts(spark):
    """Every token of every text is packed; bins are nearly as few as can be."""
    rows = queries.p6_fill(spark, "/root/testdata/sf0.01").collect()
    packed = queries.p6_packed(spark, "/root/testdata/sf0.01").toPandas()
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 0").count()
    assert len(rows) == 4 and packed.groupby("container").doc_id.nunique().eq(texts).all()
    assert len({r.tokens for r in rows}) == 1 and packed.groupby("container").tokens.sum().eq(rows[0].tokens).all()
    for r in rows:
        assert r.least_bins <= r.bins and r.used > 0.98
    fills = packed.groupby(["container", "bin"]).tokens.sum()
    assert all(fills[r.container].max() <= r.capacity for r in rows)


def test_leaks_in_constructed_texts(spark, tmp_path):
    """Passages of the tables' items are put into their documents; each comes out, and what was there before still does."""
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").where("length(text) > 0").collect()]
    items = recall_of_leaks.items_of(folder)
    wanted, texts = set(), []
    for k, (doc, text) in enumerate(docs):
        item, source = items[k % len(items)]
        if k % 2 == 0 and len(source.split()) > 24:
            text = text + "\n\n" + " ".join(source.split()[1:24]) + ", so it was held."
            wanted.add((doc, item))
        texts.append((doc, text))
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    before, after = (set(map(tuple, queries.p7_found(spark, f).collect())) for f in (folder, str(tmp_path)))
    assert len(wanted) > 20 and wanted <= after and before <= after
    # items may share the sentence of a passage; nothing else comes out
    own = dict(items)
    extra = after - before - wanted
    assert all(any(d == doc and _share_a_sentence(own[i], own[item]) for d, i in wanted) for doc, item in extra)
    counted = {r.item_id: r.documents for r in queries.p7_leaked_items(spark, str(tmp_path)).collect()}
    assert counted == Counter(item for _, item in after)


def _share_a_sentence(a: str, b: str) -> bool:
    return bool({x.strip() for x in re.split(r"[.?]", a) if x.strip()} & {x.strip() for x in re.split(r"[.?]", b) if x.strip()})


def test_sentences_of_constructed_texts(spark, tmp_path):
    """Known sentences put together to paragraphs under headings, with the tables' own texts beside them to learn from."""
    known = ["The lease was withdrawn.", "Dr. Talen lives in St. Marion Street.", "Was the bond timely at the time?", "No. 12 was set aside.", "„Ich kenne den Vertrag nicht“, sagte der Zeuge.", "该担保书当时是否逾期？", "本院不予采信。", "Le pourvoi est donc rejeté."]
    rng = random.Random(8)
    texts, wanted = [], set()
    for doc in range(900_000, 900_040):
        text = "Court of Nowhere\n\nK 12/20\n\nbetween A and B\n\nHeadnote"
        for number in range(1, 4):
            text += f"\n\n(Rn. {number}) "
            for k in range(3):
                text += (" " if k else "") + rng.choice(known)
                wanted.add((doc, len(text)))
        texts.append((doc, text + "\n\nOrder\n\nTalen, Rover, Marion"))
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    real.unionByName(spark.createDataFrame(texts, real.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    found = set(map(tuple, queries.p8_found(spark, str(tmp_path)).where("doc_id >= 900000").collect()))
    assert len(found & wanted) / len(wanted) > 0.99 and len(found - wanted) / len(found) < 0.01
    counts = queries.p8_sentence_counts(spark, str(tmp_path)).where("doc_id >= 900000").toPandas()
    assert counts.sentences.sum() == len(found)


def test_recall_of_neighbours(spark):
    """At least 0.9 of the true neighbours, over every node of the 0.1 tables."""
    folder = "/root/testdata/sf0.1"
    near = queries.p4_nearest(spark, folder).collect()
    vectors = queries.neighbours.clean_vectors(spark.read.parquet(f"{folder}/node_vectors.parquet"), "node", "embedding", "loaded_at", 64).collect()
    names, v = [r.key for r in vectors], np.array([r.v for r in vectors])
    cosine = v @ v.T
    np.fill_diagonal(cosine, -2)
    tenth = np.sort(cosine, axis=1)[:, -10]
    found = {}
    for r in near:
        found.setdefault(r.node, []).append(r.neighbour)
    at = {n: k for k, n in enumerate(names)}
    hits = sum(cosine[at[n], at[m]] >= tenth[at[n]] - 1e-6 for n, own in found.items() for m in own)
    assert set(found) == set(names) and all(len(x) == 10 for x in found.values())
    assert hits / (10 * len(names)) >= 0.9
