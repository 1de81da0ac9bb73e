"""Leaks: whole, partial, altered and disguised passages are found; common wording is not."""

import random
import unicodedata

import numpy as np
import pytest
import recall_of_leaks

from weftline.llm import leaks

WORDS = "orchard lantern miller granite teapot walnut harbour copper velvet garden thunder pencil marble saddle whistle candle ribbon meadow anchor pepper".split()
RNG = random.Random(4)
ITEM = " ".join(f"{RNG.choice(WORDS)}{RNG.choice(['', 's', 'ed', 'ish', 'less'])}" for _ in range(60))
OTHER = " ".join(f"{RNG.choice(WORDS)}{RNG.choice(['', 's', 'ed', 'ish', 'less'])}" for _ in range(60))
HAN = "请说明遥远的水渠若在两座桥之间遗失了别人的果园在另一个温室同时遗失钟表匠与遥远磨坊以后是否仍可索取灯笼"
ITEMS = [(1, ITEM), (2, OTHER), (3, HAN), (4, "too short to count"), (5, None), (6, "")]
NOISE = "The court heard the parties and found that nothing more was owed. " * 6
WORD = ITEM.split()


def altered(words, every):
    return [w if k % every != every - 2 else "blotted" for k, w in enumerate(words)]


CASES = {
    "whole": (NOISE + ITEM + NOISE, {1}),
    "partial": (NOISE + " ".join(WORD[11:32]) + ". " + NOISE, {1}),
    "too little": (NOISE + " ".join(WORD[11:23]) + ". " + NOISE, set()),
    "altered": (" ".join(altered(WORD, 8)), {1}),
    "too much altered": (" ".join(altered(WORD, 3)), set()),
    "dropped": (" ".join(w for k, w in enumerate(WORD) if k % 9 != 4), {1}),
    "inserted": (" ".join(w + (" indeed" if k % 9 == 4 else "") for k, w in enumerate(WORD)), {1}),
    "case and points": ("; ".join(WORD).upper(), {1}),
    "spaced": (" ".join(ITEM), {1}),
    "joined": (ITEM.replace(" ", ""), {1}),
    "hyphens": ("-\n".join(ITEM[k : k + 9] for k in range(0, len(ITEM), 9)), {1}),
    "accents": (unicodedata.normalize("NFD", ITEM.replace("e", "é")) + "​", {1}),
    "invisible": ("­".join(ITEM), {1}),
    "wide": ("".join(chr(ord(c) + 0xFEE0) if c != " " else c for c in ITEM), {1}),
    "page header": (" ".join(WORD[:15]) + "\n\nK 12/34 · Court of Nowhere · p. 2\n\n" + " ".join(WORD[15:30]), {1}),
    "reversed": (" ".join(WORD[::-1]), set()),
    "scattered": (NOISE.join(WORD), set()),
    "both": (ITEM + NOISE + OTHER, {1, 2}),
    "han": ("法院认为。" * 5 + HAN[3:38] + "法院认为。", {3}),
    "han little": ("法院认为。" * 5 + HAN[3:21] + "法院认为。", set()),
    "nothing": (NOISE, set()),
    "long": (NOISE * 2000 + ITEM, {1}),
    "zero": ("\0" + ITEM.replace(" ", "\0"), {1}),
}


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(k, c[0]) for k, c in enumerate(CASES.values())] + [(900, None), (901, ""), (None, ITEM), (902, ITEM), (902, ITEM)], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = leaks.leaks(docs.selectExpr("*", "7 AS item_id"), items, "doc_id", "text", "item_id", "text").collect()
    assert len(rows) == len({tuple(r) for r in rows})
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, set()).add(r.item_id)
    return out


@pytest.mark.parametrize("k, name", list(enumerate(CASES)))
def test_case(found, k, name):
    assert found.get(k, set()) == CASES[name][1]


def test_repeats_and_nulls(found):
    assert found[902] == {1} and None not in found and not {900, 901} & set(found)


def test_blocks_and_empty(spark, monkeypatch):
    docs = spark.createDataFrame([(1, CASES["both"][0]), (2, CASES["han"][0])], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    monkeypatch.setattr(leaks, "ITEM_CHARS", 200)
    assert {tuple(r) for r in leaks.leaks(docs, items, "doc_id", "text", "item_id", "text").collect()} == {(1, 1), (1, 2), (2, 3)}
    assert leaks.leaks(docs, items.limit(0), "doc_id", "text", "item_id", "text").count() == 0
    assert leaks.leaks(docs.limit(0), items, "doc_id", "text", "item_id", "text").count() == 0


def test_search_against_find():
    """Every occurrence of every pattern, as str.find would give them."""
    spaced, _, _ = leaks.build([(1, ITEM), (2, OTHER)])
    text = (NOISE + ITEM[40:200] + OTHER + ITEM) * 3
    codes, _, firsts = leaks._stream([text])
    raw = codes.tobytes()
    got = sorted(x for part in spaced.matches(*spaced.search(codes), firsts) for x in zip(*(y.tolist() for y in part)))
    wanted = []
    for k, source in enumerate((ITEM, OTHER)):
        own = leaks._stream([source])[0][:-1].tobytes()
        for w, start in enumerate(spaced.starts[k]):
            pattern, at = own[start : start + 12], -1
            while len(pattern) == 12 and (at := raw.find(pattern, at + 1)) >= 0:
                wanted.append((at, k, w))
    assert got == sorted(wanted)


def test_pieces_of_long_texts(spark, monkeypatch):
    """Passages at every place of a text that is searched in pieces."""
    monkeypatch.setattr(leaks, "BATCH_CHARS", 3000)
    monkeypatch.setattr(leaks, "MARGIN", 600)
    rows = [(k, NOISE * 40 + NOISE[: 37 * k] + ITEM + NOISE * 40) for k in range(0, 11)]
    parts = [x for part in leaks._parts([r[0] for r in rows], [r[1] for r in rows], 4000) for x in part]
    assert all(any(ITEM in t for d, t in parts if d == k) for k, _ in rows) and max(len(t) for _, t in parts) <= 8000
    scripts = leaks.build([(1, ITEM)])
    hits = {parts[t][0] for t, _ in leaks.find([t for _, t in parts], scripts, 20, 28, 6 / 7)}
    assert hits == {k for k, _ in rows}


def test_longer_passages_whose_alterations_lie_close():
    """28 words with four altered in the middle: every run of 20 holds 16 only, the passage holds 24."""
    there = np.zeros(60, dtype=np.int32)
    there[10:38] = 1
    there[22:26] = 0
    assert leaks.carries(there, np.ones(60), 20, 6 / 7)
    there[21] = 0
    assert not leaks.carries(there, np.ones(60), 20, 6 / 7)


def test_every_run_is_tried():
    """The run of greatest count and share lies in a thin stretch; another, of fewer words, in a dense one."""
    there, weights = np.zeros(80, dtype=np.int32), np.ones(80)
    there[0:20] = 1
    there[[3, 10]] = 0
    weights[[3, 10]] = 2.0  # 18 of 22: neither enough weight nor, with what follows, dense
    there[22:34:3] = 1
    assert not leaks.carries(there, weights, 20, 6 / 7)
    there[50:70] = 1
    there[[55, 60, 65]] = 0
    weights[[55, 60, 65]] = 1.3  # 17 of 20.9, in a stretch that is dense all along
    assert leaks.carries(there, weights, 20, 6 / 7)


def test_a_run_begins_and_ends_with_words_that_are_there():
    there = np.zeros(60, dtype=np.int32)
    there[10:29] = 1
    assert not leaks.carries(there, np.ones(60), 20, 6 / 7)  # 19 words
    there[29] = 1
    assert leaks.carries(there, np.ones(60), 20, 6 / 7)


SCRIPTS = {
    "greek": (0x3B1, 0x3CA), "cyrillic": (0x430, 0x450), "armenian": (0x561, 0x587), "hebrew": (0x5D0, 0x5EB), "arabic": (0x627, 0x64B), "hindi": (0x915, 0x93A),
    "georgian": (0x10D0, 0x10F1), "hangul": (0xAC00, 0xB000), "vietnamese": (0x1EA0, 0x1EFA), "polish": (0x141, 0x143), "supplementary": (0x10400, 0x10428),
}


@pytest.mark.parametrize("name", SCRIPTS)
def test_script(name):
    """A passage is found in its script; other words of the same lengths are not, and cost few matches."""
    rng = random.Random(name)
    letters = [chr(c) for c in range(*SCRIPTS[name]) if chr(c).isalpha()] + (list("aeionrstw") if name == "polish" else [])
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(40)]
    same_lengths = [["".join(rng.choice(letters) for _ in w) for w in words] for _ in range(5)]
    texts = [NOISE + " ".join(words[8:32]) + ". " + NOISE, *(" ".join(w) for w in same_lengths)]
    scripts = leaks.build([(1, " ".join(words))])
    assert leaks.find(texts, scripts, 20, 28, 6 / 7) == [(0, 1)]
    if scripts[2].ids:
        stream = leaks._stream([" ".join(" ".join(w) for w in same_lengths)])[1].astype(np.int64)
        assert len(scripts[2].search(stream)[0]) <= 2


def test_numbers_that_collide_are_told_apart_by_letters(monkeypatch):
    """All windows share one number and one bucket: the letters still decide."""
    monkeypatch.setattr(leaks.Script, "windows", lambda self, codes, ends: np.zeros(len(ends), np.int64))
    scripts = leaks.build([(1, ITEM), (2, OTHER)])
    assert leaks.find([NOISE + ITEM + NOISE, NOISE], scripts, 20, 28, 6 / 7) == [(0, 1)]


def test_common_windows_are_taken_in_parts(monkeypatch):
    """Items that share all their wording, a text that repeats it: more matches than are looked at at once."""
    items = [(k, ITEM + f" ending{k}") for k in range(30)]
    texts = [NOISE, (ITEM + ". ") * 20, NOISE + ITEM, NOISE]
    scripts = leaks.build(items)
    whole = leaks.find(texts, scripts, 20, 28, 6 / 7)
    monkeypatch.setattr(leaks, "MOST_MATCHES", 500)
    assert whole == leaks.find(texts, scripts, 20, 28, 6 / 7) == [(t, k) for t in (1, 2) for k in range(30)]


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    """The items of the tables in one block and in many: weights are of all items."""
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "eval_items"))
    run = lambda: {tuple(r) for r in leaks.leaks(docs, items, "doc_id", "text", "item_id", "text").collect()}
    whole = run()
    monkeypatch.setattr(leaks, "ITEM_CHARS", 8000)
    assert len(whole) > 20 and run() == whole


def test_recall_of_altered_passages():
    items = recall_of_leaks.items_of("/root/testdata/sf0.1")
    assert recall_of_leaks.recall(items, [22, 28, 35], 1 / 7, 60, False) >= 0.97
    assert recall_of_leaks.recall(items, [31, 36, 50], 1 / 7, 60, True) >= 0.95


def test_other_scripts():
    """Items in scripts other than Latin are told apart by their letters, not by the lengths of their words."""
    rng = random.Random(6)
    makers = {name: [chr(c) for c in range(lo, hi) if chr(c).isalpha()] for name, lo, hi in (("greek", 0x3B1, 0x3CA), ("cyrillic", 0x430, 0x450), ("arabic", 0x627, 0x64B), ("hindi", 0x915, 0x93A))}
    items, texts, wanted = [], [], set()
    for k, letters in enumerate(makers.values()):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(40)]
        lengths = ["".join(rng.choice(letters) for _ in w) for w in words]  # other words, equally long
        items.append((k, " ".join(words)))
        texts += [NOISE + " ".join(words[8:32]) + ". " + NOISE, " ".join(lengths)]
        wanted.add((2 * k, k))
    items.append((9, "le bœuf et la sœur du chœur " + ITEM))
    texts.append("LE BOEUF ET LA SOEUR DU CHOEUR " + ITEM)
    wanted.add((8, 9))
    thai = "".join(chr(rng.randint(0xE01, 0xE2E)) for _ in range(60))
    items.append((10, thai))
    texts.append(NOISE + thai[8:40] + NOISE)
    wanted.add((9, 10))
    batch = leaks.pa.RecordBatch.from_arrays([leaks.pa.array(range(len(texts)), leaks.pa.int64()), leaks.pa.array(texts)], names=["doc", "text"])
    got = {(r["doc_id"], r["item_id"]) for out in leaks._finder(items, leaks.held_by(items), 20, 28, 6 / 7)(iter([batch])) for r in out.to_pylist()}
    assert got == wanted
