"""Properties that hold for any input."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import leaks, packing, sentences, topn

PIECES = ["Dr. ", "It was not! ", "“No.” ", "12.10.2021 ", "\n\n", "\n", "Headnote", "Page 2 of 5", "K 12/20", "该货物！", "「はい。」と", "έγκυρο; ", "देखें। ", "ศาลเห็นว่า ", "...", "§ 4 ", "e.g. x", "؟ ", "\0", "🙂"]
ALL = np.zeros(sentences.SLOTS + 1)
ALL[-1] = 1.0
MODEL = sentences.Model(frozenset({"Headnote"}), ALL, ALL)


@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 90))
def test_best_fit(sizes, capacity):
    bins = packing.best_fit(sizes, capacity)
    assert sorted(k for b in bins for k in b) == list(range(len(sizes)))
    assert all(sum(sizes[k] for k in b) <= capacity for b in bins)
    assert len(bins) <= math.ceil(2 * sum(sizes) / capacity) + 1


@settings(deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_sentence_ends(text):
    """Strictly growing, within the text, and never at a blank."""
    ends = sentences.Splitter(MODEL).ends(text)
    assert ends == sorted(set(ends)) and all(0 < e <= len(text) for e in ends)
    assert not any(text[e - 1].isspace() for e in ends)


@settings(deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_streams(texts):
    """Every text has its own stretch of the stream, ended by a 0, and folding is stable."""
    codes, points, firsts = leaks._stream(texts)
    assert len(codes) == len(points) and len(firsts) == len(texts) and (codes == 0).sum() == len(texts)
    for k, text in enumerate(texts):
        end = firsts[k + 1] if k + 1 < len(texts) else len(codes)
        assert codes[firsts[k] : end].tolist() == leaks._stream([text])[0].tolist()


@given(st.floats(allow_nan=False, allow_infinity=False), st.floats(allow_nan=False, allow_infinity=False))
def test_score_code(a, b):
    """Codes order as the scores do."""
    x, y = topn.code_of(np.array([a, b]))
    assert (x < y) == (a < b) and (x == y) == (a == b)
