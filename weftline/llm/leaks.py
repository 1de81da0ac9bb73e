"""Evaluation passages inside training texts: Wu-Manber multi-pattern search, then alignment.

Texts and items are reduced to a stream of letters and digits: compatibility
forms and accents are folded, case is dropped, and everything else (blanks, line
breaks, hyphens, invisible characters) goes. The patterns are windows of equal
length that begin at every word of every item (every character, where a script
has no blanks).

Search: a table tells for every block of ``B`` characters how far the nearest
pattern's end can be; the search reads the block at its position and skips that
far. Where the skip is 0, the block selects the bucket of the patterns that end in
it; within the bucket the window's number is looked up, and the letters of pattern
and text are then compared one by one. Many stretches of a batch of texts advance at
once, one array operation for all. Items that hold letters other than a to z and
0 to 9 (Greek, Cyrillic, Arabic, Thai ...) are searched and compared by code points.

Matches of one item on nearby diagonals of one text are candidates. Each is
aligned word by word along its longest chain of matches, and counts if some run of
``min_words`` words of the item (``min_chars`` letters without blanks), or of more, is
there in order but for one in seven, and if those words are not common phrases only:
a word weighs the more the fewer of all items hold it. The weights are counted once,
over all items, so a result doesn't depend on how items are blocked.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

#: Items are searched for in blocks of about this many characters; each block is a pass over the texts.
ITEM_CHARS = 4_000_000
#: Characters of text that are searched at once.
BATCH_CHARS = 3_000_000
#: Least overlap of the pieces of a text that is longer than that.
MARGIN = 20_000
#: Characters of one stretch of the search.
STRETCH = 2048
#: Diagonals in one bin; a page header or some inserted words shift a passage by less.
DRIFT = 64

#: Shares of a passage's weight that are enough by themselves, and in a dense stretch, and the share of the words that makes a stretch dense: with and without blanks between words. See :func:`carries`.
ENOUGH, SHARE, RUN = 0.86, 0.80, 0.82
ENOUGH_BLANKLESS, SHARE_BLANKLESS, RUN_BLANKLESS = 0.95, 0.85, 0.85
#: Missing words in a row that end a stretch.
LOST = 3
#: Matches that are looked at at once; more are taken text by text, then item by item.
MOST_MATCHES = 4_000_000
#: Matching windows that make a candidate.
LEAST = 4
#: Letters beyond a word within which the alignment looks for it, for each word missed before; it gives up after MISSED words.
STEP, MISSED = 14, 4

_TABLE = 0x30000
_OTHER, _MANY, _END = 37, 255, 254
_BASE = 0x9E3779B1  # of a window of code points: its number wraps around
_LIGATURES = {"œ": "oe", "æ": "ae"}  # which have no compatibility form


def _fold(char: str) -> str:
    """The letters and digits that a character stands for."""
    folded = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", char).casefold())
    return "".join(_LIGATURES.get(c, c) for c in folded if c.isalnum())


def _letter(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    if "0" <= char <= "9":
        return ord(char) - 21
    return _OTHER


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """By code point: the letter's small code (0: dropped), the folded code point, and the foldings to several letters."""
    small, folded, many = np.zeros(_TABLE, np.uint8), np.zeros(_TABLE, np.uint32), {}
    for point in range(1, _TABLE):
        if 0xD800 <= point < 0xE000 or 0x20000 <= point:
            continue
        own = _fold(chr(point))
        if len(own) == 1:
            small[point], folded[point] = _letter(own), ord(own)
        elif own:
            small[point], folded[point], many[point] = _MANY, ord(own[0]), own
    plain = np.arange(0x20000, _TABLE)
    small[plain], folded[plain] = _OTHER, plain
    small[0] = _END
    return small, folded, many


def _stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Small codes of all texts in turn, each followed by a 0; code points beside them; where each text begins."""
    small, folded, many = _tables()
    points = np.frombuffer(("\0".join(t.replace("\0", " ") for t in texts) + "\0").encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.where(points < _TABLE, points, 1)
    codes = small[points]
    keep = codes != 0
    codes, points = codes[keep], points[keep]
    if (at := np.flatnonzero(codes == _MANY)).size:
        expanded = [many[int(p)] for p in points[at]]
        rest = [(k + 1, c) for k, e in zip(at.tolist(), expanded) for c in e[1:]]
        codes[at] = [_letter(e[0]) for e in expanded]
        codes = np.insert(codes, [k for k, _ in rest], [_letter(c) for _, c in rest])
        points = np.insert(points, [k for k, _ in rest], [ord(c) for _, c in rest])
    ends = codes == _END
    codes[ends] = 0
    return codes, folded[points], np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])


@dataclass
class Script:
    """The patterns of the items of one kind of script."""

    length: int  # of a pattern
    block: int  # B
    base: int  # of a window's number, which wraps around unless the base is 38
    bounds: tuple[float, float, float]  # ENOUGH, SHARE, RUN
    words: list = field(default_factory=list)  # by item: its words, as bytes of small codes or as strings
    starts: list = field(default_factory=list)  # by item: where each word begins in the item's stream
    weights: list = field(default_factory=list)  # by item: of each word, the more the fewer items hold it
    ids: list = field(default_factory=list)
    letters: np.ndarray = None  # by key: the pattern
    keys: np.ndarray = None  # numbers of the distinct patterns, in order within each bucket
    bucket: np.ndarray = None  # by block: its first key; one more at the end
    occurrence: np.ndarray = None  # key and item of every occurrence in one number, in order
    word: np.ndarray = None  # by occurrence
    shift: np.ndarray = None

    def blocks(self, codes: np.ndarray) -> np.ndarray:
        """The block that ends at each position, as an index of the shift and bucket tables."""
        if self.base != 38:
            return _hashed(codes)
        c = codes.astype(np.int32)
        out = c.copy()
        for back in range(1, self.block):
            out[back:] += c[:-back] * np.int32(38**back)
        return out

    def windows(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The numbers of the windows that end at ``ends``."""
        out = np.zeros(len(ends), np.int64)
        for k in range(self.length):
            out = out * self.base + codes[ends - self.length + 1 + k]
        return out

    def build(self, streams: list[np.ndarray]) -> None:
        size = 38**self.block if self.base == 38 else 1 << 20
        self.shift = np.full(size, self.length - self.block + 1, np.uint8)
        suffix, number, item, word, letters = [], [], [], [], []
        for k, (codes, starts) in enumerate(zip(streams, self.starts)):
            begins = np.asarray([s for s in starts if s + self.length <= len(codes)], dtype=np.int64)
            if not len(begins):
                continue
            blocks, ends = self.blocks(codes), begins + self.length - 1
            for end in range(self.block - 1, self.length):
                np.minimum.at(self.shift, blocks[begins + end], np.uint8(self.length - 1 - end))
            suffix.append(blocks[ends])
            number.append(self.windows(codes, ends))
            item.append(np.full(len(begins), k))
            word.append(np.searchsorted(starts, begins))
            letters.append(codes[begins[:, None] + np.arange(self.length)])
        if not suffix:
            self.keys = np.zeros(0, np.int64)
            return
        suffix, number, item, word, letters = (np.concatenate(x) for x in (suffix, number, item, word, letters))
        order = np.lexsort((*letters.T[::-1], number, suffix))
        suffix, number, item, word, letters = (x[order] for x in (suffix, number, item, word, letters))
        new = np.append(True, (letters[1:] != letters[:-1]).any(1))
        key = np.cumsum(new) - 1
        self.keys, self.letters = number[new], letters[new]
        self.bucket = np.searchsorted(suffix[new], np.arange(size + 1)).astype(np.int32)
        order = np.lexsort((word, item, key))
        self.occurrence, self.word = (key * len(self.ids) + item)[order], word[order]

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where patterns begin in the stream, and the key of each, by place: Wu-Manber."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or len(codes) < self.length:
            return none, none
        blocks, shift = self.blocks(codes), self.shift
        at = np.maximum(np.arange(0, len(codes), STRETCH), self.length - 1)
        end = np.minimum(np.arange(0, len(codes), STRETCH) + STRETCH, len(codes))
        maybe = []
        at, end = at[at < end], end[at < end]
        while at.size:
            skip = shift[blocks[at]]
            maybe.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            inside = at < end
            if not inside.all():
                at, end = at[inside], end[inside]
        ends = np.sort(np.concatenate(maybe))
        wanted = self.windows(codes, ends)
        low, high = (self.bucket[blocks[ends] + k].astype(np.int64) for k in (0, 1))
        last = high
        while (low < high).any():  # bisection within all buckets at once
            middle = (low + high) >> 1
            less = (low < high) & (self.keys[np.minimum(middle, len(self.keys) - 1)] < wanted)
            low, high = np.where(less, middle + 1, low), np.where(less | (low >= high), high, middle)
        places, found = [], []
        while True:  # more than one round only where patterns of one bucket share a number
            held = low < last
            held &= self.keys[np.minimum(low, len(self.keys) - 1)] == wanted
            if not held.any():
                break
            ends, wanted, low, last = ends[held], wanted[held], low[held], last[held]
            begins = ends - self.length + 1
            same = (codes[begins[:, None] + np.arange(self.length)] == self.letters[low]).all(1)
            places.append(begins[same])
            found.append(low[same])
            low = low + 1
        if not places:
            return none, none
        places, found = np.concatenate(places), np.concatenate(found)
        order = np.argsort(places, kind="stable")
        return places[order], found[order]

    def matches(self, place: np.ndarray, key: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places, items, words) of all occurrences, some texts or some items at a time: what concerns one text and one item stays together."""
        text = np.searchsorted(firsts, place, side="right") - 1
        blocks = [(0, len(place), 0, len(self.ids))]
        while blocks:
            a, b, first, last = blocks.pop()
            low, high = (np.searchsorted(self.occurrence, key[a:b] * len(self.ids) + k) for k in (first, last))
            many = high - low
            total = int(many.sum())
            if not total:
                continue
            if total <= MOST_MATCHES or (text[a] == text[b - 1] and last - first == 1):
                at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)
                yield np.repeat(place[a:b], many), self.occurrence[at] % len(self.ids), self.word[at]
            elif text[a] == text[b - 1]:
                half = (first + last) // 2
                blocks += [(a, b, half, last), (a, b, first, half)]
            else:
                half = int(np.searchsorted(text[a:b], (text[a] + text[b - 1] + 1) // 2)) + a
                blocks += [(half, b, first, last), (a, half, first, last)]


def _hashed(points: np.ndarray) -> np.ndarray:
    p = points.astype(np.uint32)
    out = p * np.uint32(2654435761)
    out[1:] ^= p[:-1] * np.uint32(40503)
    return (out >> np.uint32(12)).astype(np.int64)


def _is_blankless(points: np.ndarray) -> bool:
    return bool(len(points)) and np.count_nonzero(_blankless(points)) * 2 > len(points)


def _blankless(points: np.ndarray) -> np.ndarray:
    """Letters of Chinese and Japanese, and of Thai, Lao, Burmese and Khmer."""
    southeast = (points >= 0x0E00) & (points < 0x0F00) | (points >= 0x1000) & (points < 0x10A0) | (points >= 0x1780) & (points < 0x1800)
    return (points >= 0x3040) & (points < 0xA000) | (points >= 0x20000) | southeast


def _words(text: str) -> list[tuple[str, bytes]]:
    """The item's words, folded, and their small codes; of a text without blanks, its letters."""
    codes, points, _ = _stream([text])
    if _is_blankless(points[:-1]):
        return [(chr(p), b"") for p in points[:-1].tolist()]
    out = []
    for word in _split(text):
        codes, points, _ = _stream([word])
        if len(codes) > 1:
            out.append(("".join(map(chr, points[:-1].tolist())), codes[:-1].tobytes()))
    return out


def held_by(items: list[tuple[int, str]]) -> tuple[dict[str, int], int]:
    """How many of the items hold each word, and how many there are."""
    return Counter(w for _, text in items for w in {w for w, _ in _words(text)}), len(items)


def build(items: list[tuple[int, str]], held: tuple[dict[str, int], int] | None = None) -> tuple[Script, Script, Script]:
    """The patterns of items with blanks between words, of those without, and of those with blanks and letters of any script; ``held``: see :func:`held_by`."""
    spaced, blankless, foreign = scripts = Script(12, 4, 38, (ENOUGH, SHARE, RUN)), Script(4, 2, _BASE, (ENOUGH_BLANKLESS, SHARE_BLANKLESS, RUN_BLANKLESS)), Script(12, 2, _BASE, (ENOUGH, SHARE, RUN))
    streams: tuple[list, ...] = ([], [], [])
    counts, total = held or held_by(items)
    for item, text in items:
        codes, points, _ = _stream([text])
        codes, points = codes[:-1], points[:-1]
        kind = 1 if _is_blankless(points) else 2 if (codes == _OTHER).any() else 0
        words = _words(text)
        own = scripts[kind]
        own.ids.append(item)
        own.words.append([small if kind == 0 else word for word, small in words])
        own.starts.append(np.cumsum([0, *(len(word) for word, _ in words)])[:-1])
        own.weights.append(np.array([np.log((total + 1) / counts[word]) for word, _ in words]))
        streams[kind].append(codes if kind == 0 else points.astype(np.int64))
    for script, own in zip(scripts, streams):
        script.build(own)
    return spaced, blankless, foreign


def _split(text: str) -> list[str]:
    """The words; what is dropped from the stream inside a word, such as a vowel sign, doesn't part it."""
    return re.split(r"[\W_]+", "".join(c for c in text if not unicodedata.category(c).startswith("M")))


def _present(words: list, anchors: list[tuple[int, int]], near: bytes | str, length: int) -> np.ndarray:
    """Which of the item's words are there in order; anchors: (word, place in ``near``) of patterns, growing in both."""
    there = np.zeros(len(words), dtype=np.int32)
    chain: list[tuple[int, int, int]] = []  # word, from, to
    for word, place in anchors:
        to = place
        limit = place + length
        while word < len(words) and to + len(words[word]) <= limit:
            if not chain or (word > chain[-1][0] and to >= chain[-1][2]):
                chain.append((word, to, to + len(words[word])))
                there[word] = 1
            to += len(words[word])
            word += 1
    if not chain:
        return there
    gaps = [(a[0] + 1, b[0], a[2], b[1]) for a, b in zip(chain, chain[1:]) if b[0] > a[0] + 1]
    for lo, hi, at, end in gaps:
        for w in range(lo, hi):
            rest = sum(map(len, words[w:hi]))
            k = near.find(words[w], at, end)
            if k >= 0 and (len(words[w]) > 2 or k - at <= 3 or end - k <= rest + 3):
                there[w] = 1
                at = k + len(words[w])
    w, at, missed = chain[-1][0] + 1, chain[-1][2], 0
    while w < len(words) and missed < MISSED:
        k = near.find(words[w], at, at + len(words[w]) + (STEP * (missed + 1) if len(words[w]) > 2 else 3))
        if k >= 0:
            there[w], at, missed = 1, k + len(words[w]), 0
        else:
            missed += 1
        w += 1
    w, at, missed = chain[0][0] - 1, chain[0][1], 0
    while w >= 0 and missed < MISSED:
        k = near.rfind(words[w], max(0, at - len(words[w]) - (STEP * (missed + 1) if len(words[w]) > 2 else 3)), at)
        if k >= 0:
            there[w], at, missed = 1, k, 0
        else:
            missed += 1
        w -= 1
    return there


def carries(there: np.ndarray, weights: np.ndarray, size: int, ratio: float, enough: float = ENOUGH, least: float = SHARE, run: float = RUN) -> bool:
    """Whether some run of ``size`` words or more, from one that is there to another, is there but for 1 - ``ratio`` of its words.

    Items built on one pattern share their common words, and such words alone
    are no passage. So the run must hold the share ``enough`` of its weight; or
    else ``least`` of it, and of the stretch in which the item goes on around it
    (while no ``LOST`` words in a row are missing) the share ``run``: common
    wording thins out over a long stretch, a passage ends where it ends. Every
    run of every length is tried.
    """
    at = np.flatnonzero(there)
    fewest = int(np.floor(ratio * size))
    if len(at) < fewest or len(there) < size:
        return False
    held_weight, weight = (np.concatenate([[0], np.cumsum(x)]) for x in (there * weights, weights))
    for held in range(fewest, len(at) + 1):  # runs that hold so many words that are there
        first, last = at[: len(at) - held + 1], at[held - 1 :]
        fit = (last - first + 1 >= size) & (held >= np.floor(ratio * (last - first + 1)))
        if not fit.any():
            continue
        first, last = first[fit], last[fit] + 1
        share = (held_weight[last] - held_weight[first]) / np.maximum(weight[last] - weight[first], 1e-9)
        if (share >= enough).any() or any(_dense(at, b, e, run) for b, e in zip(first[share >= least].tolist(), last[share >= least].tolist())):
            return True
    return False


def _dense(at: np.ndarray, begin: int, end: int, run: float) -> bool:
    """Whether the stretch around a run, words ``begin`` to ``end``, holds the share ``run`` of its words; ``at``: those that are there."""
    first, last = np.searchsorted(at, begin), np.searchsorted(at, end) - 1
    while first and at[first] - at[first - 1] <= LOST:
        first -= 1
    while last + 1 < len(at) and at[last + 1] - at[last] <= LOST:
        last += 1
    return last - first + 1 >= run * (at[last] - at[first] + 1)


def _candidates(place: np.ndarray, item: np.ndarray, word: np.ndarray, offsets: np.ndarray, base: np.ndarray, firsts: np.ndarray, span: int):
    """(text, item, matches' words, matches' places) of enough matches on nearby diagonals; ``offsets``: of all words, ``base``: of each item's first."""
    diagonal = place - offsets[base[item] + word]
    text = np.searchsorted(firsts, place, side="right") - 1
    order = np.lexsort((diagonal, item, text))
    text, item, word, place, diagonal = (x[order] for x in (text, item, word, place, diagonal))
    # a candidate is a run of matches whose diagonals follow each other by at most DRIFT
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > DRIFT)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(text))
    low, high = np.minimum.reduceat(word, begin), np.maximum.reduceat(word, begin)
    for k in np.flatnonzero((end - begin >= LEAST) & (high - low >= span)).tolist():
        b, e = begin[k], end[k]
        yield int(text[b]), int(item[b]), word[b:e], place[b:e]


def find(texts: list[str], scripts: tuple[Script, Script, Script], min_words: int, min_chars: int, ratio: float) -> list[tuple[int, int]]:
    """(number of the text, item id) of every leak."""
    found: set[tuple[int, int]] = set()
    codes, points, firsts = _stream(texts)
    raw = codes.tobytes()
    ends = np.append(firsts[1:], len(codes))
    spaced, blankless, foreign = scripts
    for script, own, size in ((spaced, codes, min_words), (blankless, points, min_chars), (foreign, points, min_words)):
        if not len(script.keys):
            continue
        stream, origin = own, None
        if script is blankless:
            # only texts with enough characters of such scripts
            per_text = np.add.reduceat(_blankless(points).astype(np.int32), firsts)
            if not (per_text >= size // 2).any():
                continue
            mine = np.repeat(per_text >= size // 2, ends - firsts)
            origin, stream = np.flatnonzero(mine), own[mine]
        place, key = script.search(stream if script is spaced else stream.astype(np.int64))
        if origin is not None:
            place = origin[place]
        offsets, base = np.concatenate(script.starts), np.concatenate([[0], np.cumsum([len(s) for s in script.starts])])
        for matches in script.matches(place, key, firsts):
            for text, k, hit_words, hit_places in _candidates(*matches, offsets, base, firsts, size // 2):
                if (text, script.ids[k]) in found:
                    continue
                words = script.words[k]
                reach = sum(map(len, words)) + len(words) * STEP * MISSED  # no word is looked for beyond it
                lo, hi = max(int(firsts[text]), int(hit_places.min()) - reach), min(int(ends[text]), int(hit_places.max()) + reach)
                near = raw[lo:hi] if script is spaced else "".join(map(chr, own[lo:hi].tolist()))
                for chain in _chains(hit_words, hit_places - lo):
                    if carries(_present(words, chain, near, script.length), script.weights[k], size, ratio, *script.bounds):
                        found.add((text, script.ids[k]))
                        break
    return sorted(found)


def _chains(word: np.ndarray, place: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """The longest chain of matches that grow both in word and in place, then the longest of what is left, while there are enough."""
    order = np.lexsort((-place, word))  # of one word's matches only one can be in a chain
    pairs = list(zip(word[order].tolist(), place[order].tolist()))
    while len(pairs) >= LEAST:
        tails, at, before = [], [], [0] * len(pairs)  # least last place of a chain of each length, and the match that it is of
        for k, (_, p) in enumerate(pairs):
            length = bisect_left(tails, p)
            before[k] = at[length - 1] if length else -1
            tails[length : length + 1], at[length : length + 1] = [p], [k]
        chain, k = [], at[-1]
        while k >= 0:
            chain.append(k)
            k = before[k]
        if len(chain) < LEAST:
            return
        yield [pairs[k] for k in reversed(chain)]
        used = set(chain)
        pairs = [pair for k, pair in enumerate(pairs) if k not in used]


def _parts(docs: list[int], texts: list[str], overlap: int) -> Iterator[list[tuple[int, str]]]:
    """Lists of about ``BATCH_CHARS`` characters. A longer text comes in stretches that overlap by more than a passage can take."""
    part: list[tuple[int, str]] = []
    chars = 0
    for doc, text in zip(docs, texts):
        step = max(BATCH_CHARS, 2 * overlap)
        for at in range(0, max(1, len(text) - overlap), step - overlap) if len(text) > step else (0,):
            piece = text[at : at + step] if len(text) > step else text
            if part and chars + len(piece) > BATCH_CHARS:
                yield part
                part, chars = [], 0
            part.append((doc, piece))
            chars += len(piece)
    if part:
        yield part


def _finder(items: list[tuple[int, str]], held: tuple[dict[str, int], int], min_words: int, min_chars: int, ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scripts = build(items, held)
        overlap = max([MARGIN, *(8 * len(text) for _, text in items)])
        for batch in batches:
            for part in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), overlap):
                hits = find([text for _, text in part], scripts, min_words, min_chars, ratio)
                yield pa.RecordBatch.from_arrays([pa.array([part[t][0] for t, _ in hits], pa.int64()), pa.array([i for _, i in hits], pa.int64())], names=["doc_id", "item_id"])

    return run


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = sorted({w for w, _ in _words(text)})
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(words), pa.int32()), pa.array(words, pa.string())], names=["block", "word"])


def leaks(
    documents: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, min_words: int = 20, min_chars: int = 28, ratio: float = 6 / 7
) -> DataFrame:
    """``doc_id``, ``item_id`` of every text that carries a passage of an item, each pair once.

    A passage is a run of ``min_words`` words of the item (``min_chars``
    characters in scripts without blanks) or more that the text has in order, but
    for one word in seven that may be replaced, misread, masked, dropped or
    inserted (see :func:`carries`). Punctuation doesn't count, hence 28
    characters for about 30.
    Shorter items are never found. NULL and empty texts or items, and
    NULL ids, carry nothing. Texts are read whole; rows that repeat a text or an
    id are searched like any others. Only the named columns are read.

    The items are taken in blocks of about ``ITEM_CHARS`` characters, and every
    block is one pass over the texts without a shuffle.
    """
    spark = documents.sparkSession
    rows = documents.select(documents[doc_id].cast("bigint").alias("doc_id"), documents[text].alias("text")).where("doc_id IS NOT NULL AND length(text) > 0")
    held = items.select(items[item_id].cast("bigint").alias("item"), items[item_text].alias("text")).where("item IS NOT NULL AND length(text) > 0")
    total, chars = held.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    blocks = max(1, -(-(chars or 0) // ITEM_CHARS))
    held = held.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int"))
    words = cut(spread(held.select("block", "text")).mapInArrow(_distinct_words, "block int, word string"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = spark.createDataFrame([], "doc_id bigint, item_id bigint")
    for block in range(blocks):
        mine = [(r.item, r.text) for r in held.where(F.col("block") == block).orderBy("item", "text").collect()]
        if mine:
            own = words.where(F.col("block") == block).select("word").distinct()  # no more than the block's characters
            by_word = {r.word: r.n for r in (counts if blocks == 1 else counts.join(own, "word", "left_semi")).collect()}
            out = out.union(spread(rows).mapInArrow(_finder(mine, (by_word, total), min_words, min_chars, ratio), "doc_id bigint, item_id bigint"))
    return out.distinct()
