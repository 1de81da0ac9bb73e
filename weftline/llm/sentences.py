"""Sentence boundaries across languages and scripts, by a maximum-entropy classifier.

A text's blocks are sorted first: court, docket, party, heading, signature and
page-header blocks are furniture; what is left are runs of prose, and a page
header inside a run does not end it. A block that ends with a final mark is prose.
Any other is classified by a logistic model on its words, their case and length,
digits, script, its place, its neighbours and whether it recurs in other texts.

In each run every mark that may end a sentence is a candidate, and so is every gap
in Thai. A candidate is described by features (its neighbouring tokens, their
case, length, digits and script, the mark, quotes and brackets, the gap) and
classified by another logistic model.

Both are trained on what is reliable without them, from a bounded sample of the
texts: blocks that recur in many texts, or have the form of a docket, are
furniture, paragraphs without their final mark are prose; the end of one
paragraph before the start of another is a boundary in a natural setting; a mark
inside a number or after an abbreviation that never starts a sentence is none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import Any
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: At most this many texts, those of least hash, and this many characters train the model.
FIT_TEXTS = 2000
FIT_CHARS = 4_000_000
#: Weights of the model's hashed features.
SLOTS = 1 << 18

#: A block this short that this many texts of the sample, and one in SELDOM of them, have in common recurs.
RECURRING_CHARS, RECURRING_TEXTS, SELDOM = 60, 5, 500
#: Characters of a token that its features show.
SHOWN = 64
#: Longest wording before a mark by which a candidate is known again; one with a longer one is described anew each time.
WORDING = 80

# Abbreviations whose point ends nothing when a word that starts no sentence follows.
ABBREVIATIONS = set(
    """
    mr mrs ms dr prof st no nos art arts rep app para paras p pp cf e.g i.e ver approx s ss sec v vs vol fig ch cl al jr sr
    abs nr gem vgl bl f ff geb z b d h u a i z.b d.h u.a i.s.d v.h rn hs rz ziff usw bzw ca
    m me mme not env pièce art. sté
    sra núm págs pág doc d.ª dra
    jan feb mar apr jun jul aug sept sep oct nov dec
    κ άρθρ παρ ν αρ αριθ σελ
    रु डॉ श्री पृ सं
    ص د رقم
    """.split()
)

_PAGE = re.compile(r"(?:Page \d+ of \d+|[–—-] ?\d+ ?[–—-]|[^\n]* · p\. \d+|[^\n]*\S {2,}\S[^\n]* {2,}\d+|(?:Seite|Blatt|Pág\.|S\.|p\.) \d+(?: (?:von|de|sur|/) \d+)?|\d+)")
_CODE = re.compile(r"\W*(?:[^\W\d_]{1,4}\W{0,2})?\d[\d\W]*")
_SIGNATURE = re.compile(r"[^\W\d_a-z][\w'’-]*(?: [^\W\d_a-z][\w'’.-]*)*(?:, [^\W\d_a-z][\w'’-]*(?: [^\W\d_a-z][\w'’.-]*)*)+|\([^\W\d_a-z][\w'’.-]*(?: [^\W\d_a-z][\w'’.-]*)*\)")
_NUMBER = re.compile(r"(?:\(?(?:Rn|Rz|no|n°)\.? ?\d+\)?|§+ ?\d+|\[\d+\]|\(?\d+[.)])[ \t ]+")
_DIGITS = re.compile(r"\d+")
_CLOSERS = "\"'”’“»)]）」』】›"
_FINAL = ".!?…。！？؟।॥;;"
# a point between digits is inside a number
_MARK = re.compile(r"(?!(?<=\d)\.\d)[.!?…]+|[。！？؟।॥]+[.!?…。！？؟]*|[;;]")
_ASCII_MARK = re.compile(r"(?!(?<=\d)\.\d)[.!?]+")
_RIGHT = re.compile(r"((?:[\"'”’»)\]）」』】›“]| [»›])*)( *)([„“\"«‘'(\[¿¡「『（【‹•–-]*)( ?)(\w+|\S)?(?:[^\w]{1,2}(\w+))?")
_THAI_GAP = re.compile(r"(?<=\S) +(?=[^ .,;:!?…)\]}”’])")
_THAI = re.compile(r"[ก-๛]")
_INITIAL = re.compile(r"(?:^|[\s.])[^\W\d_a-z]\.$")  # whose point may be no final mark
_EAST = re.compile(r"[⺀-\U0010ffff]")
_INNER = re.compile(r"\w{4,}[.!?;][\"”’»)]* +\S|[。！？؟।॥]")
_TOKEN = re.compile(r"\S+")
_LAST = re.compile(r"[^⺀-\uffee]+$|.$")
_OPENERS = "(„“«‘[¿¡「『（【‹\"'"


def _is_page(bare: str) -> bool:
    """Whether a block has the form of a page header; all of them end with a number or a dash."""
    return (bare[-1:].isdigit() or bare[-1:] in "–—-") and _PAGE.fullmatch(bare) is not None


def _is_thai(prose: str) -> bool:
    """Whether there is Thai anywhere; a quotation in another script may come first."""
    return not prose.isascii() and _THAI.search(prose) is not None


def _blocks(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for block in text.split("\n\n"):
        if block and not block.isspace():
            yield at, block
        at += len(block) + 2


def _ends_finally(block: str) -> bool:
    """Whether a final mark is the last but for closing quotes, brackets and blanks."""
    return (block[-16:].rstrip(_TAIL) or block.rstrip(_TAIL))[-1:] in _FINALS


_TAIL = _CLOSERS + " \t\n\r\u00a0\u202f\u3000"
_FINALS = frozenset(_FINAL)


def _size(n: int) -> str:
    return str(n) if n < 4 else "4" if n < 6 else "6" if n < 9 else "9" if n < 16 else "16"


@lru_cache(50_000)
def _looks(block: str) -> tuple[tuple[str, ...], str, str]:
    """What a block says of itself: its features, the share of its words in small letters, its size."""
    words = _TOKEN.findall(block)
    letters = [w for w in words if w[0].isalpha() or w[-1].isalpha()]
    small = sum(w[0].islower() or not (w[0].isupper() or w[0].isascii()) for w in letters)
    share = "none" if not letters else str(4 * small // len(letters))
    script = "" if block.isascii() else "T" if _is_thai(block) else "C" if _EAST.search(block) else ""
    size, long = _size(len(words)), _size(len(block) // 10)
    return (
        f"w={size}{script}", f"s={share}{script}", f"ws={size}/{share}", f"c={long}{script}", f"cs={long}/{share}{script}", f"f={_kind(words[0])}", f"l={_kind(words[-1])}", f"l4={block[-4:]}", f"e={words[-1][-1]}",
        f"d={_DIGITS.search(block) is not None}", f"o={',' in block}", f"m={min(len(_INNER.findall(block)), 3)}",
    ), share, size


def describe_block(block: str, place: int, left: int, before: str, after: str, recurs: bool) -> tuple[str, ...]:
    """The features of a block without a final mark; ``before`` and ``after``: kinds of its neighbours, ``left``: blocks that follow."""
    own, share, size = _looks(block)
    near = min(place, 3)
    return (*own, f"p={min(place, 4)}", f"r={min(left, 2)}", f"b={before}", f"a={after}", f"ba={before}/{after}/{near}", f"bs={before}/{share}", f"bp={before}/{near}/{size}", f"x={recurs}")


def _block_kind(bare: str, recurring: frozenset[str]) -> str:
    if _ends_finally(bare) and not _SIGNATURE.fullmatch(bare) and not _INITIAL.search(bare[-3:]):
        return "final"
    if len(bare) < 24 and _CODE.fullmatch(bare):
        return "code"
    return "recurs" if bare in recurring else "open"


def open_blocks(bares: list[str], pages: list[bool], recurring: frozenset[str]) -> Iterator[tuple[int, str, tuple[str, ...]]]:
    """Of each block (without blanks around it) but page headers: its place, its kind, and its features if it has no final mark."""
    rest = [k for k, page in enumerate(pages) if not page]
    kinds = [_block_kind(bares[k], recurring) for k in rest]
    for n, k in enumerate(rest):
        bare = bares[k]
        if kinds[n] == "final":
            yield k, "final", ()
        else:
            yield k, kinds[n], describe_block(bare, n, len(rest) - n - 1, kinds[n - 1] if n else "", kinds[n + 1] if n + 1 < len(rest) else "", bare in recurring)


def runs(text: str, is_prose: Callable[[tuple[str, ...]], bool], recurring: frozenset[str]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """The runs of prose: (run, [(place in the run, place in the text)] of its parts). In runs, every line break is a blank."""
    blocks = list(_blocks(text))
    bares = [b.strip() for _, b in blocks]
    pages = [_is_page(b) for b in bares]
    described = {k: (kind, features) for k, kind, features in open_blocks(bares, pages, recurring)}
    parts: list[tuple[int, int]] = []
    run, joined = "", False
    style, last = "", 0  # of the paragraph numbers so far
    for k, (at, block) in enumerate(blocks):
        if pages[k]:
            joined = True
            continue
        after_page, joined = joined, False
        kind, features = described[k]
        number = _NUMBER.match(block)
        if number:
            value = _DIGITS.search(number[0])[0]
            own = number[0].strip().replace(value, "#")
            # behind a page header in a run, what looks like a number is one if it is the next in line
            if after_page and run and not (own == style and int(value) == last + 1 and _ends_finally(run)):
                number = None
            else:
                style, last = own, int(value)
        furniture = False
        if kind != "final":
            # what a page header cuts off from a sentence, or a sentence that has begun goes on with, is part of it whatever it looks like
            cut_off = k + 1 < len(blocks) and pages[k + 1] or after_page and bool(run) and not _ends_finally(run)
            # furniture between furniture is not cut off
            between = kind != "open" or "b=code" in features or "a=code" in features
            furniture = not is_prose(features) if between or not cut_off else False
        if furniture or not (after_page and run) or number:
            if run:
                yield run, parts
            run, parts = "", []
        if furniture:
            continue
        begin = number.end() if number else len(block) - len(block.lstrip())
        prose = block[begin:].rstrip()
        for blank in _BLANKS:
            prose = prose.replace(blank, " ")
        if run:
            run += " "
        parts.append((len(run), at + begin))
        run += prose
    if run:
        yield run, parts


_BLANKS = "\n\t\r\u00a0\u202f"


@lru_cache(100_000)
def _kind(token: str) -> str:
    """The shape of a token: digits, case, length, script."""
    if not token:
        return "-"
    c = token[-1] if len(token) > 1 and not token[0].isalnum() else token[0]
    if token.isdigit():
        return "y" if len(token) == 4 else f"d{min(len(token), 3)}"
    if c.isdigit():
        return "dx"
    if c > "⺀":
        return "cjk"
    if "฀" <= c <= "๿":
        return "thai"
    if "ऀ" <= c <= "ॿ":
        return "deva"
    if "֐" <= c <= "ۿ":
        return "arab"
    if not c.isalnum():
        return "p" + c
    size = min(len(token), 4)
    if "." in token:
        return f"dot{'U' if c.isupper() else 'l'}{size}"
    if len(token) > 1 and token.isupper():
        return f"A{size}"
    return f"{'U' if c.isupper() else 'l'}{size}"


def candidates(run: str) -> Iterator[tuple[int, tuple]]:
    """(end of the sentence if this is a boundary, the candidate's description) of every mark but the run's last, and of every gap of a run with Thai."""
    for end, x, _ in _candidates(run, {}):
        yield end, x


def _candidates(run: str, decided: dict[tuple, bool]) -> Iterator[tuple[int, tuple | None, tuple | None]]:
    """:func:`candidates`, each with a key of the wording around it, which settles its description.

    Of those whose key is in ``decided``, only boundaries come out, undescribed.
    """
    openers: list[str] | None = None
    look, rfind = _RIGHT.match, run.rfind
    for m in (_ASCII_MARK if run.isascii() else _MARK).finditer(run):
        s, e = m.span()
        mark = m[0]
        r = look(run, e)
        closers, gap, opener, gap2, token, after = r.groups()
        if token is None:
            continue
        end, key, k = e, None, s
        while k and run[k - 1] == " ":
            k -= 1
        if not closers:  # quotes look further back
            i = rfind(" ", 0, k)
            first = rfind(" ", 0, i) + 1 if i > 0 else 0
            if s - first < WORDING:
                key = (s - first, run[first : r.end()])
                if (known := decided.get(key)) is not None:
                    if known:
                        yield end, None, None
                    continue
        else:
            end += len(closers)
            if not gap and "“" in closers and rfind("„", 0, e) <= rfind("“", 0, e):  # an opening quote without a blank before it
                cut = closers.index("“")
                opener, closers, end = closers[cut:] + opener, closers[:cut], e + cut
        if mark == ";" or mark == "\u037e":
            before = run[k - 1] if k else ""
            if not ("Ͱ" <= before <= "Ͽ" or "ἀ" <= before <= "῿" or (before and before in _CLOSERS and "Ͱ" <= run[k - 2 : k - 1] <= "Ͽ")):
                continue
        if not opener:
            if not gap:
                if not token[0].isalnum():
                    continue
            elif token[0] in ",;:%)]}、，；：）":
                continue
        i = rfind(" ", 0, k) + 1
        if k - i > SHOWN:
            i = k - SHOWN
        prev = run[i:k]
        if not prev.isalnum():
            prev = prev.lstrip(_OPENERS) or run[max(0, k - 1) : k]
            if "!" in prev or "?" in prev:  # a blank is missing
                prev = prev[max(prev.rfind("!"), prev.rfind("?")) + 1 :].lstrip(_OPENERS + _CLOSERS) or prev
        if not prev.isascii():
            prev = _LAST.search(prev)[0]
        lead = ""
        if mark == "." and (len(prev) < 4 or prev.isdigit()) and i > 1:  # what a number or an initial stands after
            h = rfind(" ", 0, i - 1) + 1
            lead = run[max(h, i - 1 - SHOWN) : i - 1].lstrip(_OPENERS).lower()[-12:] if h else ""
            if lead[-1:].isdigit():
                lead = "9"
            elif len(prev) > 1 and prev.islower():  # before a small word its shape says enough
                lead = _kind(lead)
        quote = ""
        if closers:
            if openers is None:
                openers = [o for o in "„“«‘「『（(\"" if o in run]
            q = max((rfind(o, 0, s) for o in openers), default=-1)
            h = q
            while h > 0 and run[h - 1] == " ":
                h -= 1
            ahead = run[h - 1] if h > 0 else ""
            quote = "i" if ahead and ahead in ":：,，、" else "s" if not ahead or ahead in ".!?。！？…)」”»）“" else "m"
            if q >= 0 and run[q] in "（(":
                quote = "b" + ("s" if quote == "s" else "m")
            closers = closers[:2].strip()
        yield end, (mark if len(mark) < 4 else mark[:3], closers, quote, bool(gap or gap2), opener[:1], prev, token if len(token) < SHOWN else token[:SHOWN], after or "", lead), key
    if _is_thai(run):
        for m in _THAI_GAP.finditer(run):
            s, e = m.span()
            if run[s - 1] in _FINALS:  # a mark is a candidate already
                continue
            i = max(run.rfind(" ", 0, s) + 1, s - SHOWN)
            prev, token = run[i:s], _TOKEN.match(run, e)[0]
            if not (_THAI.search(prev[-2:]) or _THAI.search(token[:2])):
                continue
            yield s, (" ", "", "", True, "", prev[-SHOWN:], token[:SHOWN], "", ""), None


def _about_gap(prev: str, token: str) -> list[str]:
    """Features of a gap in a run with Thai: the kinds of its two sides, their letters, their length."""
    left, right = _side(prev[-1]), _side(token[0])
    wholes = "d" if any(c.isdigit() for c in prev) else "-", "d" if any(c.isdigit() for c in token) else "-"
    return [
        f"gl={left}", f"gr={right}", f"g={left}/{right}", f"gd={wholes[0]}{wholes[1]}", f"gdl={left}/{right}/{wholes[0]}{wholes[1]}",
        f"g3={prev[-3:]}", f"g4={prev[-4:]}", f"h3={token[:3]}", f"h4={token[:4]}", f"gn={_size(len(prev))}{left}", f"gm={_size(len(token))}{right}", f"gg={prev[-3:]}/{token[:3]}", "gap", "thai",
    ]


def _side(c: str) -> str:
    return "thai" if "฀" <= c <= "๿" else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def _about_prev(shown: str) -> list[str]:
    return [f"p={shown}"]


def _about_next(shown: str, ak: str) -> list[str]:
    return [f"n={shown}", f"nn={shown}/{ak}"]


def _about_after(after: str) -> list[str]:
    return [f"a={after}"]


def _about_mark(mark: str, closers: str, quote: str, gap: bool, opener: str, pk: str, nk: str) -> list[str]:
    cjk = nk == "cjk" or pk == "cjk"
    m = "." if mark == "." else "o" if mark in ("...", "…", "……") else "q"
    g = "g" if gap else "n"
    return [f"pk={pk}{m}", f"nk={nk}{m}{g}", f"pn={pk}/{nk}{m}{g}", f"m={mark}{g}", f"c={closers}{quote}{m}{nk if not cjk else 'cjk'}{g}", f"q={quote}{'cjk' if cjk else ''}{m}", f"o={opener}{m}{g}"]


def _about_lead(lead: str, pk: str, nk: str) -> list[str]:
    return [f"l={lead}/{pk}", f"ln={lead}/{nk}{pk[0]}"]


def _about_short(short: str, nk: str, gap: bool) -> list[str]:
    return [f"pnl={short}/{nk}{'g' if gap else 'n'}"]


def _parts(x: tuple) -> tuple[tuple, ...]:
    """What each group of features depends on."""
    mark, closers, quote, gap, opener, prev, token, after, lead = x
    pk, nk = _kind(prev), _kind(token)
    low = prev.lower()
    return (
        (pk if pk[0] in "dy" and pk[:3] != "dot" else low,), (token[0] if nk == "cjk" else token, _kind(after)), (after,), (mark, closers, quote, gap, opener, pk, nk), (lead, pk, nk), (low if len(prev) < 5 else pk, nk, gap),
    )


_ABOUT = (_about_prev, _about_next, _about_after, _about_mark, _about_lead, _about_short)


def describe(x: tuple) -> list[str]:
    """The features of a candidate: of the token before, of the one after, of the next but one, and of their shapes and setting."""
    if x[0] == " ":
        return _about_gap(x[5], x[6])
    return [name for about, part in zip(_ABOUT, _parts(x)) for name in about(*part)]


def _slots(names: Iterable[str]) -> list[int]:
    return [_stable(n) for n in names]


def _stable(name: str) -> int:
    return crc32(name.encode("utf-8", "replace")) % SLOTS


def _first_tokens(run: str) -> tuple[str, str, str]:
    r = _RIGHT.match(" " + run)
    return r.group(3)[:1], r.group(5) or "", r.group(6) or ""


@dataclass
class Model:
    """Weights of the two classifiers, and the blocks that recur."""

    recurring: frozenset[str]
    blocks: np.ndarray
    marks: np.ndarray

    def is_prose(self) -> Callable[[tuple[str, ...]], bool]:
        """Whether a block of given features is prose; where nothing speaks against it, it is."""
        weights, known = self.blocks.tolist(), {}

        def decide(features: tuple[str, ...]) -> bool:
            if (found := known.get(features)) is None:
                if len(known) > 200_000:
                    known.clear()
                found = known[features] = weights[-1] + sum(weights[slot] for slot in _slots(features)) >= 0
            return found

        return decide


def recurring_blocks(texts: list[str]) -> frozenset[str]:
    """Short blocks without a final mark that many texts have in common, such as headings."""
    held = Counter(b for text in texts for b in {b.strip() for _, b in _blocks(text)} if len(b) <= RECURRING_CHARS and not _ends_finally(b) and not _is_page(b))
    return frozenset(b for b, n in held.items() if n >= max(RECURRING_TEXTS, len(texts) / SELDOM))


def reliable_blocks(texts: list[str], recurring: frozenset[str]) -> tuple[list[tuple], list[bool]]:
    """Features of blocks whose class is sure: whether they are prose."""
    found, labels = [], []
    for text in texts:
        blocks = list(_blocks(text))
        pages = [_is_page(b.strip()) for _, b in blocks]
        rest = [k for k, page in enumerate(pages) if not page]
        kinds = [_block_kind(blocks[k][1].strip(), recurring) for k in rest]
        for n, k in enumerate(rest):
            bare = blocks[k][1].strip()
            before, after = kinds[n - 1] if n else "", kinds[n + 1] if n + 1 < len(rest) else ""
            label = None
            if kinds[n] == "final":  # a sentence without its final mark
                label, bare = True, bare.rstrip(_CLOSERS + _FINAL + " \n")
            elif kinds[n] in ("recurs", "code") or "code" in (before, after) or _SIGNATURE.fullmatch(bare):
                label = False
            elif _is_thai(bare) or (k and pages[k - 1] or k + 1 < len(pages) and pages[k + 1]):
                label = True  # Thai has no final marks; a page header cuts sentences off
            if label is not None and bare:
                found.append(describe_block(bare, n, len(rest) - n - 1, before, after, bare in recurring))
                labels.append(label)
    return found, labels


def reliable(texts: list[str], is_prose: Callable[[tuple[str, ...]], bool], recurring: frozenset[str]) -> tuple[list[tuple], list[bool]]:
    """Candidates whose class is sure without a model."""
    heads: list[tuple] = []
    tails: list[tuple] = []
    inner: list[tuple] = []
    thai_heads: list[str] = []
    thai_tails: list[str] = []
    gaps: list[tuple] = []
    for text in texts:
        for run, parts in runs(text, is_prose, recurring):
            if _is_thai(run):
                tokens = _TOKEN.findall(run)
                thai_heads.append(tokens[0])
                thai_tails.append(tokens[-1])
                gaps += [x for _, x in candidates(run) if x[0] == " "]
                continue
            heads.append(_first_tokens(run))
            if _ends_finally(run):
                tails += [x for end, x in candidates(run + " Ω") if end == len(run)]
            inner += [x for end, x in candidates(run)]
    starters = Counter(t for _, t, _ in heads)
    words = Counter(x[6] for x in inner)
    ends, middles = Counter(x[5].lower() for x in tails), Counter(x[5].lower() for x in inner if not (x[3] and x[6][:1].islower()))
    never = {w for w, n in middles.items() if n >= 15 and not ends[w] and len(w) < 7 and not w[-1:].isdigit()}  # tokens that ended no paragraph
    went_on = Counter(x[5].lower() for x in inner if x[3] and x[6][:1].islower())
    never_low = {w for w, n in went_on.items() if n >= 5 and not ends[w]}
    found, labels = [], []

    def add(x: tuple, label: bool) -> None:
        found.append(x)
        labels.append(label)

    for k, tail in enumerate(thai_tails):  # Thai paragraphs end and begin as sentences do, where no number is
        for step in (3, 1009):
            head = thai_heads[(k * 17 + step) % len(thai_heads)]
            if not tail[-1].isdigit() and not head[0].isdigit():
                add((" ", "", "", True, "", tail[-SHOWN:], head[:SHOWN], "", ""), True)
    for x in gaps:
        if x[5][-1].isdigit() or x[6][0].isdigit():  # around a number, which dates are too
            add(x, False)
    for k, tail in enumerate(tails):  # a paragraph's end before another paragraph's start, of the same script
        for step in (7, 1013):
            opener, token, after = heads[(k * 31 + step) % len(heads)]
            if (token[:1] > "⺀") == (tail[5][-1:] > "⺀") and token:
                add((*tail[:3], (k + step) % 8 != 0 and tail[5][-1:] <= "⺀", opener, tail[5], token, after, tail[8]), True)
                if k % 3 == 0 and tail[0] == "." and not tail[1] and not opener and _kind(tail[5]) == "l4" and token[0].isupper():  # sentences may begin in lower case
                    add((*tail[:3], True, "", tail[5], token.lower(), after, tail[8]), True)
                if _kind(tail[5]) == "U1":
                    continue
    for x in inner:
        mark, closers, quote, gap, opener, prev, token, after, lead = x
        pk, nk, low = _kind(prev), _kind(token), prev.lower()
        starts = starters[token] * 20 > words[token] or starters[token] > 3
        dots = mark == "." or mark[0] in "…." and len(mark) > 1
        if nk[0] == "l" and not opener and gap:
            if mark == "." and not closers and pk == "l4" and low not in never and low not in ABBREVIATIONS and ends[low] > 2:
                add(x, True)  # a word that ends paragraphs: what follows began in lower case
            elif mark != "." or closers or low in never or low in never_low or low in ABBREVIATIONS or pk[0] in "Udy":
                add(x, False)
        elif nk[0] == "l" and not opener:
            add(x, False)
        elif mark == "." and not closers and low in never:
            add(x, False)
        elif nk == "cjk" or pk == "cjk":
            if closers:
                if quote == "i" or quote == "bs":
                    add(x, True)
                elif quote in ("s", "m", "bm"):
                    add(x, False)
            elif mark[0] in "。！？…?!":
                add(x, nk != "p」" and token not in "」』”’）")
        elif mark[0] in "।॥؟" and not quote:
            add(x, True)
        elif mark[0] in "?!;" and not quote and nk[0] in "UA":
            add(x, True)
        elif not gap and mark == "." and (len(prev) < 3 or "." in prev or nk[0] == "d"):
            add(x, False)
        elif mark == "." and not closers and (low in ABBREVIATIONS or pk in ("U1", "l1")) and not starts:
            add(x, False)
        elif mark == "." and nk[0] == "d" and pk[0] not in "dy":
            add(x, False)
        elif mark == "." and pk[0] == "d" and pk not in ("y", "dx", "d3") and not starts:
            add(x, False)
        elif dots and not quote and pk == "l4" and "." not in prev and low not in ABBREVIATIONS and nk[0] in "UA" and len(prev) > 4 and gap:
            add(x, True)
        elif closers and quote == "i" and nk[0] == "U" and starts:
            add(x, True)
    return found, labels


def _maximum_entropy(found: list, labels: list[bool], names: Callable[[Any], Iterable[str]], rounds: int, decay: float) -> np.ndarray:
    """The weights of the logistic model (maximum entropy under the examples), by AdaGrad over all of them; the last is the bias."""
    weights = np.zeros(SLOTS + 1)
    if not found:
        return weights
    counted = Counter(zip(found, labels))
    rows = np.array([_slots(names(x)) for x, _ in counted], dtype=np.int64)
    y = np.array([label for _, label in counted], dtype=float)
    share = np.minimum(np.array(list(counted.values()), dtype=float), 50.0)
    share /= share.sum()
    squares = np.full(SLOTS + 1, 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(weights[rows].sum(1) + weights[-1], -30, 30)))
        wrong = (p - y) * share
        gradient = np.append(np.bincount(rows.ravel(), np.repeat(wrong, rows.shape[1]), SLOTS), wrong.sum()) + decay * weights
        squares += gradient**2
        weights -= 0.5 * gradient / np.sqrt(squares)
    return weights


def fit(texts: list[str], rounds: int = 150, decay: float = 2e-6) -> Model:
    """Both classifiers, of blocks and of candidates, from what is reliable in the texts."""
    recurring = recurring_blocks(texts)
    model = Model(recurring, _maximum_entropy(*reliable_blocks(texts, recurring), lambda x: x, 3 * rounds, decay), np.zeros(SLOTS + 1))
    model.marks = _maximum_entropy(*reliable(texts, model.is_prose(), recurring), describe, rounds, decay)
    return model


class Splitter:
    """Ends of the sentences of a text, under a model."""

    def __init__(self, model: Model):
        self.model, self.weights, self.is_prose = model, model.marks.tolist(), model.is_prose()
        self.bias = self.weights[-1]
        self.decided: dict[tuple, bool] = {}  # candidates recur, and each wording is described once
        self.known: tuple[dict, ...] = tuple({} for _ in _ABOUT)  # a candidate's score is the sum of its parts' scores; parts recur

    def is_boundary(self, x: tuple) -> bool:
        """Whether the model says so."""
        if x[0] == " ":
            return self.weights[-1] + sum(self.weights[s] for s in _slots(describe(x))) > 0
        score = self.bias
        for about, known, part in zip(_ABOUT, self.known, _parts(x)):
            if (own := known.get(part)) is None:
                if len(known) > 200_000:
                    known.clear()
                own = known[part] = sum(map(self.weights.__getitem__, _slots(about(*part))))
            score += own
        return score > 0

    def ends(self, text: str) -> list[int]:
        """Code points of the text up to and including the last of each sentence."""
        out: list[int] = []
        is_boundary, decided = self.is_boundary, self.decided
        for run, parts in runs(text, self.is_prose, self.model.recurring):
            ends = []
            for end, x, key in _candidates(run, decided):
                if x is None:
                    ends.append(end)
                    continue
                found = is_boundary(x)
                if found:
                    ends.append(end)
                if key is not None:
                    if len(decided) > 300_000:
                        decided.clear()
                    decided[key] = found
            if _is_thai(run):
                ends = sorted(set(ends))
            if not ends or ends[-1] < len(run):
                ends.append(len(run))
            if len(parts) == 1:
                shift = parts[0][1] - parts[0][0]
                out += [end + shift for end in ends]
            else:
                k = 0
                for end in ends:
                    while k + 1 < len(parts) and parts[k + 1][0] < end:
                        k += 1
                    out.append(end - parts[k][0] + parts[k][1])
        return out


def _splitter(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(model)
        for batch in batches:
            docs = batch.column(0)
            ends = [splitter.ends(t) for t in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, ends), dtype=np.int64, count=len(ends))
            rows = docs.take(pa.array(np.repeat(np.arange(len(ends)), sizes)))
            yield pa.RecordBatch.from_arrays([rows, pa.array([e for own in ends for e in own], pa.int32())], names=["doc_id", "end_pos"])

    return work


def sentence_ends(documents: DataFrame, doc_id: str, text: str, fit_texts: int = FIT_TEXTS, fit_chars: int = FIT_CHARS) -> DataFrame:
    """``doc_id``, ``end_pos`` of every sentence: code points up to and including its last, closing quotes and brackets included.

    NULL and empty texts have no sentences; nor have texts of furniture alone. A
    run of prose that ends without a mark ends its last sentence; a block of text
    without a final mark is furniture only if the model says so, whatever its length
    (where the sample is too small to say anything, it is prose). Every row of
    ``documents`` is split whole, repeated texts and ids included; rows with a
    NULL id go. Only the named columns are read. The model is fitted on at most
    ``fit_texts`` texts of least hash, up to ``fit_chars`` characters of them.
    """
    rows = documents.select(documents[doc_id].cast("bigint").alias("doc_id"), documents[text].alias("text")).where("doc_id IS NOT NULL AND length(text) > 0")
    hashed = rows.select(F.xxhash64("doc_id", "text").alias("h"), F.length("text").alias("n"), "text")
    least = hashed.select("h", "n").distinct().orderBy("h").limit(fit_texts).collect()
    sizes = np.cumsum([r.n for r in least])
    many = max(1, int(np.searchsorted(sizes, fit_chars, side="right")))  # texts, of which copies count once
    sample = []
    if least:
        chosen = hashed.where(F.col("h") <= least[min(many, len(least)) - 1].h)
        sample = [r.text for r in chosen.select("h", F.substring("text", 1, fit_chars).alias("text")).dropDuplicates(["h"]).orderBy("h").collect()]
    return spread(rows).mapInArrow(_splitter(fit(sample)), "doc_id bigint, end_pos int")
