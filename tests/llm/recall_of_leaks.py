"""python tests/llm/recall_of_leaks.py [FOLDER]: how many altered passages of the evaluation items are found.

Passages of every length are cut out of the items at random, and up to one word
in seven (without blanks: one character) is replaced, dropped or joined by
another; each stands in wording of its own. Prints the share that is found, by
script, length and number of alterations.
"""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import pyarrow.parquet as pq

from weftline.llm import leaks

NOISE = "The court heard the parties and found that nothing more was owed to either of them. "
NOISE_HAN = "法院听取了双方的意见，认为任何一方均不再欠付款项。"


def items_of(folder: str) -> list[tuple[int, str]]:
    rows = pq.read_table(f"{folder}/eval_items.parquet").to_pylist()
    return [(r["item_id"], r["text"]) for r in rows if r["text"]]


def altered(units: list[str], many: int, others: list[str], rng: random.Random) -> list[str]:
    out = list(units)
    for k in sorted(rng.sample(range(1, len(units) - 1), many), reverse=True):
        kind = rng.random()
        if kind < 0.5:
            out[k] = rng.choice(others)
        elif kind < 0.75:
            del out[k]
        else:
            out.insert(k, rng.choice(others))
    return out


def recall(items: list[tuple[int, str]], lengths: list[int], share: float, tries: int, han: bool, seed: int = 1) -> float:
    """Of ``tries`` passages for each length, with the given share of their words altered, those that are found."""
    rng = random.Random(seed)
    scripts = leaks.build(items)
    own = [(i, t) for i, t in items if leaks._is_blankless(leaks._stream([t])[1][:-1]) == han]
    texts, wanted = [], []
    for length in lengths:
        for _ in range(tries):
            item, text = rng.choice(own)
            units = [c for c in text if c.isalnum()] if han else text.split()
            if len(units) <= length:
                continue
            at = rng.randrange(len(units) - length)
            others = list("遥远安静山水火木金土日月") if han else ["entirely", "redacted", "qux", "the", "somewhat", "l0st"]
            passage = altered(units[at : at + length], int(share * length), others, rng)
            noise = NOISE_HAN if han else NOISE
            texts.append(noise * 3 + ("" if han else " ").join(passage) + (noise if han else ". " + noise) * 2)
            wanted.append((len(texts) - 1, item))
    found = set(leaks.find(texts, scripts, 20, 28, 6 / 7))
    return sum(w in found for w in wanted) / len(wanted)


def main(folder: str = "/root/testdata/sf0.1") -> None:
    items = items_of(folder)
    for han, lengths in ((False, [20, 24, 28, 35, 45]), (True, [31, 36, 42, 50, 60])):
        for length in lengths:
            print("without blanks" if han else "words", length, *(f"{many}: {recall(items, [length], (many + 0.01) / length, 600, han):.3f}" for many in range(0, length // 7 + 1)), flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
