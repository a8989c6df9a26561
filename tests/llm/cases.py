"""Texts that every operator has to bear, and helpers to check them."""

import random
import re

from fleetgrid.llm.common import Scratch

WORDS = "the of and river stone cloud garden lamp paper window silver bread mountain quiet".split()


def prose(seed, n, sentence=9):
    rng, out = random.Random(seed), []
    for i in range(n):
        word = rng.choice(WORDS) + rng.choice(["", "s", "ly", "er"]) + str(rng.randrange(40) or "")
        out.append(word + ("." if i % sentence == sentence - 1 else ""))
    return " ".join(out)


def documents():
    """(doc_id, text): nulls, empty, blank, one word, repeats, ties and a very long text."""
    passage = prose(1, 70)
    near = prose(2, 120)
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n \r\n"),
        (4, "Word"),
        (5, "It's \x00 odd \x85 text É ß 😀 ́ <|endoftext|>  x"),
        (6, near),
        (7, near),
        (8, near.replace("river", "lake", 1)),
        (9, near.upper()),
        (10, f"{prose(3, 60)}\n{passage}\n{prose(4, 60)}"),
        (11, f"{prose(5, 60)}\n{passage}"),
        (12, f"{passage}\n{passage}\n{prose(6, 30)}"),
        (13, prose(7, 20_000)),
        (14, "x" * 200_000),
        (15, "1 2 " * 20_000),
        (16, "spam spam spam " * 40),
        (None, prose(8, 60)),
    ]
    line = "  This very line stands in many documents, and is long.  "
    rows += [(100 + i, f"{prose(20 + i, 55)}\n{line if i % 2 else line.upper()}") for i in range(7)]
    return [*rows, (6, near), (106, rows[-1][1])]


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def scratch(spark):
    return Scratch(spark, "test")


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
