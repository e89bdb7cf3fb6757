"""Small tables with everything that may go wrong in them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
SYLLABLES = "the on er ing tion ha st re ou éa ül ñó an le de".split()
LICENCE = "Licensed under the Apache License, Version 2.0."


def prose(rng: random.Random, words: int) -> str:
    found = []
    for i in range(words):
        word = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
        found.append(word.capitalize() if i % 9 == 0 else word)
        if i % 9 == 8:
            found[-1] += rng.choice([".", ".\n", ",", "!"])
    return " ".join(found)


def rows(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages and lines, odd white space, nulls, long texts, ties."""
    rng = random.Random(seed)
    passage, line = prose(rng, 60), "One line that many pages share."
    found = []
    for i in range(60):
        text = prose(rng, rng.randint(1, 200))
        if i % 7 == 0:
            text = text + " " + passage + " " + prose(rng, 20)
        if i % 2 == 0:
            text = line + "\n" + text
        if i % 11 == 0:
            text = text + "\n" + LICENCE
        found.append((i, text, "en", f"src{i % 3}", len(text)))
    copied = found[7][1]
    words = found[9][1].split(" ")
    near = " ".join(words[:40] + ["changed"] + words[41:])
    found += [
        (60, copied, "en", "src0", 1), (61, copied, "en", None, 1), (61, copied, "en", None, 1),
        (62, near, "en", "src1", 1), (63, None, None, None, None), (64, "", "", "", 0),
        (65, " \t\n\x0b\x0c\r ", "en", "src0", 7), (None, copied, "en", "src2", 1),
        (None, "no id", None, "src2", 5), (66, "one", "en", "src0", 3),
        (67, prose(rng, 6000), "en", "src0", 1), (68, "a" * 3000 + " b" * 900, "en", "src1", 1),
        (69, "<|endoftext|>Hi  there<|startoftext|> \x1c x\x85y ΑΣ", "en", "src1", 1),
        (70, "\x00" * 120 + copied[:200], "en", "src2", 1), (71, copied[:200], "en", "src2", 1),
        (72, "AbC def\xa0ghi jkl", "en", "src2", 1), (73, "aBc DEF\xa0ghi jkl", "en", "src2", 1),
    ]
    return found


def messy(spark: SparkSession) -> DataFrame:
    """The rows with extra columns, named like those that operators use inside."""
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    names = (
        "print ids key data size bucket host page group component_id doc row kind _row _id _host "
        "_page words target taken features score label weight"
    ).split()
    return df.withColumns({n: F.lit(n) for n in names})


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def components(n: int, pairs) -> list[int]:
    """The smallest member of each one's component."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]
