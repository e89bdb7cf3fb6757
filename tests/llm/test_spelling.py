"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
import samples
from pyspark.sql import functions as F

from tocsin.llm import spelling
from tocsin.llm.common import Written
from tocsin.llm.queries import misspelt


def near(a: str, b: str) -> bool:
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts: dict[str, int], times: int = 10) -> set[tuple]:
    forms, rows = {}, []
    around = {w: [v for v in counts if near(w, v)] for w in counts}
    for word, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= times * counts[word]:
            forms[word] = best
    for word, others in around.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        rows.append((word, form, root, counts[word], len(others), counts.get(form)))
    return set(rows)


def words_of(rng: random.Random, letters: str, number: int) -> list[str]:
    made = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(number)}
    start = "preambl"
    return sorted(made | {start + rng.choice(letters) * (i % 3) + rng.choice(letters) for i in range(40)})


@pytest.mark.parametrize("letters", ["ab", "abé", "aÀÿz𝕏"])
def test_index_finds_every_near_pair(letters):
    words = words_of(random.Random(len(letters)), letters, 400)
    found = [frozenset(p) for p in spelling.TwoWayIndex(words, words).links((words, words))]
    expected = {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 50


@pytest.mark.parametrize("most,shard", [(100_000, 100_000), (3, 40)])
def test_grouping_equals_brute_force(spark, monkeypatch, most, shard):
    """Also where nearly every half is shared too often and is cut further, in many shards."""
    rng = random.Random(4)
    counts = {w: 10 ** rng.randint(0, 5) + rng.randint(0, 1) for w in words_of(rng, "ab", 250)}
    monkeypatch.setattr(spelling, "SHARD_ROWS", shard)
    monkeypatch.setattr(spelling.links, "__defaults__", (most,))
    frame = spark.createDataFrame([*counts.items()], "word STRING, n LONG").repartition(3)
    got = [tuple(r) for r in spelling.grouped(frame).collect()]
    assert len(got) == len(counts) and set(got) == by_hand(counts)
    assert any(row[2] != (row[1] or row[0]) for row in got)  # forms of forms


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [("x", "w3")]
    held = Written(spark, "test-roots")
    found = spelling.roots(spark.createDataFrame(chain, "word STRING, form STRING"), held)
    assert {r.word: r.root for r in found.collect()} == {w: "w19" for w, _ in chain}


def spelt(rows) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return counts


def test_words_of_messy_documents(spark):
    docs = samples.messy(spark)
    runs = spelling.runs(docs)
    words = runs.select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    found = spelling.vocabulary(words)
    counts = spelt((r.doc_id, r.text) for r in docs.collect())
    expected = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert {r.word: r.n for r in found.collect()} == expected
    assert {tuple(r) for r in spelling.grouped(found).collect()} == by_hand(expected)


def test_no_words_and_very_long_ones(spark):
    assert spelling.grouped(spelling.vocabulary(
        spelling.runs(samples.empty(spark)).withColumnRenamed("run", "word")
    )).collect() == []
    long = "ab" * 2000
    counts = {long: 50, long[:700] + "c" + long[700:]: 3, long[:-1]: 500, "abababa": 2}
    frame = spark.createDataFrame([*counts.items()], "word STRING, n LONG")
    assert {tuple(r) for r in spelling.grouped(frame).collect()} == by_hand(counts)
