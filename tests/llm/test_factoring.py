"""Relative Lempel-Ziv parsing against window-by-window brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
import samples
import xxhash
from pyspark.sql import functions as F

from tocsin.llm import factoring

WINDOW = factoring.WINDOW


def by_hand(rows) -> Counter:
    """Rows of equal doc_id and text are one document; of equal doc_id, in the order of a hash."""
    texts = {(d, t or "") for d, t in rows}
    key = lambda t: xxhash.xxh64(t.encode(), 42).intdigest()
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    order = sorted(texts, key=lambda r: (r[0] is None, r[0] or 0, signed(key(r[1]))))
    seen, result = set(), {}
    for doc_id, text in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            window = " ".join(words[i : i + WINDOW])
            if window in seen:
                gone.update(range(i, i + WINDOW))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        result[doc_id, text] = (doc_id, len(words), len(gone), kept)
    return Counter(result[d, t or ""] for d, t in rows)


def found(docs, **kind) -> Counter:
    return Counter(map(tuple, factoring.deduplicated(docs, **kind).collect()))


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("crowd", [1, 5, 2000])
def test_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(factoring, "WORDS_HELD", 500)
    monkeypatch.setattr(factoring, "HELD_BYTES", 20_000)
    docs = samples.messy(spark).withColumns(
        {n: F.lit(n) for n in ("anchor", "block", "start", "stop", "spans", "stretches", "words")}
    )
    expected = by_hand(pairs(docs))
    assert found(docs, crowd=crowd) == expected
    assert sum(n for _, _, n, _ in expected.elements()) > 300


def test_passages_between_different_words(spark):
    """Edges of shared passages, periodic texts, factors that start in another one's end."""
    rng = random.Random(6)
    base = [rng.choice("abcdefg") + str(rng.randint(0, 99)) for _ in range(400)]
    rows = []
    for i in range(120):
        a, b = sorted(rng.sample(range(400), 2))
        words = [f"x{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 25))]
        text = words + base[a:b] + rng.choice([[], ["y"] * 45, ["p", "q"] * 30, words])
        rows.append((rng.choice([i, i, 7, None]), " ".join(text + base[max(0, a - 30) : a + 12])))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5)
    expected = by_hand(rows)
    assert found(docs) == expected
    assert found(docs.coalesce(1), crowd=3) == expected


def test_many_equal_rows_of_one_id(spark):
    text = " ".join(f"w{i % 50}" for i in range(90))
    docs = spark.range(3000).select(
        F.when(F.col("id") < 10, F.col("id")).alias("doc_id"), F.lit(text).alias("text")
    ).repartition(6)
    assert found(docs) == by_hand(pairs(docs))


def test_very_long_periodic_text(spark):
    docs = spark.createDataFrame(
        [(1, "ab cd " * 100_000), (2, "cd ab " * 15 + "end"), (0, None), (3, "  ")],
        "doc_id LONG, text STRING",
    )
    got = {r.doc_id: (r.n_words, r.n_removed) for r in factoring.deduplicated(docs).collect()}
    assert got == {1: (200_000, 199_998), 2: (31, 30), 0: (0, 0), 3: (0, 0)}


def test_no_rows_and_digests(spark):
    assert factoring.deduplicated(samples.empty(spark)).collect() == []
    digests = factoring.deduplicated(samples.empty(spark), texts=False)
    assert digests.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
