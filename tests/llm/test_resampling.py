"""Importance resampling against a plain rendering of its rules."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
import samples
from pyspark.sql import functions as F

from tocsin.llm import resampling
from tocsin.llm.common import Written

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def features(text: str | None, longest: int) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return [
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def by_hand(rows, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024) -> Counter:
    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, longest))

    own, its = counted(t for _, t in rows), counted(target)
    all_own, all_its = sum(own.values()), sum(its.values())
    gain = [
        math.floor(1000.0 * math.log(
            (its[b] + 1) * float(all_own + buckets) / ((own[b] + 1) * float(all_its + buckets))
        ))
        for b in range(buckets)
    ]
    scored = []
    for doc_id, text in rows:
        found = [zlib.crc32(f.encode()) % buckets for f in features(text, longest)]
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(found), weight, weight + noise, len(features(text, 1))))
    able = sorted(
        (r for r in scored if r[4] >= least),
        key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]),
    )
    rank = {}
    for place, r in enumerate(able[: len(able) * percent // 100], 1):
        rank.setdefault(r, []).append(place)
    return Counter((*r[:4], rank[r].pop(0) if rank.get(r) else None) for r in scored)


def found(docs, target, **kind) -> Counter:
    return Counter(map(tuple, resampling.resampled(docs, target, **kind).collect()))


@pytest.mark.parametrize(
    "kind",
    [{"percent": 50, "least": 0}, {"longest": 3, "buckets": 97}],
)
def test_equals_plain_rules(spark, kind):
    docs = samples.messy(spark)
    target = docs.where("doc_id % 5 = 0")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [r.text for r in target.collect()]
    names = {"least": "least_words"}
    asked = {names.get(k, k): v for k, v in kind.items()}
    assert found(docs, target, **asked) == by_hand(rows, texts, **kind)


def test_many_rows_with_one_id_and_score(spark):
    """The cutoff falls among rows that share score, id and features."""
    base = spark.createDataFrame([(i, "a b c " * 10) for i in range(20)], "doc_id LONG, text STRING")
    same = spark.range(400).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("a b c " * 10).alias("text")
    )
    docs = base.unionByName(same.repartition(7))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for percent in (3, 40):
        got = found(docs, base, percent=percent)
        assert got == by_hand(rows, [t for _, t in rows[:20]], percent=percent)


def test_same_rows_under_any_partitioning(spark):
    docs = samples.messy(spark)
    assert found(docs, docs) == found(docs.repartition(11), docs.coalesce(1))


def test_kept_columns_and_no_rows(spark):
    docs = samples.messy(spark)
    kept = resampling.resampled(docs, docs, columns=("text", "score", "row"), percent=100)
    assert kept.columns[-3:] == ["text", "score", "row"]
    assert Counter(r.text for r in kept.collect()) == Counter(r.text for r in docs.collect())
    nothing = samples.empty(spark)
    assert resampling.resampled(nothing, docs).collect() == []
    assert len(resampling.resampled(docs, nothing).collect()) == docs.count()


def test_threshold_by_bisection(spark):
    values = [-7, -7, -3, 0, 0, 0, 4, 9, 9, 1 << 60]
    rows = spark.createDataFrame([(v,) for v in values], "v LONG")
    for wanted in range(1, len(values) + 1):
        cut, below = resampling.first_reaching(rows, F.col("v"), wanted)
        assert cut == values[wanted - 1] and below == sum(v < cut for v in values)


def test_ranks_over_many_partitions(spark):
    held = Written(spark, "test-ranks")
    rows = spark.range(5000).select(
        (F.col("id") % 13).alias("score"), (F.col("id") % 50).alias("doc"),
        F.lit(1).alias("n_features"), F.col("id").alias("row"),
    )
    got = {r.row: r["rank"] for r in resampling.ranked(rows, held).collect()}
    order = sorted(range(5000), key=lambda i: (-(i % 13), i % 50, i))
    assert got == {i: place for place, i in enumerate(order, 1)}
