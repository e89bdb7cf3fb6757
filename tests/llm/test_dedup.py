"""SimHash, exact substring and embedding dedup against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import samples
import xxhash
from pyspark.sql import functions as F

from tocsin.llm import embedding_dedup, simhash, suffix_dedup
from tocsin.llm.common import Written
from tocsin.llm.components import components
from tocsin.llm.grouping import suffix_arrays
from tocsin.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


# --- SimHash ----------------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = 4) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def by_hand(rows: list[tuple], bits: int = 4) -> Counter:
    prints = [fingerprint(t) for _, t in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= bits
    ]
    group = samples.components(len(rows), pairs)
    least: dict[int, int | None] = {}
    for (doc_id, _), g in zip(rows, group):
        known = [x for x in (least.get(g), doc_id) if x is not None]
        least[g] = min(known, default=None)
    return Counter(
        (d, f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, group)
    )


def simhashed(df) -> Counter:
    found = simhash.near_duplicates(df).select(
        "doc_id", simhash.hex_digits("print"), "component_id"
    )
    return Counter(map(tuple, found.collect()))


@pytest.mark.parametrize("shard", [16, 100_000])
def test_simhash_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard)
    monkeypatch.setattr(simhash, "LEAF_ROWS", 8)
    df = samples.messy(spark)
    assert simhashed(df) == by_hand([(r.doc_id, r.text) for r in df.collect()])


def test_simhash_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 32)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    assert simhashed(docs) == by_hand([tuple(r) for r in docs.collect()])


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(samples.empty(spark)).collect() == []


def test_tree_reaches_all_near_points():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    points = np.unique(np.concatenate([base, near]))
    tree = simhash.Tree(points, 16)
    found = set()
    for q, p in simhash.close_pairs(tree, points, 4):
        found |= set(zip(points[q].tolist(), p.tolist()))
    apart = np.bitwise_count(points[:, None] ^ points[None, :])
    expected = {(int(points[i]), int(points[j])) for i, j in zip(*np.nonzero(apart <= 4))}
    assert found == expected and len(expected) > len(points)


def test_links_connect_all_near_fingerprints(spark):
    """Many shards, and chains of fingerprints a few bits apart."""
    rng = np.random.default_rng(8)
    prints = list(rng.integers(-(1 << 62), 1 << 62, 700))
    for _ in range(900):
        flips = rng.integers(0, 62, rng.integers(1, 7))
        prints.append(int(prints[rng.integers(len(prints))]) ^ sum({1 << int(k) for k in flips}))
    points = np.unique(np.array(prints, np.int64))
    frame = spark.createDataFrame([(int(p),) for p in points], "print LONG").repartition(5)
    tree = simhash.Tree(rng.permutation(points)[:400].view(np.uint64), 8)
    assert len(tree.leaves) > 20
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    group = samples.components(len(points), list(zip(*map(list, np.nonzero(np.triu(near, 1))))))
    rows = simhash.routed(frame, tree, 4)
    at_home = rows.filter("NOT visitor").groupBy("print").count()
    assert at_home.count() == len(points) and at_home.agg(F.max("count")).first()[0] == 1
    at = {int(p): i for i, p in enumerate(points)}
    found = samples.components(
        len(points), [(at[r.a], at[r.b]) for r in simhash.links(rows, 4).collect()]
    )
    assert found == group and len(set(group)) < 1000


# --- components -------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = np.random.default_rng(7)
    n = 120
    pairs = {
        "chain": [(i, i + 1) for i in range(60)] + [(100, 101)],
        "star": [(5, i) for i in range(6, 90)],
        "random": [tuple(map(int, rng.integers(0, n, 2))) for _ in range(70)],
    }[shape]
    frame = spark.createDataFrame([(a - 50, b - 50) for a, b in pairs], "a LONG, b LONG")
    group = samples.components(n, pairs)
    expected = {i - 50: g - 50 for i, g in enumerate(group) if g != i}
    found = components(frame, Written(spark, "test")).collect()
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)


# --- suffix arrays ----------------------------------------------------------------------------


def test_linear_grouping_sorts_suffixes():
    rng = np.random.default_rng(1)
    for kinds in (1, 2, 4, 30):
        texts = [[*rng.integers(1, kinds + 1, rng.integers(0, 90)).tolist(), 0] for _ in range(40)]
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        found = suffix_arrays(np.concatenate(texts).astype(np.int64), starts, sizes)
        for text, start, size in zip(texts, starts, sizes):
            own = found[start : start + size] - start
            assert own.tolist() == sorted(range(size), key=lambda i: text[i:])


def cut_by_hand(rows: list[tuple], span: int = 50) -> Counter:
    data = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    first: dict[bytes, float] = {}
    for doc, text in data:
        for i in range(len(text) - span + 1):
            window = text[i : i + span]
            first[window] = min(first.get(window, doc), doc)
    found = []
    for (doc_id, _), (doc, text) in zip(rows, data):
        gone = bytearray(len(text))
        for i in range(len(text) - span + 1):
            if first[text[i : i + span]] < doc:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        digest = hashlib.sha256(kept).hexdigest()
        found.append((doc_id, len(text), sum(gone), spans, digest))
    return Counter(found)


@pytest.mark.parametrize(("crowd", "contexts"), [(1024, 32), (1024, 2), (2, 32)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, crowd, contexts):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "TEXT_CONTEXTS", contexts)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 14)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 1 << 14)
    df = samples.messy(spark)
    found = Counter(map(tuple, suffix_dedup.deduplicated(df, texts=False).collect()))
    assert found == cut_by_hand([(r.doc_id, r.text) for r in df.collect()])


def test_runs_of_windows():
    for mask in (0, 1, 0b1011, 0b11100, (1 << 31) - 1, 1 << 30):
        found = [i for a, b in suffix_dedup.runs(mask) for i in range(a, b + 1)]
        assert found == [i for i in range(31) if mask >> i & 1]


def test_suffix_dedup_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    found = Counter(map(tuple, QUERIES["op4_suffix_dedup"](spark, SMALL).collect()))
    assert found == cut_by_hand([tuple(r) for r in docs.collect()])


def test_suffix_dedup_returns_the_kept_bytes(spark):
    df = spark.createDataFrame(
        [(2, "x" + "0123456789" * 6 + "y"), (1, "0123456789" * 6)], "doc_id LONG, text STRING"
    )
    found = {r.doc_id: bytes(r.kept) for r in suffix_dedup.deduplicated(df).collect()}
    assert found == {1: b"0123456789" * 6, 2: b"xy"}
    assert suffix_dedup.deduplicated(samples.empty(spark)).collect() == []


def test_anchor_messages_are_short():
    """A packed anchor took 20 bytes and more before its columns left out what is zero."""
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, 1500, np.uint8).tobytes() for _ in range(400)]
    packer = suffix_dedup.Packer(3)
    packer.add(np.arange(400), np.zeros(400, np.int64), texts)
    packed = [m for m in packer.messages() if m.num_rows and m["kind"][0].as_py() == 0]
    data = [m["data"][0].as_py() for m in packed]
    count = 0
    for x in data:
        names, rest = suffix_dedup.rows_of(memoryview(x), suffix_dedup.NAME)
        entries, rest = suffix_dedup.rows_of(rest, suffix_dedup.ENTRY)
        assert not len(rest) and (names[2] == 1500).all() and (entries[2] <= 1480).all()
        count += len(entries[0])
    assert count == len(suffix_dedup.anchors(texts)[0])
    assert sum(map(len, data)) < 18 * count


def test_columns_come_back():
    rng = np.random.default_rng(4)
    for n in (0, 1, 50):
        columns = [
            rng.integers(-5, 5, n), rng.integers(0, 1 << 62, n), np.zeros(n, np.int64),
            rng.integers(0, 300, n).astype("<u4"),
        ]
        data = memoryview(suffix_dedup.columns_of(*columns) + b"rest")
        found, rest = suffix_dedup.rows_of(data, ("<i8", "<i8", "<i8", "<u4"))
        assert [x.tolist() for x in found] == [x.tolist() for x in columns]
        assert bytes(rest) == b"rest"


def test_first_documents_with_equal_hashes_of_two_anchors():
    anchor = np.array([1, 2, 1, 2, 3], np.uint64)
    context = np.array([7, 7, 7, 7, 8], np.uint64)
    doc = np.array([5, 4, 3, 6, 9])
    assert suffix_dedup.first_documents(anchor, context, doc).tolist() == [3, 4, 3, 4, 9]


def test_equal_rows_of_one_document_get_each_message_once(spark):
    """Each of n equal rows used to be sent the messages of all n."""
    rng = np.random.default_rng(9)
    passage = rng.integers(97, 123, 120, np.uint8).tobytes().decode()
    rows = [(1, passage + "one")] + [(2, "two" + passage)] * 300
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    held = Written(spark, "test")
    found = suffix_dedup.removals(docs, held)
    lists = suffix_dedup.with_texts(docs, found, "left").where("doc_id = 2")
    assert lists.agg(F.max(F.size("data"))).first()[0] <= 10
    result = Counter(map(tuple, suffix_dedup.deduplicated(docs, texts=False).collect()))
    assert result == cut_by_hand(rows)


def test_crowded_anchors_tell_a_document_once(spark):
    """Windows of a document, which meet others all over the partitions, come as one message."""
    rng = np.random.default_rng(11)
    letters = [rng.integers(97, 123, 40, np.uint8).tobytes().decode() for _ in range(120)]
    passage = rng.integers(97, 123, 300, np.uint8).tobytes().decode()
    rows = [(i, x + passage + x[::-1]) for i, x in enumerate(letters)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    asked = docs.select(
        F.col("doc_id").alias("doc"), suffix_dedup.document_key().alias("key"),
        F.udf(
            lambda: np.stack([np.arange(40, 300, 20), np.arange(13)], 1).tobytes(), "binary"
        )().alias("data"),
    )
    found = suffix_dedup.crowded(docs, asked, Written(spark, "test")).collect()
    assert len(found) < 140  # twice where a batch ends within a document
    told: dict[int, list[bytes]] = {}
    for r in found:
        told.setdefault(r.doc, []).append(r.data)
    assert sorted(told) == list(range(1, 120))
    for data in told.values():
        ranges = [np.concatenate(x) for x in zip(*map(suffix_dedup.unpacked_ranges, data))]
        start, stop = suffix_dedup.united(*ranges)
        # A letter more at either end where the texts around the passage happen to agree.
        assert len(start) == 1 and start[0] <= 40 and stop[0] >= 330


def test_removed_ranges_are_united():
    doc, key = np.array([2, 1, 2, 2, 2]), np.array([0, 0, 0, 1, 0])
    start, stop = np.array([5, 0, 0, 7, 60]), np.array([55, 50, 200, 57, 110])
    found = suffix_dedup.removed_anywhere(doc, key, start, stop).to_pylist()
    cut = suffix_dedup.unpacked_ranges
    ranges = {
        (r["doc"], r["key"]): list(map(tuple, np.stack(cut(r["data"]), 1).tolist()))
        for r in found
    }
    assert ranges == {(1, 0): [(0, 50)], (2, 0): [(0, 200)], (2, 1): [(7, 57)]}
    nothing = np.zeros(0, np.int64)
    assert suffix_dedup.removed_anywhere(*[nothing] * 4).num_rows == 0


# --- embeddings -------------------------------------------------------------------------------


def vectors_by_hand(rows: list[tuple], cosine: float = 0.9) -> Counter:
    vectors = []
    for _, v in rows:
        good = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        vectors.append(np.array(v, np.float32).astype(float) if good else None)

    def linked(a, b) -> bool:
        if a is None or b is None or len(a) != len(b):
            return False
        return a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine

    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i) if linked(vectors[i], vectors[j])]
    count = Counter(x for p in pairs for x in p)
    group = samples.components(n, pairs)
    least: dict[int, int] = {}
    for (vec_id, _), g in zip(rows, group):
        least[g] = min(least.get(g, vec_id), vec_id)
    return Counter(
        (vec_id, count[i], least[group[i]]) for i, (vec_id, _) in enumerate(rows)
    )


@pytest.mark.parametrize("part", [4, 4096])
def test_embeddings_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_dedup, "PART_ROWS", part)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(40):
        centre = rng.standard_normal(20)
        for k in range(1 + i % 5):
            rows.append((len(rows), (centre + 0.15 * k * rng.standard_normal(20)).tolist()))
    same = rows[3][1]
    rows += [
        (500, same), (501, same), (501, same), (502, [2 * x for x in same]), (503, None), (504, []),
        (505, [0.0] * 20), (506, [float("nan")] + same[1:]), (507, [None, *same[1:]]),
        (508, same[:10]), (509, same[:10]), (510, [float("inf")] * 20), (511, [1.0]), (512, [3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>")
    df = df.withColumns({n: F.lit(n) for n in ("id", "key", "size", "weight", "x", "label")})
    found = embedding_dedup.near_duplicates(df.repartition(4))
    assert Counter(map(tuple, found.collect())) == vectors_by_hand(rows)


def test_embeddings_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id LONG, embedding ARRAY<FLOAT>")
    assert embedding_dedup.near_duplicates(df).collect() == []


def test_embeddings_of_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = QUERIES["op9_embedding_dedup"](spark, "/root/testdata/sf0.01").collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == vectors_by_hand(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_embeddings_write_little(spark, monkeypatch):
    """Shuffled and written bytes stay within a few times the vectors, in which nothing prunes."""
    roots, disk = [], spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    class Kept(Written):
        def __init__(self, *args):
            super().__init__(*args)
            roots.append(Path(self.root.removeprefix("file:")))

        def drop(self, *tables):
            pass

        def release(self):
            pass

    def shuffled() -> int:
        files = disk.getAllFiles()
        found = (files.apply(i) for i in range(files.size()))
        return sum(f.length() for f in found if f.getName().endswith(".data"))

    monkeypatch.setattr(embedding_dedup, "Written", Kept)
    rng, n, size = np.random.default_rng(7), 4000, 64
    rows = rng.standard_normal((n, size)).astype(np.float32)
    rows[1::50] = rows[::50] + 0.02 * rng.standard_normal((n // 50, size)).astype(np.float32)
    df = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(rows)], "vec_id LONG, embedding ARRAY<FLOAT>"
    )
    spark._jvm.System.gc()
    before = shuffled()
    linked = embedding_dedup.near_duplicates(df).collect()
    found = {r.vec_id: (r.n_links, r.component_id) for r in linked}
    made = shuffled() - before + sum(f.stat().st_size for f in roots[0].rglob("*.parquet"))
    assert found == {i: (int(i % 50 < 2), i - (i % 50 == 1)) for i in range(n)}
    assert made < 8 * n * size * 4


def test_embeddings_of_clusters(spark, monkeypatch):
    """Tiles, pivots and narrow bounds leave no link out, whichever way the chunks are cut."""
    monkeypatch.setattr(embedding_dedup, "PART_ROWS", 200)
    monkeypatch.setattr(embedding_dedup, "PIVOT_ROWS", 8)
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((30, 48))
    spread = rng.choice([0.05, 0.2, 0.45, 0.6], 900)[:, None]
    points = centres[rng.integers(0, 30, 900)] + spread * rng.standard_normal((900, 48))
    rows = [(i, row.tolist()) for i, row in enumerate(points.astype(np.float32).astype(float))]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>").repartition(5)
    found = embedding_dedup.near_duplicates(df)
    assert Counter(map(tuple, found.collect())) == vectors_by_hand(rows)


def test_embeddings_of_doubles(spark):
    rows = [(1, [1.0, 1e-9]), (2, [1.0, 2e-9]), (3, [-1.0, 0.0]), (4, None), (5, [0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    found = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()))
    assert found == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5)]
