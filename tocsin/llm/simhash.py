"""SimHash near-dedup: fingerprints, and vantage-point trees that find all within a few bits.

Equal fingerprints become one first, so copies cost nothing further. A top tree, fitted on a
bounded sample, splits the distinct fingerprints at median Hamming distances from vantage points
into shards of about equal size. A fingerprint lives in one shard; as a query it also visits every
shard that its ball may reach: beyond a vantage point's radius only where its distance is within
the bit limit of that radius, by the triangle inequality. Each pair meets in one shard, as only
shards after the own one are visited. Within a shard a tree of the same kind, built from the
shard's own rows, prunes again, and what remains is compared bit by bit. A task hands on links
that span its groups, not all pairs; they become components by contraction.

A ball of 4 bits among random 64-bit fingerprints crosses most median boundaries (about 0.85 of
each level's shards are reached), so work grows faster than the input; the README has figures.

Defined results: null and empty texts have fingerprint zero and are linked like others; repeated
rows are linked; a null doc_id takes part, and names a component only if no other does; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import Written, byte_values
from tocsin.llm.components import Forest, components

SHINGLE, MOST_BITS, SEED = 4, 4, 42
#: Distinct fingerprints in a shard, sample rows per shard, and the largest sample for the tree.
SHARD_ROWS, SAMPLE_PER_SHARD, SAMPLE_MOST = 65_536, 256, 65_536
#: Rows below which a shard's own tree is not split, and of a block compared at once.
LEAF_ROWS, BLOCK_ROWS = 512, 1024
HASHES_AT_ONCE = 1 << 15


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text given as UTF-8."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = (ends - length).tolist()
    n = max(1, len(words) - shingle + 1)
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, HASHES_AT_ONCE):
        pairs = zip(starts[i : i + HASHES_AT_ONCE], stops[i : i + HASHES_AT_ONCE])
        some = np.array([digest(joined[s:e], SEED) for s, e in pairs], "<u8")
        each = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += each.sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(text: str, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            found = np.array([fingerprint(x, shingle) for x in byte_values(array)], np.uint64)
            yield pa.array(found.view(np.int64))

    return run(F.col(text))


def hex_digits(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def bits_apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


class Tree:
    """A vantage-point tree over fingerprints; leaves are numbered from left to right."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.nodes: list[tuple] = []
        self.leaves: list[np.ndarray] = []
        self.root = self.build(np.unique(points), leaf)

    def build(self, points: np.ndarray, leaf: int) -> int:
        if len(points) > leaf:
            # Of a few points, the one whose distances spread most.
            some = points[:: max(1, len(points) // 8)][:8]
            far = [bits_apart(points, p) for p in some]
            best = int(np.argmax([d.var() for d in far]))
            radius = int(np.median(far[best]))
            inner = far[best] <= radius
            if inner.all():
                radius -= 1
                inner = far[best] <= radius
            if inner.any():
                place = len(self.nodes)
                self.nodes.append(())
                left = self.build(points[inner], leaf)
                right = self.build(points[~inner], leaf)
                self.nodes[place] = (some[best], radius, left, right)
                return place
        self.leaves.append(points)
        return -len(self.leaves)

    def reach(self, queries: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, and the numbers of the queries whose ball may reach them."""
        waiting = [(self.root, np.arange(len(queries)))]
        while waiting:
            node, who = waiting.pop()
            if node < 0:
                yield -node - 1, who
                continue
            point, radius, left, right = self.nodes[node]
            far = bits_apart(queries[who], point)
            for child, near in ((left, far <= radius + bits), (right, far > radius - bits)):
                if near.any():
                    waiting.append((child, who[near]))


def close_pairs(
    tree: Tree, queries: np.ndarray, bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of ``(query numbers, points, points' leaf)`` within ``bits`` of one another."""
    for leaf, who in tree.reach(queries, bits):
        points = tree.leaves[leaf]
        for i in range(0, len(who), BLOCK_ROWS):
            part = who[i : i + BLOCK_ROWS]
            for j in range(0, len(points), BLOCK_ROWS):
                block = points[j : j + BLOCK_ROWS]
                near = np.bitwise_count(queries[part][:, None] ^ block[None, :]) <= bits
                q, p = np.nonzero(near)
                if len(q):
                    yield part[q], block[p]


class Shard:
    """The rows of one shard: first those that live there, then visitors as they come."""

    def __init__(self, bits: int):
        self.bits, self.home, self.tree = bits, [], None

    def add(self, rows: np.ndarray) -> None:
        self.home.append(rows)

    def settle(self) -> None:
        self.points = np.sort(np.concatenate(self.home)) if self.home else np.zeros(0, np.uint64)
        self.forest = Forest(len(self.points))
        if len(self.points):
            self.tree = Tree(self.points, LEAF_ROWS)
            for q, p in close_pairs(self.tree, self.points, self.bits):
                self.forest.union(q, np.searchsorted(self.points, p))

    def visit(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A link from each visitor that is close to a row of the shard."""
        first = np.full(len(rows), -1)
        if self.tree:
            for q, p in close_pairs(self.tree, rows, self.bits):
                at = np.searchsorted(self.points, p)
                new = first[q] < 0
                first[q[new]] = at[new]
                self.forest.union(first[q], at)
        hit = first >= 0
        return rows[hit], self.points[first[hit]]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        root = self.forest.roots(np.arange(len(self.points)))
        moved = root != np.arange(len(self.points))
        return self.points[moved], self.points[root[moved]]


def routed(prints: DataFrame, tree: Tree, bits: int) -> DataFrame:
    """``shard``, ``visitor`` and ``print``: the home of each fingerprint and later shards that it
    visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            home = np.zeros(len(rows), np.int64)
            for shard, who in tree.reach(rows, 0):
                home[who] = shard
            visits = [*tree.reach(rows, bits)]
            for shard, who in visits:
                who = who[home[who] <= shard]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(who), shard, np.int32)),
                        pa.array(home[who] != shard),
                        pa.array(rows[who].view(np.int64)),
                    ],
                    ["shard", "visitor", "print"],
                )

    return prints.mapInArrow(run, "shard int, visitor boolean, print long")


def links(rows: DataFrame, bits: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints within ``bits`` of one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(x.view(np.int64)) for x in (a, b)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        number, shard, settled = None, None, False
        for batch in batches:
            shards = batch.column(0).to_numpy()
            visitor = batch.column(1).to_numpy(zero_copy_only=False)
            prints = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((shards[1:] != shards[:-1]) | (visitor[1:] != visitor[:-1])) + 1
            for i, j in zip([0, *cuts], [*cuts, len(shards)]):
                if i == j:
                    continue
                if shards[i] != number:
                    if shard:
                        if not settled:
                            shard.settle()
                        yield out(*shard.links())
                    number, shard, settled = shards[i], Shard(bits), False
                if not visitor[i]:
                    shard.add(prints[i:j])
                    continue
                if not settled:
                    shard.settle()
                    settled = True
                yield out(*shard.visit(prints[i:j]))
        if shard:
            if not settled:
                shard.settle()
            yield out(*shard.links())

    ordered = rows.repartition("shard").sortWithinPartitions("shard", "visitor")
    return ordered.mapInArrow(run, "a long, b long")


def fitted_tree(prints: DataFrame, rows: int) -> Tree:
    """The top tree, from a sample of distinct fingerprints chosen by their hash."""
    shards = -(-rows // SHARD_ROWS)
    wanted = min(SAMPLE_MOST, SAMPLE_PER_SHARD * shards) if shards > 1 else 0
    share = int((1 << 30) * min(1.0, wanted / max(1, rows)))
    chosen = prints.where(F.pmod(F.xxhash64("print"), F.lit(1 << 30)) < share).limit(2 * SAMPLE_MOST)
    points = np.array([r.print for r in chosen.collect()], np.int64).view(np.uint64)
    return Tree(points, max(1, len(points) // max(1, shards)))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = MOST_BITS
) -> DataFrame:
    """``doc_id``, ``print`` (the fingerprint), ``group`` (a fingerprint that names what links of at
    most ``bits`` connect) and ``component_id``, the smallest doc_id of the group."""
    held = Written(docs.sparkSession, "simhash")
    rows = held.table(docs.select("doc_id", fingerprints("text", shingle).alias("print")))
    prints = held.table(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    tree = fitted_tree(prints.select("print"), prints.count())
    found = held.table(links(routed(prints.select("print"), tree, bits), bits))
    stars = components(found, held)
    group = F.coalesce("component", "print")
    named = held.table(
        prints.join(stars, F.col("print") == F.col("node"), "left").select(
            "print", "least", group.alias("group")
        )
    )
    least = held.table(named.groupBy("group").agg(F.min("least").alias("component_id")))
    classes = held.table(named.select("print", "group").join(least, "group"))
    return rows.join(classes, "print").select("doc_id", "print", "group", "component_id")
