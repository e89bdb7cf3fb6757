"""Embedding near-dedup: chunks of neighbouring vectors, each met by every other without a shuffle.

Vectors take the cell of the sampled pivot that is nearest to them, and are sorted by cell into
chunks of bounded size and bytes. The written chunks meet in a Cartesian product of their table
with itself, which reads the table again instead of shuffling it: what is written is a few times
the vectors, whatever their number. Pairs are still looked at in the square of that number, so
three exact bounds come before a pair's cosine:

* Rows of a tile (up to 128 rows of one cell) lie within an angle of its centre. A vector whose
  angle to the centre is larger by more than the angle of the least cosine links with none of them.
* After a fixed random rotation, the dot product of the first coordinates plus the product of the
  norms of the others is at least the cosine. That is one product of narrow matrices.
* The cosine in single precision, with room for its rounding. Only what falls within that room is
  settled by the cosine of the whole vectors in double precision, as every pair would be.

Equal vectors become one first. Links are counted and spanned inside the tasks; pairs are not
handed on.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing and stand alone; vectors of different lengths never link; repeated rows are linked
with one another; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import Written
from tocsin.llm.components import Forest, components

LEAST_COSINE = 0.9
#: Most rows and bytes of vectors in a chunk; the chunks that a small table is dealt into, and
#: how many rows are worth one.
PART_ROWS, PART_BYTES, SPREAD, LEAST_ROWS = 16384, 4 << 20, 32, 512
#: Most pivots and their bytes, and rows for each; rows of a tile.
PIVOTS, PIVOT_BYTES, PIVOT_ROWS, TILE_ROWS = 2048, 8 << 20, 64, 128
#: Tiles whose centres are compared at once. Tiles that reach this share of the visitors are
#: compared with all of them, so many rows of each at once.
CENTRES, NEARLY_ALL, HOME_ROWS, BLOCK_ROWS = 64, 0.7, 512, 512
#: Visiting chunks that a task keeps for the next row.
KEPT = 8
SEED = 20240


@lru_cache(4)
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation."""
    square = np.random.default_rng(SEED + size).standard_normal((size, size))
    q, r = np.linalg.qr(square)
    return q * np.sign(np.diag(r))


def lead_width(size: int, cosine: float) -> int:
    """How many coordinates tell nearly all unlinked pairs apart: 4.5 deviations of the dot product
    of random directions. ``size`` where fewer do not."""
    for k in range(8, size, 8):
        if (k / size - 1 + cosine) * size / k**0.5 >= 4.5:
            return k
    return size


def room(size: int) -> float:
    """More than the rounding of a dot product of unit vectors in single precision."""
    return (size + 8) * 2.0**-23


def kind_of(vectors: DataFrame) -> str:
    """How a vector's components are kept: floats as they are, other numbers as doubles."""
    element = vectors.schema["embedding"].dataType.elementType
    return "<f4" if element.typeName() == "float" else "<f8"


def packed(column: pa.Array, kind: str) -> list[bytes | None]:
    """The bytes of each usable vector."""
    ends = column.offsets.to_numpy()
    flat = column.values
    lost = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(kind, copy=False)
    bad = np.concatenate(([0], np.cumsum(lost | ~np.isfinite(values))))
    some = np.concatenate(([0], np.cumsum(values != 0)))
    good = column.is_valid().to_numpy(zero_copy_only=False)
    good &= (bad[ends[1:]] == bad[ends[:-1]]) & (some[ends[1:]] > some[ends[:-1]])
    data, ends = values.tobytes(), (ends * values.itemsize).tolist()
    return [data[i:j] if x else None for x, i, j in zip(good.tolist(), ends, ends[1:])]


def read(vectors: DataFrame, whole: bool = True) -> DataFrame:
    """``vec_id`` and ``key``, and if ``whole`` also ``size`` and ``vector`` (its bytes); unusable
    vectors have no key."""
    kind = kind_of(vectors)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = packed(batch.column(1), kind)
            keys = [None if x is None else hashlib.md5(x).digest() for x in data]
            columns = {"vec_id": batch.column(0), "key": pa.array(keys, pa.binary())}
            if whole:
                sizes = [0 if x is None else len(x) // width for x in data]
                columns["size"] = pa.array(sizes, pa.int32())
                columns["vector"] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kept = F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>")
    schema = "vec_id long, key binary" + ", size int, vector binary" * whole
    return vectors.select("vec_id", kept.alias("embedding")).mapInArrow(run, schema)


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms, in double precision."""
    wide = vectors.astype(np.float64, copy=False)
    norm = np.sqrt(np.einsum("ij,ij->i", wide, wide))
    with np.errstate(invalid="ignore", divide="ignore"):
        return wide / norm[:, None], norm


def narrow_units(data: list[bytes], size: int, kind: str) -> np.ndarray:
    """Unit vectors in single precision, of packed ones."""
    return units(np.frombuffer(b"".join(data), kind).reshape(-1, size))[0].astype(np.float32)


def pivots_of(distinct: DataFrame, n: int, longest: int, kind: str) -> dict[int, np.ndarray]:
    """Unit vectors of each size: those of the least hashes among all."""
    most = min(PIVOTS, n // PIVOT_ROWS, PIVOT_BYTES // (4 * longest))
    rows = distinct.orderBy("id").limit(most).select("size", "vector").collect() if most else []
    by_size: dict[int, list[bytes]] = {}
    for size, vector in rows:
        by_size.setdefault(size, []).append(bytes(vector))
    return {size: narrow_units(data, size, kind) for size, data in by_size.items()}


def celled(distinct: DataFrame, pivots: dict[int, np.ndarray], kind: str) -> DataFrame:
    """Rows with ``cell``, the nearest pivot, and ``near``, the cosine with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                cell, near = np.zeros(len(part), np.int32), np.zeros(len(part), np.float32)
                if size in pivots:
                    unit = narrow_units(part.column("vector").to_pylist(), size, kind)
                    for i in range(0, len(unit), 512):
                        dots = unit[i : i + 512] @ pivots[size].T
                        cell[i : i + 512] = dots.argmax(1)
                        near[i : i + 512] = dots.max(1)
                columns = [*part.columns, pa.array(cell), pa.array(near)]
                names = [*part.schema.names, "cell", "near"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "key binary, least long, weight long, size int, vector binary, id long"
    return distinct.mapInArrow(run, f"{schema}, cell int, near float")


def chunks(rows: DataFrame, n: int, longest: int, kind: str) -> DataFrame:
    """A row for each chunk of vectors of one size, in the order of their cells."""
    most, width = PART_ROWS, np.dtype(kind).itemsize

    def limit(size: int) -> int:
        return max(1, min(most, PART_BYTES // (width * size)))

    # Parts are sampled ranges; a quarter less than a chunk leaves few that need a second one.
    parts = max(-(-4 * n // (3 * limit(longest))), min(SPREAD, -(-n // LEAST_ROWS)), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size, held = TaskContext.get().partitionId(), 0, 0, []

        def out() -> pa.RecordBatch:
            data = (b"".join(x[c] for x in held) for c in range(1, 5))
            values = [(part << 32) + made, (part + made) % 2, size, *data]
            arrays = [pa.array([x], field.type) for x, field in zip(values, CHUNK)]
            return pa.RecordBatch.from_arrays(arrays, schema=CHUNK)

        for batch in batches:
            sizes = batch.column(0).to_numpy()
            cuts = (np.flatnonzero(np.diff(sizes)) + 1).tolist()
            for i, j in zip([0, *cuts], [*cuts, len(sizes)]):
                while i < j:
                    full = sum(x[0] for x in held)
                    if held and (size != sizes[i] or full >= limit(size)):
                        yield out()
                        made, held, full = made + 1, [], 0
                    size = int(sizes[i])
                    k = min(j, i + limit(size) - full)
                    some = batch.slice(i, k - i)
                    numbers = (some.column(c).to_numpy().tobytes() for c in range(1, 4))
                    held.append((k - i, *numbers, b"".join(some.column(4).to_pylist())))
                    i = k
        if held:
            yield out()

    by = ["size", "cell", "near", "id"]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    numbers = "chunk long, turn int, size int"
    data = "ids binary, weights binary, cells binary, vectors binary"
    columns = dealt.select("size", "id", "weight", "cell", "vector")
    return columns.mapInArrow(run, f"{numbers}, {data}")


CHUNK = pa.schema([
    ("chunk", pa.int64()), ("turn", pa.int32()), ("size", pa.int32()), ("ids", pa.binary()),
    ("weights", pa.binary()), ("cells", pa.binary()), ("vectors", pa.binary()),
])


class Chunk:
    """Rows of a chunk that are met by others: their links with them, counted and spanned."""

    def __init__(self, size: int, kind: str, cosine: float, ids, weights, cells, vectors):
        self.size, self.cosine, self.room = size, cosine, room(size)
        self.ids, self.weights = np.frombuffer(ids, np.int64), np.frombuffer(weights, np.int64)
        self.cells = np.frombuffer(cells, np.int32)
        self.vectors = np.frombuffer(vectors, kind).reshape(-1, size)
        unit, self.norm = units(self.vectors)
        self.unit = unit.astype(np.float32)
        turned, k = unit @ rotation(size), lead_width(size, cosine)
        if k < size:
            rest = turned[:, k - 1 :]
            turned[:, k - 1] = np.sqrt(np.einsum("ij,ij->i", rest, rest))
        self.lead = np.ascontiguousarray(turned[:, :k], np.float32)

    def settle(self) -> None:
        """Get ready to be met."""
        new = np.flatnonzero(np.diff(self.cells)) + 1
        cuts = [0, *new.tolist(), len(self.ids)]
        starts = [s for i, j in zip(cuts, cuts[1:]) for s in range(i, j, TILE_ROWS)]
        self.starts, self.ends = starts, [*starts[1:], len(self.ids)]
        sums = np.add.reduceat(self.unit, starts, axis=0, dtype=np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            self.centres = units(sums)[0].astype(np.float32)
        self.centres[~np.isfinite(self.centres).all(1)] = 0
        tile = np.repeat(np.arange(len(starts)), np.subtract(self.ends, starts))
        dots = np.einsum("ij,ij->i", self.unit, self.centres[tile])
        angle = np.arccos(np.clip(np.minimum.reduceat(dots, starts) - self.room, -1, 1))
        widest = np.minimum(np.pi, angle + np.arccos(self.cosine))
        self.floors = np.cos(widest) - 2 * self.room
        # A centre without a direction tells nothing: every visitor is compared.
        self.floors[~(self.centres.any(1) & np.isfinite(self.floors))] = -2
        self.count = np.zeros(len(self.ids), np.int64)
        self.forest = Forest(len(self.ids))

    def spans(self, other: Chunk) -> Iterator[tuple[int, int, np.ndarray | None]]:
        """Rows ``start`` to ``end`` of one or more tiles, and the visitors that may link with
        them (none named: all)."""
        open_ = None
        for t in range(0, len(self.starts), CENTRES):
            some = slice(t, t + CENTRES)
            reached = self.centres[some] @ other.unit.T >= self.floors[some, None]
            for start, end, reach in zip(self.starts[some], self.ends[some], reached):
                if np.count_nonzero(reach) > NEARLY_ALL * len(reach):
                    if open_ and open_[1] == start and end - open_[0] <= HOME_ROWS:
                        open_ = open_[0], end
                        continue
                    if open_:
                        yield *open_, None
                    open_ = start, end
                elif reach.any():
                    yield start, end, np.flatnonzero(reach)
        if open_:
            yield *open_, None

    def pairs(self, other: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs (row of ``other``, row); of the chunk with itself each pair once."""
        for start, end, rows in self.spans(other):
            lead = other.lead if rows is None else other.lead[rows]
            for i in range(0, len(lead), BLOCK_ROWS):
                bound = self.lead[start:end] @ lead[i : i + BLOCK_ROWS].T
                hit = np.flatnonzero(bound >= self.cosine - self.room)
                if not len(hit):
                    continue
                h, v = np.divmod(hit, bound.shape[1])
                h, v = h + start, v + i if rows is None else rows[v + i]
                if other is self:
                    h, v = h[h < v], v[h < v]
                for k in range(0, len(v), 1 << 14):
                    p, q = v[k : k + (1 << 14)], h[k : k + (1 << 14)]
                    close = self.close(other, p, q)
                    if close.any():
                        yield p[close], q[close]

    def close(self, other: Chunk, v: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Which of these pairs link."""
        near = np.einsum("ij,ij->i", other.unit[v], self.unit[h])
        found = near >= self.cosine + self.room
        unsure = np.flatnonzero(~found & (near >= self.cosine - self.room))
        if len(unsure):
            p, q = v[unsure], h[unsure]
            a, b = other.vectors[p].astype(np.float64), self.vectors[q].astype(np.float64)
            dot = np.einsum("ij,ij->i", a, b)
            found[unsure] = dot / (other.norm[p] * self.norm[q]) >= self.cosine
        return found

    def within(self) -> None:
        for v, h in self.pairs(self):
            np.add.at(self.count, v, self.weights[h])
            np.add.at(self.count, h, self.weights[v])
            self.forest.union(v, h)

    def visit(self, other: Chunk) -> tuple:
        """Of each visitor with links: its id, their number, and one linked row."""
        count, first = np.zeros(len(other.ids), np.int64), np.full(len(other.ids), -1)
        for v, h in self.pairs(other):
            np.add.at(count, v, self.weights[h])
            np.add.at(self.count, h, other.weights[v])
            new = first[v] < 0
            first[v[new]] = h[new]
            self.forest.union(first[v], h)
        hit = first >= 0
        return other.ids[hit], count[hit], self.ids[first[hit]]

    def result(self) -> tuple:
        root = self.forest.roots(np.arange(len(self.ids)))
        some = (self.count > 0) | (root != np.arange(len(self.ids)))
        return self.ids[some], self.count[some], self.ids[root[some]]


def linked(table: DataFrame, cosine: float, kind: str) -> DataFrame:
    """``a``, how many vectors it links with in some chunks, and ``b``, one of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, n, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, n, b)], ["a", "n", "b"])

        def chunk(batch: pa.RecordBatch, row: int, first: int) -> Chunk:
            size, *data = (batch.column(first + c)[row].as_py() for c in range(2, 7))
            return Chunk(size, kind, cosine, *data)

        name, home, known = None, None, {}
        for batch in batches:
            numbers, others = batch.column(0).to_pylist(), batch.column(7).to_pylist()
            for row, (mine, its) in enumerate(zip(numbers, others)):
                if name != mine:
                    if home:
                        yield out(*home.result())
                    name, home = mine, chunk(batch, row, 0)
                    home.settle()
                if mine == its:
                    home.within()
                else:
                    visitor = known.pop(its, None) or chunk(batch, row, 7)
                    known[its] = visitor
                    if len(known) > KEPT:
                        del known[next(iter(known))]
                    yield out(*home.visit(visitor))
        if home:
            yield out(*home.result())

    # The product of the table with itself reads it again for each part: nothing is shuffled. Of
    # two chunks one visits the other; turns deal the visits out evenly.
    mine, its = (
        table.select([F.col(c).alias(f"{c}_{side}") for c in table.columns]) for side in "ab"
    )
    before, alike = F.col("chunk_a") < F.col("chunk_b"), F.col("turn_a") == F.col("turn_b")
    meets = (F.col("chunk_a") == F.col("chunk_b")) | (before == alike)
    met = mine.join(its.hint("shuffle_replicate_nl"), (F.col("size_a") == F.col("size_b")) & meets)
    return met.mapInArrow(run, "a long, n long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = LEAST_COSINE) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors within the cosine) and ``component_id``."""
    held, kind = Written(vectors.sparkSession, "embeddings"), kind_of(vectors)
    distinct = held.table(
        read(vectors).where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("vec_id").alias("least"), F.count("*").alias("weight"),
            F.any_value("size").alias("size"), F.any_value("vector").alias("vector"),
        )
        .withColumn("id", F.xxhash64("key"))
    )
    held.release()
    known = distinct.agg(F.count("*").alias("n"), F.max("size").alias("longest")).first()
    n, longest = known.n, known.longest or 1
    placed = held.table(celled(distinct, pivots_of(distinct, n, longest, kind), kind))
    held.drop(distinct)
    table = held.table(chunks(placed, n, longest, kind))
    held.release()
    found = held.table(linked(table, cosine, kind))
    held.drop(table)
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    stars = components(found.select("a", "b"), held)
    named = held.table(
        placed.join(counts, F.col("id") == F.col("a"), "left")
        .join(stars, F.col("id") == F.col("node"), "left")
        .select(
            "key", "least", F.coalesce("component", "id").alias("group"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    held.drop(placed, found)
    least = held.table(named.groupBy("group").agg(F.min("least").alias("component_id")))
    classes = held.table(named.join(least, "group").select("key", "n_links", "component_id"))
    held.drop(named, least)
    alone = F.coalesce("component_id", "vec_id")
    return read(vectors, whole=False).join(classes, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), alone.alias("component_id")
    )
