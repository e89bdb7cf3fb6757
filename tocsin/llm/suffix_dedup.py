"""Exact substring dedup with suffix arrays built by linear grouping.

A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller
doc_id. To find such strings without one suffix array of everything:

1. Anchors. In each window of 50 bytes the 20-byte piece with the smallest hash is an anchor. Equal
   windows have equal anchors at the same place, so all equal windows meet among the contexts (30
   bytes before the anchor, 30 after it) of one anchor hash. Each task first settles what repeats
   among its own documents: of equal contexts only the first document's goes on.
2. Meeting. Anchor hashes are dealt out in packed buckets. A context that also stands in a smaller
   document goes as a whole. An anchor with one context is settled thereby; where contexts differ,
   the bytes decide.
3. Suffix arrays. The differing contexts of an anchor become one text, whose suffix array by linear
   grouping (``grouping.py``) puts equal windows side by side; a window goes if a smaller document
   holds it.
4. The removed ranges of a document are united and cut out.

Anchors with very many differing contexts (edges of a passage that many documents share) meet
window by window instead, in an aggregation that combines before its shuffle; nothing is capped.

Defined results: a null text is empty; a text below 50 bytes stays whole; a null doc_id counts as
larger than any other; rows with equal doc_id do not remove each other's bytes; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.llm.common import Written, byte_values, mix64, slices, text_or_empty
from tocsin.llm.grouping import suffix_arrays

SPAN, PIECE = 50, 20
SIDE = SPAN - PIECE  # bytes of context on either side of an anchor
CONTEXT = SIDE + SPAN
#: Bytes of text that fill a packed message of a task, for each bucket, and hashed at once (few, as
#: the arrays at work then stay in the processor's cache).
TASK_BYTES, BUCKET_BYTES, SLICE_BYTES = 64 << 20, 8 << 20, 1 << 16
#: Contexts in one suffix array, bytes of the suffix arrays built in step, and contexts of an
#: anchor from which windows meet one by one (a task holds fewer, at less than 1 KB each).
TEXT_CONTEXTS, STEP_BYTES, CROWD = 32, 1 << 19, 1 << 16
#: Contexts after which a task settles what it holds.
ROWS_HELD = 40_000
#: Contexts that are handed on together, and that are taken apart into windows together.
ROWS_SENT, WINDOWED = 8_192, 1_024
NO_ID = (1 << 63) - 1
NONE = np.uint64((1 << 64) - 1)
U64 = np.uint64


def odd_numbers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, count, dtype=np.uint64) | U64(1)


BYTE_VALUES, FACTORS, BASE = odd_numbers(256, 41), odd_numbers(8, 42), int(odd_numbers(1, 43)[0])


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``PIECE`` bytes from each position."""
    value, width, base, powers = BYTE_VALUES[data], 1, BASE, {}
    while width <= PIECE:
        powers[width] = value
        value = value[:-width] * U64(base) + value[width:]
        base, width = base * base % (1 << 64), width * 2
    n, at, found = len(data) - PIECE + 1, 0, None
    for width in sorted(powers, reverse=True):
        if PIECE - at >= width:
            part = powers[width][at : at + n]
            found = part if found is None else found * U64(pow(BASE, width, 1 << 64)) + part
            at += width
    return found


def slid(pick, values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    span = 1
    while 2 * span <= width:
        values, span = pick(values[:-span], values[span:]), 2 * span
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, document number and place of all anchors of some texts."""
    blank = bytes(SPAN)
    joined = np.frombuffer(blank + blank.join(texts) + blank, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = SPAN + np.cumsum(sizes + SPAN) - sizes - SPAN
    piece = piece_hashes(joined)
    inside = np.zeros(len(joined) + 1, np.int64)  # pieces that lie in a text
    fits = sizes >= PIECE
    np.add.at(inside, starts[fits], 1)
    np.add.at(inside, (starts + sizes - PIECE + 1)[fits], -1)
    inside = np.cumsum(inside)[: len(piece)] > 0
    order = np.where(inside, mix64(piece) >> U64(1), NONE)
    least = slid(np.minimum, order, SIDE + 1)
    whole = np.zeros(len(joined) + 1, np.int64)  # windows that lie in a text
    fits = sizes >= SPAN
    np.add.at(whole, starts[fits], 1)
    np.add.at(whole, (starts + sizes - SPAN + 1)[fits], -1)
    least = np.where(np.cumsum(whole)[: len(least)] > 0, least, U64(0))
    edge = np.zeros(SIDE, U64)
    best = slid(np.maximum, np.concatenate((edge, least, edge)), SIDE + 1)
    at = np.flatnonzero(inside & (best == order))
    number = np.searchsorted(starts, at, "right") - 1
    place = at - starts[number]
    context = np.zeros(len(at), U64)
    for factor, shift in zip(FACTORS, (-SIDE, -PIECE, 0, PIECE, SIDE)):
        context = context * FACTORS[7] + mix64(piece[at + shift] * factor)
    # Blanks around a text must not look like zero bytes within another.
    before = np.minimum(place, SIDE)
    after = np.minimum(sizes[number] - place - PIECE, SIDE)
    context = mix64(context + (before * (SIDE + 1) + after).astype(U64) * FACTORS[6])
    return order[at], context, number, place


def heads(*columns: np.ndarray) -> np.ndarray:
    """Whether each row of sorted columns differs from the row before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def united(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as disjoint ranges in order."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate(([True], start[1:] > stop[:-1]))
    return start[new], stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)]


def unpacked_ranges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


#: Rows that tell of ranges to remove and of contexts to look at. ``bucket`` >= 0: packed anchors.
MESSAGE = "bucket int, doc long, key long, kind int, data binary"
ANCHORS, REMOVED, LOOK, LOOK_CROWDED = range(4)
#: The columns of a packed message. Of an anchor: part of its hash, its context's hash, its place,
#: and which text it is in; of a text: its document, its key, its size.
ENTRY, NAME = ("<u4", "<u8", "<u4", "<u4"), ("<i8", "<i8", "<u4")
FIELDS = ["bucket", "doc", "key", "kind", "data"]


def binary(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The rows of ``data`` from each cut to the next one, as bytes."""
    width = data.itemsize * data.shape[1]
    offsets = (np.append(cuts, len(data)) * width).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(cuts), buffers)


def by_document(
    owner: np.ndarray, doc: np.ndarray, key: np.ndarray, kind: int, first: np.ndarray,
    second: np.ndarray,
) -> pa.RecordBatch:
    """A message to each owner (a number into ``doc`` and ``key``) with its pairs of numbers; all in
    the order of the owners."""
    cuts = np.flatnonzero(heads(owner))
    whom, n = owner[cuts], len(cuts)
    pairs = np.stack([first, second], 1).astype("<i8", copy=False)
    columns = [
        pa.array(np.full(n, -1, np.int32)), pa.array(doc[whom]), pa.array(key[whom]),
        pa.array(np.full(n, kind, np.int32)), binary(pairs, cuts),
    ]
    return pa.RecordBatch.from_arrays(columns, FIELDS)


def removed(
    owner: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray, key: np.ndarray
) -> pa.RecordBatch:
    """Tell the owners which ranges of theirs go, united. The ranges are in the order of owner and
    start, and of one owner's, none ends before an earlier one."""
    new = heads(owner)
    new[1:] |= start[1:] > stop[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(owner))[: len(at)] - 1
    return by_document(owner[at], doc, key, REMOVED, start[at], stop[last])


def removed_anywhere(
    doc: np.ndarray, key: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> pa.RecordBatch:
    """The same for ranges in any order."""
    order = np.lexsort((start, key, doc))
    doc, key, start, stop = (x[order] for x in (doc, key, start, stop))
    new = heads(doc, key)
    owner = np.cumsum(new) - 1
    beyond = stop.max(initial=0) + 1  # an owner's stops are all before the next one's
    stop = np.maximum.accumulate(stop + owner * beyond) - owner * beyond
    return removed(owner, start, stop, doc[new], key[new])


def removed_contexts(
    row: np.ndarray, place: np.ndarray, doc: np.ndarray, key: np.ndarray, size: np.ndarray
) -> pa.RecordBatch:
    """Tell the texts that the contexts of these anchors of theirs go as a whole."""
    order = np.lexsort((place, row))
    row, place = row[order], place[order].astype(np.int64)
    stop = np.minimum(place + SPAN, size[row].astype(np.int64))
    return removed(row, np.maximum(place - SIDE, 0), stop, doc, key)


def first_documents(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each entry the smallest document that has its context."""
    if not len(doc):
        return doc
    order = np.argsort(context)
    new = heads(context[order])
    other = anchor[order]
    if (~new[1:] & (other[1:] != other[:-1])).any():  # equal hashes of contexts of two anchors
        order = np.lexsort((anchor, context))
        new = heads(context[order], anchor[order])
    at = np.flatnonzero(new)
    first = np.empty_like(doc)
    sizes = np.diff(np.append(at, len(doc)))
    first[order] = np.repeat(np.minimum.reduceat(doc[order], at), sizes)
    return first


def columns_of(*columns: np.ndarray) -> bytes:
    """Each column byte by byte, from the lowest on, without the high bytes that are zero in all
    rows: columns of small or alike numbers become short or compress."""
    out = [len(columns[0]).to_bytes(8, "little")]
    for c in map(np.ascontiguousarray, columns):
        planes = c.view(np.uint8).reshape(len(c), c.itemsize)
        most = int(c.view(f"<u{c.itemsize}").max(initial=0))
        used = -(-most.bit_length() // 8)
        out += [bytes([used]), planes[:, :used].T.tobytes()]
    return b"".join(out)


def rows_of(data: memoryview, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], memoryview]:
    """The columns at the start of the data, and the rest."""
    count, at, found = int.from_bytes(data[:8], "little"), 8, []
    for kind in map(np.dtype, kinds):
        used = data[at]
        planes = np.zeros((count, kind.itemsize), np.uint8)
        low = np.frombuffer(data, np.uint8, count * used, at + 1)
        planes[:, :used] = low.reshape(used, count).T
        found.append(planes.view(kind).reshape(count))
        at += 1 + count * used
    return found, data[at:]


class Packer:
    """Anchors of one task's documents, packed by bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.parts, self.names, self.rows, self.held = [], [], 0, 0

    def add(self, docs: np.ndarray, keys: np.ndarray, texts: list[bytes]) -> None:
        anchor, context, number, place = anchors(texts)
        row = (number + self.rows).astype(np.uint32)
        self.parts.append((anchor, context, place.astype(np.uint32), row))
        sizes = np.fromiter(map(len, texts), np.uint32, len(texts))
        self.names.append((docs.astype("<i8"), keys.astype("<i8"), sizes))
        self.rows += len(texts)
        self.held += sum(map(len, texts))

    def messages(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        anchor, context, place, row = map(np.concatenate, zip(*self.parts))
        doc, key, size = map(np.concatenate, zip(*self.names))
        self.clear()
        later = doc[row] > first_documents(anchor, context, doc[row])
        yield removed_contexts(row[later], place[later], doc, key, size)
        bucket = (anchor % U64(self.buckets)).astype(np.min_scalar_type(self.buckets))
        order = np.argsort(bucket, kind="stable")
        order = order[~later[order]]
        bucket = bucket[order]
        cuts = np.append(np.flatnonzero(heads(bucket)), len(order))
        for i, j in zip(cuts[:-1], cuts[1:]):
            some = order[i:j]
            texts, again = np.unique(row[some], return_inverse=True)
            part = (anchor[some] // U64(self.buckets)).astype("<u4")
            data = columns_of(doc[texts], key[texts], size[texts])
            data += columns_of(part, context[some], place[some], again.astype("<u4"))
            one = (np.full(1, bucket[i], np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64))
            columns = [*map(pa.array, one), pa.array([ANCHORS], pa.int32()), pa.array([data])]
            yield pa.RecordBatch.from_arrays(columns, FIELDS)


def document_key() -> Column:
    """Tells texts with equal doc_id apart."""
    return F.hash(text_or_empty()).cast("long")


def document_id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(NO_ID))


def packed(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                docs, keys = (part.column(i).to_numpy() for i in (0, 1))
                packer.add(docs, keys, list(byte_values(part.column(2))))
                if packer.held >= TASK_BYTES:
                    yield from packer.messages()
        yield from packer.messages()

    rows = docs.select(document_id().alias("doc"), document_key().alias("key"), text_or_empty())
    return rows.mapInArrow(run, MESSAGE)


def met(bucket: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """What one bucket's anchors settle, and the contexts whose bytes must be looked at."""
    doc, key, size, anchor, context, place, row = map(np.concatenate, zip(*parts))
    later = doc[row] > first_documents(anchor, context, doc[row])
    yield removed_contexts(row[later], place[later], doc, key, size)
    anchor, context, place, row = (x[~later] for x in (anchor, context, place, row))
    if not len(row):
        return
    order = np.argsort(anchor)
    start = np.flatnonzero(heads(anchor[order]))
    count = np.diff(np.append(start, len(order)))
    of = doc[row[order]]
    shared = np.minimum.reduceat(of, start) != np.maximum.reduceat(of, start)
    crowd = shared & (count > CROWD)
    for g in np.flatnonzero(crowd):
        several = context[order[start[g] : start[g] + count[g]]]
        crowd[g] = len(np.unique(several)) > CROWD
    for kind, some in ((LOOK, shared & ~crowd), (LOOK_CROWDED, crowd)):
        asked = order[np.repeat(some, count)]
        asked.sort()
        asked = asked[np.argsort(row[asked], kind="stable")]
        whole = anchor[asked].astype(np.int64) | bucket << 32
        yield by_document(row[asked], doc, key, kind, place[asked].astype(np.int64), whole)


def meeting(packed_rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, texts = None, [], 0
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            other = np.flatnonzero(buckets < 0)
            if len(other):
                yield batch.take(pa.array(other))
            # One message at a time: the batch holds all of the task's.
            for i in np.flatnonzero(buckets >= 0).tolist():
                if buckets[i] != number and parts:
                    yield from met(number, parts)
                    parts, texts = [], 0
                number = int(buckets[i])
                names, rest = rows_of(memoryview(batch.column(4)[i].as_buffer()), NAME)
                entries, _ = rows_of(rest, ENTRY)
                entries[3] += texts
                texts += len(names[0])
                parts.append((*names, *entries))
        if parts:
            yield from met(number, parts)

    # What tasks settled by themselves passes through, spread by document.
    deal = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.xxhash64("doc"))
    return packed_rows.repartition(deal).sortWithinPartitions("bucket").mapInArrow(run, MESSAGE)


# --- bytes of contexts ------------------------------------------------------------------------


@F.arrow_udf(T.BinaryType())
def squeezed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    pack = zstandard.ZstdCompressor(level=1)
    for array in texts:
        yield pa.array([pack.compress(x) for x in byte_values(array)], pa.binary())


def with_texts(docs: DataFrame, told: DataFrame, how: str) -> DataFrame:
    """Every row's doc, key and compressed text with the messages to its document (equal ones, as
    equal rows get, once)."""
    lists = told.groupBy("doc", "key").agg(F.collect_set("data").alias("data"))
    rows = docs.select(
        F.col("doc_id"), document_id().alias("doc"), document_key().alias("key"),
        squeezed(text_or_empty()).alias("text"),
    )
    return rows.join(lists, ["doc", "key"], how)


def fetched(docs: DataFrame, asked: DataFrame, then=None, schema: str = "") -> DataFrame:
    """The bytes around the asked places: ``anchor``, the document, ``place`` and ``context``,
    from ``low`` to ``high`` within the text; or what ``then`` makes of them in the same worker."""

    names = ["anchor", "doc", "key", "place", "context", "low", "high"]

    def sent(found: list[tuple]) -> pa.RecordBatch:
        *numbers, contexts = map(np.concatenate, zip(*found))
        columns = list(map(pa.array, numbers))
        columns.insert(4, binary(contexts, np.arange(len(contexts))))
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, found, held = zstandard.ZstdDecompressor(), [], 0
        for batch in batches:
            rows = zip(*(batch.column(i) for i in range(4)))
            for doc, key, squeezed_text, lists in rows:
                text = unpack.decompress(squeezed_text.as_py())
                both = np.concatenate([np.frombuffer(x, "<i8") for x in lists.as_py()])
                place, anchor = both.reshape(-1, 2).T
                padded = np.frombuffer(bytes(SIDE) + text + bytes(SIDE), np.uint8)
                for at in range(0, len(place), ROWS_SENT):
                    some = place[at : at + ROWS_SENT]
                    low = np.maximum(SIDE - some, 0).astype(np.int32)
                    high = np.minimum(SIDE + len(text) - some, CONTEXT).astype(np.int32)
                    whose = (np.full(len(some), x.as_py()) for x in (doc, key))
                    contexts = sliding_window_view(padded, CONTEXT)[some]
                    found.append((anchor[at : at + ROWS_SENT], *whose, some, low, high, contexts))
                    held += len(some)
                    if held >= ROWS_SENT:
                        yield sent(found)
                        found, held = [], 0
        if found:
            yield sent(found)

    rows = with_texts(docs, asked, "inner")
    rows = rows.select("doc", "key", "text", "data")
    if then:
        return rows.mapInArrow(lambda batches: then(run(batches)), schema)
    schema = "anchor long, doc long, key long, place long, context binary, low int, high int"
    return rows.mapInArrow(run, schema)


# --- suffix arrays ----------------------------------------------------------------------------


def runs(mask: int) -> Iterator[tuple[int, int]]:
    """The runs of set bits: first and last bit of each."""
    at = 0
    while mask:
        zeros = (mask & -mask).bit_length() - 1
        mask >>= zeros
        ones = (~mask & (mask + 1)).bit_length() - 1
        yield at + zeros, at + zeros + ones - 1
        mask >>= ones
        at += zeros + ones


class Looker:
    """Windows of contexts that smaller documents hold; texts are gathered and sorted in step."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.rows, self.gone, self.jobs, self.held = [], [], [], 0

    def add(self, rows: list[tuple]) -> None:
        """The contexts of one anchor: (doc, key, place, context, low, high).

        The windows of the first half all hold the bytes from the middle window's start to the
        first window's end, those of the second half likewise. A context that shares neither with
        another one shares no window.
        """
        middle = SIDE // 2
        cores = [(r[3][middle:SPAN], r[3][SIDE : middle + 1 + SPAN]) for r in rows]
        seen: dict[tuple, int] = {}
        for pair in cores:
            for half in enumerate(pair):
                seen[half] = seen.get(half, 0) + 1
        rows = [
            r for r, pair in zip(rows, cores) if any(seen[half] > 1 for half in enumerate(pair))
        ]
        base = len(self.rows)
        self.rows += rows
        self.gone += [0] * len(rows)
        self.split(list(range(base, base + len(rows))), 0, SIDE)

    def split(self, members: list[int], first: int, last: int) -> None:
        """Look at the windows ``first`` to ``last`` of contexts that share the bytes which all
        these windows hold. Many different contexts are halved by their windows: equal windows
        then still share the bytes that their half has in common."""
        kinds: dict[tuple, list[int]] = {}
        docs = set()
        for i in members:
            doc, _, _, context, low, high = self.rows[i]
            low, high = max(low, first), min(high, last + SPAN)
            if high - low >= SPAN:
                kinds.setdefault((context[low:high], low), []).append(i)
                docs.add(doc)
        if len(docs) < 2:
            return
        for (text, low), of in kinds.items():  # of equal contexts the first document's stays
            if len(of) > 1:
                least = min(self.rows[i][0] for i in of)
                every = ((1 << (len(text) - SPAN + 1)) - 1) << low
                for i in of:
                    if self.rows[i][0] > least:
                        self.gone[i] |= every
        if len(kinds) == 1:
            return
        if len(kinds) <= TEXT_CONTEXTS or first == last:
            self.jobs.append(kinds)
            self.held += sum(len(text) + 1 for text, _ in kinds)
            return
        middle = (first + last) // 2
        for a, b in ((first, middle), (middle + 1, last)):
            cores: dict[bytes, list[int]] = {}
            for i in members:
                cores.setdefault(self.rows[i][3][b : a + SPAN], []).append(i)
            for some in cores.values():
                if len(some) > 1:
                    self.split(some, a, b)

    def settle(self) -> Iterator[pa.RecordBatch]:
        """Build the suffix arrays and tell documents what they lose."""
        jobs = sorted(self.jobs, key=lambda kinds: sum(len(t) for t, _ in kinds))
        at = 0
        while at < len(jobs):
            stop, held = at, 0
            while stop < len(jobs) and (stop == at or held < STEP_BYTES):
                held += sum(len(t) + 1 for t, _ in jobs[stop])
                stop += 1
            self.sort(jobs[at:stop])
            at = stop
        found = [
            (doc, key, place - SIDE + i, place - SIDE + j + SPAN)
            for (doc, key, place, *_), gone in zip(self.rows, self.gone) if gone
            for i, j in runs(gone)
        ]
        self.clear()
        yield removed_anywhere(*np.array(found, np.int64).reshape(-1, 4).T)

    def sort(self, jobs: list[dict]) -> None:
        texts, owner, low, sizes = [], [], [], []
        for kinds in jobs:
            size = 0
            for (text, at), members in kinds.items():
                texts += [text, b"\0"]
                owner.append(members)
                low.append(at)
                size += len(text) + 1
            sizes.append(size)
        lengths = np.fromiter((len(t) for t in texts[::2]), np.int64, len(owner))
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(lengths + 1) - 1  # where each context's separator stands
        symbols = data.astype(np.int32) + 2
        symbols[ends] = 1
        sizes = np.array(sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        symbols[starts + sizes - 1] = 0
        ordered = suffix_arrays(symbols, starts, sizes)
        context = np.repeat(np.arange(len(owner), dtype=np.int32), lengths + 1)[ordered]
        whole = ordered + SPAN <= ends[context]
        ordered, context = ordered[whole], context[whole]
        if not len(ordered):
            return
        windows = sliding_window_view(data, SPAN)[ordered].view(f"V{SPAN}")[:, 0]
        job = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[ordered]
        new = heads(windows, job)
        begin = np.flatnonzero(new)
        docs = np.array([min(self.rows[i][0] for i in of) for of in owner], np.int64)
        least = np.minimum.reduceat(docs[context], begin)[np.cumsum(new) - 1]
        some = least < docs[context]
        context, ordered = context[some], ordered[some]
        offset = ordered - (ends[context] - lengths[context]) + np.array(low)[context]
        masks = np.zeros(len(owner), np.int64)
        np.bitwise_or.at(masks, context, np.int64(1) << offset)
        for c in np.flatnonzero(masks):
            for i in owner[c]:
                self.gone[i] |= int(masks[c])


def looked(rows: DataFrame) -> DataFrame:
    """Ranges to remove, from the suffix arrays of each anchor's contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looker, anchor, group = Looker(), None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != anchor:
                    if group:
                        looker.add(group)
                    anchor, group = row[0], []
                    if looker.held >= 4 * STEP_BYTES or len(looker.rows) >= ROWS_HELD:
                        yield from looker.settle()
                group.append(row[1:])
        if group:
            looker.add(group)
        yield from looker.settle()

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(run, MESSAGE)


def crowded(docs: DataFrame, asked: DataFrame, held: Written) -> DataFrame:
    """The same for anchors with very many contexts: each window meets its equals by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        parts = (b.slice(i, WINDOWED) for b in batches for i in range(0, b.num_rows, WINDOWED))
        for part in parts:
            out: list[tuple] = []
            for _, doc, key, place, context, low, high in zip(
                *(c.to_pylist() for c in part.columns)
            ):
                for o in range(low, high - SPAN + 1):
                    out.append((digest(context[o : o + SPAN]), doc, key, place - SIDE + o))
            window, doc, key, at = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(window, pa.binary()), *(pa.array(x, pa.int64()) for x in (doc, key, at))],
                ["window", "doc", "key", "at"],
            )

    schema = "window binary, doc long, key long, at long"
    windows = held.table(fetched(docs, asked, run, schema))
    least = held.table(
        windows.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .where("least < most").select("window", "least")
    )
    gone = windows.join(least, "window").where("doc > least").select("doc", "key", "at")
    gone = gone.repartition("doc", "key").sortWithinPartitions("doc", "key")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key, at = (c.to_numpy() for c in batch.columns)
            yield removed_anywhere(doc, key, at, at + SPAN)

    return gone.mapInArrow(pack, MESSAGE)


# --- the whole --------------------------------------------------------------------------------


def removals(docs: DataFrame, held: Written) -> DataFrame:
    """Messages to documents with the ranges that they lose."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    told = held.table(meeting(packed(docs, max(1, -(-size // BUCKET_BYTES)))))
    held.release()
    some = held.table(looked(fetched(docs, told.where(F.col("kind") == LOOK))))
    held.release()
    found = told.where(F.col("kind") == REMOVED).unionByName(some)
    crowd = told.where(F.col("kind") == LOOK_CROWDED)
    if not crowd.isEmpty():
        found = found.unionByName(held.table(crowded(docs, crowd, held)))
    return found


def deduplicated(docs: DataFrame, texts: bool = True) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256``
    and, with ``texts``, ``kept``, the bytes that stay."""
    held = Written(docs.sparkSession, "suffix-dedup")
    found = removals(docs, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                rows = []
                for squeezed_text, lists in zip(
                    part.column(1).to_pylist(), part.column(2).to_pylist()
                ):
                    text = unpack.decompress(squeezed_text)
                    each = [unpacked_ranges(x) for x in lists or ()]
                    start, stop = united(
                        *(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*each))
                    ) if each else (np.zeros(0, np.int64),) * 2
                    ends, begins = start.tolist() + [len(text)], [0, *stop.tolist()]
                    kept = b"".join(text[i:j] for i, j in zip(begins, ends))
                    digest = hashlib.sha256(kept).hexdigest()
                    rows.append((len(text), len(text) - len(kept), len(start), digest, kept))
                size, removed, spans, digest, kept = zip(*rows)
                numbers = [pa.array(x, pa.int64()) for x in (size, removed, spans)]
                columns = [part.column(0), *numbers, pa.array(digest)]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if texts:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    rows = with_texts(docs, found, "left").select("doc_id", "text", "data")
    return rows.mapInArrow(run, schema + (", kept binary" if texts else ""))
