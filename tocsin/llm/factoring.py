"""Word passages that stand in earlier documents, by relative Lempel-Ziv parsing.

A word goes if it lies in a window of 20 words whose sequence also starts earlier: in a document
with a smaller doc_id, or before it in the same one. The text is parsed into factors, each the copy
of a stretch of an earlier text, against reference blocks; a factor of 20 words or more is a
duplicate span.

1. Stretches. Of each window the five-word piece with the smallest hash is its anchor, so equal
   windows have equal anchors. Consecutive windows with one anchor are a *stretch*. A factor that is
   long enough to count can only come from a stretch with the same anchor, so anchors say which
   reference blocks a document has to be parsed against. Anchors that stand once in all documents
   end here; they are counted in an aggregate.
2. Own block. The words of the other stretches are taken from their documents. Each task parses its
   stretches against its own block first: one that equals an earlier one whole is a factor.
3. Reference blocks. What is left meets by anchor, in order. Each stretch is parsed greedily against
   the index of its block: the first window that the index knows starts a factor, which grows as far
   as the reference agrees. At a factor's end the windows across the boundary are looked up one by
   one, as a factor may start in another one's end. Windows the index does not know become part of
   the reference.
4. Spans are gathered by document, united and cut out.

A stretch whose anchor very many documents hold is taken apart into its windows, which meet by
their own hash: equal ones become one row in each task, and different ones go to different blocks,
so no block grows with the number of documents. All comparisons are of the words themselves.

Defined results: null and empty texts have no words; a text of fewer than 20 words stays whole; a
null doc_id counts as larger than any other; rows with equal doc_id and text are one document and
get the same result; rows with equal doc_id and other texts are in the order of a hash of the text;
very long texts are parsed whole; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.bpe import Table
from tocsin.llm.common import Written, byte_values, mix64, slices, text_or_empty

WINDOW, PIECE = 20, 5
PIECES = WINDOW - PIECE + 1  # pieces in a window
#: Times an anchor may stand before its stretches are taken apart into windows.
CROWD = 2_000
#: Bytes of text handled at once, bytes of stretches a task holds, words whose hashes it keeps.
SLICE_BYTES, HELD_BYTES, WORDS_HELD = 2 << 20, 16 << 20, 400_000
NO_ID = (1 << 63) - 1
U64 = np.uint64
FACTORS = np.random.default_rng(71).integers(1, 1 << 63, PIECE, dtype=np.uint64) | U64(1)

ANCHOR = "anchor long, doc long, key long, start int, words int"
SPAN = "doc long, key long, start int, stop int"
#: ``block`` null: a span that its task has settled; otherwise a stretch on its way to a block.
STRETCH = "block long, doc long, key long, start int, stop int, words binary"


def identity() -> list[Column]:
    """What tells documents apart and orders them."""
    return [
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text_or_empty()).alias("key"),
    ]


# --- stretches ------------------------------------------------------------------------------


class Hashes:
    """A hash of each word, computed once for each distinct one."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers, self.known = Table(), np.zeros(0, U64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > WORDS_HELD:
            self.clear()
        found = self.numbers.numbers(words)
        if len(self.numbers) > len(self.known):
            fresh = [*self.numbers][len(self.known) :]
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), U64, len(fresh))
            self.known = np.concatenate((self.known, hashes))
        return self.known[found]


def anchors_of_windows(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the hash and the place of its smallest piece, the first of equal ones."""
    count = len(hashes) - PIECE + 1
    value = np.zeros(count, U64)
    for i, factor in enumerate(FACTORS):
        value += mix64(hashes[i : i + count]) * factor
    value, place, width = mix64(value), np.arange(count), 1
    while width < PIECES:
        step = min(width, PIECES - width)
        left, right = value[:-step], value[step:]
        later = right < left
        value, place = np.where(later, right, left), np.where(later, place[step:], place[:-step])
        width += step
    return value, place


def stretches(texts: list[bytes], hashes: Hashes) -> tuple[np.ndarray, ...]:
    """Anchor, text number, first word and number of words of each stretch of some texts."""
    split = [text.split() for text in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    if sizes.sum() < WINDOW:
        return (np.zeros(0, np.int64),) * 4
    value, place = anchors_of_windows(hashes.of([w for words in split for w in words]))
    start = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(value)]
    at = np.flatnonzero(np.arange(len(value)) + WINDOW <= (start + sizes)[owner])
    if not len(at):
        return (np.zeros(0, np.int64),) * 4
    # Windows of two texts never share an anchor, as a piece lies within its window.
    new = np.flatnonzero(np.append(True, place[at][1:] != place[at][:-1]))
    length = np.diff(np.append(new, len(at)))
    first = at[new]
    number = owner[first]
    return value[first].view(np.int64), number, first - start[number], length + WINDOW - 1


def anchored(docs: DataFrame) -> DataFrame:
    """The stretches of all documents, without their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                anchor, number, start, words = stretches([*byte_values(part.column(2))], hashes)
                row = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor), part.column(0).take(row), part.column(1).take(row),
                        pa.array(start, pa.int32()), pa.array(words, pa.int32()),
                    ],
                    ["anchor", "doc", "key", "start", "words"],
                )

    return docs.select(*identity(), text_or_empty().alias("text")).mapInArrow(run, ANCHOR)


def repeated(found: DataFrame, held: Written, crowd: int) -> DataFrame:
    """For each document its stretches whose anchor stands more than once."""
    shared = held.table(
        found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        .select("anchor", (F.col("n") > crowd).alias("apart"))
    )
    stretch = F.struct("start", "words", "anchor", "apart")
    return held.table(
        found.join(shared, "anchor").groupBy("doc", "key").agg(
            F.collect_set(stretch).alias("stretches")
        )
    )


# --- parsing --------------------------------------------------------------------------------


class OwnBlock:
    """The stretches of a task: the first of equal ones goes on, the others are factors."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.first, self.spans, self.held = {}, [], 0

    def add(self, block: int, words: bytes, place: tuple[int, int, int], size: int) -> None:
        """``place``: document, key and first word."""
        known = self.first.get((block, words))
        if known is None:
            self.held += len(words) + 200
        elif known == place:
            return
        else:
            self.held += 100
            known, place = max(known, place), min(known, place)
            self.spans.append((*known, known[2] + size))
        self.first[block, words] = place

    def rows(self) -> pa.RecordBatch:
        """What goes on and what is settled."""
        size = [words.count(b" ") + 1 for _, words in self.first]
        places, spans = [*self.first.values()], self.spans
        columns = [
            [b for b, _ in self.first] + [None] * len(spans),
            *[[p[i] for p in places] + [s[i] for s in spans] for i in range(3)],
            [p[2] + n for p, n in zip(places, size)] + [s[3] for s in spans],
            [w for _, w in self.first] + [None] * len(spans),
        ]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            ["block", "doc", "key", "start", "stop", "words"],
        )


def taken(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The words of the stretches that are asked for, each task's parsed against its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OwnBlock()
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                doc, key = part.column(0).to_pylist(), part.column(1).to_pylist()
                for i, text in enumerate(byte_values(part.column(2))):
                    words = text.split()
                    for s in part.column(3)[i].as_py():
                        start, stop, block = s["start"], s["start"] + s["words"], s["anchor"]
                        if not s["apart"]:
                            own.add(block, b" ".join(words[start:stop]), (doc[i], key[i], start),
                                    stop - start)
                            continue
                        for at in range(start, stop - WINDOW + 1):
                            window = b" ".join(words[at : at + WINDOW])
                            block = xxhash.xxh3_64_intdigest(window) - (1 << 63)
                            own.add(block, window, (doc[i], key[i], at), WINDOW)
                        if own.held > HELD_BYTES:
                            yield own.rows()
                    if own.held > HELD_BYTES:
                        yield own.rows()
        yield own.rows()

    rows = docs.select(*identity(), text_or_empty().alias("text"))
    return rows.join(asked, ["doc", "key"]).select("doc", "key", "text", "stretches").mapInArrow(
        run, STRETCH
    )


class Reference:
    """The index of a block: every window of the reference, with where it stands."""

    def __init__(self):
        self.windows: dict[bytes, tuple[list[bytes], int, tuple[int, int, int]]] = {}

    def factors(
        self, words: list[bytes], place: tuple[int, int, int]
    ) -> Iterator[tuple[int, int]]:
        """First and last word of each factor of a stretch; its other windows join the reference."""
        at, size = 0, len(words)
        while at + WINDOW <= size:
            window = b" ".join(words[at : at + WINDOW])
            own = (*place[:2], place[2] + at)
            known = self.windows.get(window)
            if known is None:
                self.windows[window] = words, at, own
                at += 1
                continue
            source, begin, origin = known
            if origin == own:  # the same document again
                at += 1
                continue
            end, other = at + WINDOW, begin + WINDOW
            while end < size and other < len(source) and words[end] == source[other]:
                end, other = end + 1, other + 1
            yield at, end
            at = end - WINDOW + 1  # the first window across the boundary


def parsed(rows: DataFrame) -> DataFrame:
    """The spans of stretches that meet by block, in order within each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference, current = Reference(), None
        for batch in batches:
            spans = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for block, doc, key, start, words in zip(*columns):
                if block != current:
                    reference, current = Reference(), block
                for i, j in reference.factors(words.split(b" "), (doc, key, start)):
                    spans.append((doc, key, start + i, start + j))
            found = [*zip(*spans)] or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(found, kinds)],
                ["doc", "key", "start", "stop"],
            )

    ordered = rows.select("block", "doc", "key", "start", "words").repartition("block")
    return ordered.sortWithinPartitions("block", "doc", "key", "start").mapInArrow(run, SPAN)


def duplicate_spans(docs: DataFrame, held: Written, crowd: int = CROWD) -> DataFrame:
    """The spans of each document that stand earlier: ``doc``, ``key``, ``start``, ``stop``."""
    asked = repeated(anchored(docs), held, crowd)
    held.release()
    rows = held.table(taken(docs, asked))
    settled = rows.where("block IS NULL").select("doc", "key", "start", "stop")
    found = held.table(parsed(rows.where("block IS NOT NULL")).unionByName(settled))
    held.drop(asked, rows)
    held.release()
    return found


# --- cutting --------------------------------------------------------------------------------


def kept_words(words: list[bytes], spans: np.ndarray) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


def cut(docs: DataFrame, spans: DataFrame, texts: bool) -> DataFrame:
    """The documents without their ``spans``, one row of them for each document that has any."""
    kept = "kept string" if texts else "kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                n_words, n_removed, result = [], [], []
                spans = part.column(2)
                for i, text in enumerate(byte_values(part.column(1))):
                    words = left = text.split()
                    if spans[i].is_valid:
                        flat = spans[i].values
                        pair = np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], 1)
                        left = kept_words(words, pair)
                    joined = b" ".join(left)
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    result.append(
                        joined.decode() if texts else hashlib.sha256(joined).hexdigest()
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()), pa.array(result, pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", kept.split()[0]],
                )

    rows = docs.select("doc_id", *identity(), text_or_empty().alias("text"))
    joined = rows.join(spans, ["doc", "key"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {kept}")


def deduplicated(docs: DataFrame, texts: bool = True, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words that stay, of every row.

    Without ``texts``, ``kept_sha256`` stands in place of ``kept``.
    """
    held = Written(docs.sparkSession, "factoring")
    spans = held.table(
        duplicate_spans(docs, held, crowd).groupBy("doc", "key").agg(
            F.collect_set(F.struct("start", "stop")).alias("spans")
        )
    )
    return cut(docs, spans, texts)


#: The rows of the query in another SQL engine, window by window.
SQL = r"""
WITH docs AS (
    SELECT doc_id, sha256(coalesce(text, '')) AS key,
        regexp_extract_all(coalesce(text, ''), '[^\x{20}\x{09}-\x{0D}]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, key, i, array_to_string(words[i : i + 19], ' ') AS w
    FROM (SELECT *, unnest(range(1, len(words) - 18)) AS i FROM (SELECT DISTINCT * FROM docs))
), gone AS (
    SELECT doc_id, key, unnest(range(i, i + 20)) AS i FROM (
        SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS LAST, key, i) AS n
        FROM windows)
    WHERE n > 1
), removed AS (
    SELECT doc_id, key, list(DISTINCT i) AS places FROM gone GROUP BY doc_id, key
)
SELECT docs.doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
    sha256(array_to_string(
        CASE WHEN places IS NULL THEN words ELSE list_transform(
            list_filter(list_zip(words, range(1, len(words) + 1)),
                lambda p: NOT list_contains(places, p[2])), lambda p: p[1]) END, ' ')) AS kept_sha256
FROM docs LEFT JOIN removed
    ON docs.key = removed.key AND docs.doc_id IS NOT DISTINCT FROM removed.doc_id
"""
