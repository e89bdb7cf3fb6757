"""Token ids in binary files: each document compressed by itself with one shared dictionary.

A folder of token files holds

* ``dictionary``: a zstandard dictionary trained on serialized id arrays (empty where the sample
  is too small to train one),
* ``part-*.ids``: 8 magic bytes, the dictionary's SHA-256, then one zstandard frame per document,
* ``part-*.idx``: the same 40 bytes, then per document a record of ``doc_id``, a flag for a null
  ``doc_id``, the frame's offset and length, and the number of ids,
* ``manifest``: Parquet, one row per pair of files, in order. Files that a lost or repeated task
  left behind are in no manifest and never read.

One document is read with two small reads: its index record and its frame.

Defined results: a null or empty text has the end id alone; rows with a null ``doc_id`` come
first; rows with equal ``doc_id`` stand side by side in an order that follows from their texts, each
with a record of its own; very long texts are encoded whole; an empty table gives an empty manifest
and no rows; other columns are ignored. The dictionary is trained on a sample (``SAMPLE_DOCS``
documents, ``SAMPLE_BYTES`` of ids of each), which changes how small the files are and no id in them.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tocsin.llm.bpe import Table
from tocsin.llm.common import slices, text_or_empty

MAGIC = b"TOKIDS01"
RECORD = np.dtype(
    [("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")]
)
#: The dictionary is trained on about so many documents, of each at most so many bytes of ids.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 112_640
#: A data file is closed once it holds so many bytes.
FILE_BYTES = 64 << 20
WORDS_HELD = 800_000
#: White space beside a space: there a run of white space must be seen whole.
RUNS = re.compile(r" \s|\s ")
#: How the vocabulary writes a space at the start of a token, and new words encoded together.
SPACE, WORDS_TOGETHER = "\u0120", 2_000


def joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array, and how long each is."""
    length = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum())), length


class ByteBpe:
    """The library's vocabulary with a table of the ids of words met before.

    A token crosses no space that stands alone between two words, so each word, with the space
    before it, is given to the library once. New words go to it many in one text: there a word
    begins with the only token in it that begins with a space.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.marks = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.known = Table()
        vocab = self.library.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for token, i in vocab.items() if token.startswith(SPACE)]] = True

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, each behind a space, from one text of them, and how many each has."""
        [found] = self.ids([" " + " ".join(words)])
        found = np.array(found, np.int32)
        starts = np.flatnonzero(self.spaced[found])
        if len(starts) != len(words):  # an odd character among them: one by one
            return joined(self.ids([" " + w for w in words]))
        return found, np.diff(np.append(starts, len(found)))

    def learn(self) -> None:
        """Give the words that are new in the table their ids."""
        fresh = self.known.fresh()
        spaced = np.fromiter((bool(w) and isinstance(w, str) for w in fresh), bool, len(fresh))
        words = [w for w, s in zip(fresh, spaced) if s]
        others = [w[0] if isinstance(w, tuple) else " " for w, s in zip(fresh, spaced) if not s]
        parts = [
            self.together(words[at : at + WORDS_TOGETHER])
            for at in range(0, len(words), WORDS_TOGETHER)
        ]
        length = np.zeros(len(fresh), np.int64)
        found, count = joined(self.ids(others))
        length[~spaced] = count
        length[spaced] = np.concatenate([n for _, n in parts] or [count[:0]])
        flat = np.empty(length.sum(), np.int32)
        of_spaced = np.repeat(spaced, length)
        flat[~of_spaced] = found
        flat[of_spaced] = np.concatenate([x for x, _ in parts] or [found[:0]])
        self.known.add(flat, length)

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        if len(self.known) > WORDS_HELD:
            self.known = Table()
        odd = [bool(RUNS.search(text) or self.marks.search(text)) for text in texts]
        split = pc.split_pattern(
            pa.array([t for t, o in zip(texts, odd) if not o], pa.large_string()), " "
        )
        offsets, words = split.offsets.to_numpy(), split.values.dictionary_encode()
        number = self.known.numbers(words.dictionary.to_numpy(zero_copy_only=False))
        number = number[words.indices.to_numpy()]
        # The first word of a text has no space before it.
        first = split.values.take(pa.array(offsets[:-1])).to_pylist()
        number[offsets[:-1]] = self.known.numbers([(w,) for w in first])
        self.learn()
        flat, length = self.known.ids(number)
        cuts = np.append(0, np.cumsum(length))[offsets]
        plain = (flat[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
        whole = iter(self.ids([t for t, o in zip(texts, odd) if o]))
        last = np.array([end], "<u4")
        return [
            np.concatenate((np.array(next(whole) if o else next(plain), "<u4"), last)) for o in odd
        ]


_loaded: dict[str, ByteBpe] = {}


def vocabulary(path: str) -> ByteBpe:
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system for a path or address that all machines share.

    Spark's names for S3 (``s3a``, ``s3n``) are Arrow's ``s3``.
    """
    if "://" not in uri and uri.startswith("file:"):
        uri = uri.removeprefix("file:")
    uri = re.sub("^s3[an]://", "s3://", uri)
    return fs.FileSystem.from_uri(uri)


def read_bytes(uri: str) -> bytes:
    store, path = opened(uri)
    with store.open_input_file(path) as handle:
        return handle.read()


def write_bytes(uri: str, data: bytes) -> None:
    store, path = opened(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(path) as handle:
        handle.write(data)


def train_dictionary(docs: DataFrame, tokenizer: str, end: int) -> bytes:
    """A dictionary from a sample chosen by a hash of ``doc_id``, of bounded size."""
    count = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, count))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(tokenizer)
        for batch in batches:
            for part in slices(batch, 0):
                ids = bpe.encode([x or "" for x in part.column(0).to_pylist()], end)
                heads = [x.tobytes()[:SAMPLE_BYTES] for x in ids]
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary())], ["ids"])

    # A hot doc_id may bring more rows than the share asks for: the limit bounds the sample.
    rows = chosen.select("text").mapInArrow(run, "ids binary").limit(2 * SAMPLE_DOCS).collect()
    samples = [bytes(r.ids) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class _Writer:
    """One pair of files, filled by one task."""

    def __init__(self, folder: str, head: bytes):
        self.base = f"{folder}/part-{uuid.uuid4().hex}"
        store, path = opened(self.base + ".ids")
        self.out = store.open_output_stream(path)
        self.out.write(head)
        self.head, self.at, self.records, self.tokens = head, len(head), [], 0

    def add(self, doc_id: int | None, frame: bytes, n_tokens: int) -> None:
        self.out.write(frame)
        self.records.append((doc_id or 0, doc_id is None, self.at, len(frame), n_tokens))
        self.at += len(frame)
        self.tokens += n_tokens

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        write_bytes(self.base + ".idx", self.head + np.array(self.records, RECORD).tobytes())
        return self.base, len(self.records), self.tokens


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end: int) -> None:
    """Encode every text, append ``end``, and write token files in ascending ``doc_id`` order.

    Texts are range-partitioned before they are encoded, so ids are never shuffled.
    """
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    dictionary = train_dictionary(docs, tokenizer, end)
    write_bytes(f"{folder}/dictionary", dictionary)
    head = MAGIC + hashlib.sha256(dictionary).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        bpe = vocabulary(tokenizer)
        data = read_bytes(f"{folder}/dictionary")
        shared = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True, **shared)
        writer, closed = None, []
        for batch in batches:
            for run_of in slices(batch, 1):
                names = run_of.column(0).to_pylist()
                for name, ids in zip(names, bpe.encode(run_of.column(1).to_pylist(), end)):
                    writer = writer or _Writer(folder, head)
                    writer.add(name, pack.compress(ids.tobytes()), len(ids))
                    if writer.at >= FILE_BYTES:
                        closed.append(writer.close())
                        writer = None
        if writer:
            closed.append(writer.close())
        bases, counts, tokens = zip(*closed) if closed else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(closed), pa.int64()),
                pa.array(range(len(closed)), pa.int64()),
                pa.array([b.rpartition("/")[2] for b in bases], pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(tokens, pa.int64()),
            ],
            ["part", "seq", "file", "n_docs", "n_tokens"],
        )

    # Texts settle the order of rows with one id, so many of them may be dealt to several tasks.
    order = ("doc_id", "key", "text")
    keyed = docs.withColumn("key", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "key").sortWithinPartitions(*order).drop("key")
    schema = "part long, seq long, file string, n_docs long, n_tokens long"
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` of every document.

    The only step in one task is the running sum over the manifest, a row per data file.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.parquet(f"{folder}/manifest").withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = read_bytes(f"{folder}/dictionary")
        head = MAGIC + hashlib.sha256(data).digest()
        shared = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
        unpack = zstandard.ZstdDecompressor(**shared)
        for batch in batches:
            for file, start in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                index = read_bytes(f"{folder}/{file}.idx")
                store, path = opened(f"{folder}/{file}.ids")
                with store.open_input_file(path) as handle:
                    if not (index[: len(head)] == handle.read(len(head)) == head):
                        raise ValueError(f"{file} was written with another dictionary")
                    records = np.frombuffer(index[len(head):], RECORD)
                    starts = start + np.cumsum(records["n_tokens"]) - records["n_tokens"]
                    for i in range(0, len(records), 512):
                        rows = records[i : i + 512]
                        ids = [unpack.decompress(handle.read(int(n))) for n in rows["length"]]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(rows["doc_id"], mask=rows["null"].astype(bool)),
                                pa.array(starts[i : i + 512].astype(np.int64)),
                                pa.array(ids, pa.binary()),
                            ],
                            ["doc_id", "start", "ids"],
                        )

    # A number of partitions of its own: rows this small would else be merged into one task.
    spread = files.repartition(max(1, files.count()), "file").select("file", "start")
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def read_document(folder: str, file: str, row: int) -> np.ndarray:
    """The ids of one document: its index record, then its frame."""
    size = len(MAGIC) + 32
    store, path = opened(f"{folder}/{file}.idx")
    with store.open_input_file(path) as handle:
        handle.seek(size + row * RECORD.itemsize)
        record = np.frombuffer(handle.read(RECORD.itemsize), RECORD)[0]
    store, path = opened(f"{folder}/{file}.ids")
    with store.open_input_file(path) as handle:
        handle.seek(int(record["offset"]))
        frame = handle.read(int(record["length"]))
    data = read_bytes(f"{folder}/dictionary")
    shared = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
    return np.frombuffer(zstandard.ZstdDecompressor(**shared).decompress(frame), "<u4")
