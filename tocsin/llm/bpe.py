"""Byte-pair encoding by a pair occurrence index, and decoding.

Each distinct word of a block of texts is laid out once in one array of symbols. An index maps a
merge's rank to all positions at which its pair stands. Ranks are applied in ascending order, each
at all its positions at once, and only the lists of the pairs beside a merge are updated.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tocsin.llm.common import read_json, slices

#: Distinct words that one task holds encoded; beyond it the table starts anew. Bytes of text that
#: are encoded together.
WORDS_HELD, SLICE_BYTES = 200_000, 2 << 20

OUT = "doc_id long, ids binary, decoded string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others take the code points from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


BYTE_OF = {c: b for b, c in enumerate(byte_letters())}
#: White space for str.split(), but not for the vocabulary.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
NOT_SPACE = regex.compile(r"\S+")


class Table(dict):
    """Numbers for strings in the order in which they are met, and the ids of each."""

    def __init__(self):
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, key):
        number = self[key] = len(self)
        return number

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def fresh(self) -> list:
        """The strings that have a number and no ids yet."""
        return list(islice(self, len(self.starts) - 1, None))

    def add(self, flat: np.ndarray, length: np.ndarray) -> None:
        self.flat = np.concatenate((self.flat, flat.astype(np.int32)))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(length)))

    def ids(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a row of numbers one after the other, and how many each has."""
        length = self.starts[row + 1] - self.starts[row]
        ends = np.cumsum(length)
        shift = np.repeat(self.starts[row] - (ends - length), length)
        return self.flat[shift + np.arange(len(shift))], length


class WordBpe:
    """A byte-level BPE vocabulary with word ends, as the tokenizers library writes it."""

    def __init__(self, path: str):
        config = read_json(path)
        model = config["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + self.end] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.left, self.right = keys // self.size, keys % self.size
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        split = config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.library = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.pieces, self.chunks = Table(), Table()

    def chunked(self, text: str) -> list:
        """The text cut at white space, which no token crosses; a special token is a tuple."""
        cut = NOT_SPACE.findall if SEPARATORS.search(text) else str.split
        if "<|" not in text:
            return cut(self.normal(text))
        found: list = []
        for part in self.marks.split(text):
            if part in self.special:
                found.append((self.special[part],))
            else:
                found += cut(self.normal(part))
        return found

    def normal(self, text: str) -> str:
        """NFC, then each character in lower case by itself."""
        if text.isascii():
            text = text.lower()
        elif any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters newer than Python's tables: the library may know them.
            text = self.library.normalizer.normalize_str(text)
        else:
            # str.lower() has a form of sigma for word ends, which a character by itself has not.
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        return text

    def split(self, chunk: str) -> list[str]:
        """The words of a chunk."""
        if chunk.isascii() or not any(unicodedata.category(c) == "Cn" for c in chunk):
            return self.words.findall(chunk)
        cut = self.library.pre_tokenizer.pre_tokenize_str(chunk)
        return [bytes(map(BYTE_OF.__getitem__, word)).decode() for word, _ in cut]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.order[at], -1)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word's ids start."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        # One free place at each end, so that every position has neighbours to look at.
        sym = np.full(n + 2, -1, np.int64)
        sym[1:-1] = self.inner[raw]
        sym[ends] = self.final[raw[ends - 1]]
        after, before = np.arange(1, n + 3), np.arange(-1, n + 1)
        after[-1], before[0] = n + 1, 0
        last = np.zeros(n + 2, bool)  # no pair crosses a word's end
        last[[0, -1]] = True
        last[ends] = True
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.ranks(sym[at], sym[after[at]])
            some = rank >= 0
            at, rank = at[some], rank[some]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            heads = rank[np.concatenate(([0], cuts))].tolist()
            for r, part in zip(heads, np.split(at, cuts) if len(cuts) else [at]):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(part)

        note(np.flatnonzero(~last))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[rank], self.right[rank]
            at = at[(sym[at] == a) & ~last[at]]
            at = at[sym[after[at]] == b]
            if a == b and len(at) > 1:
                at = self.apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            sym[at], sym[gone] = self.made[rank], -1
            last[at] = last[gone]
            then = after[gone]
            after[at], before[then] = then, at
            first = before[at]
            note(np.unique(np.concatenate((first[~last[first]], at[~last[at]]))))
        kept = sym >= 0
        starts = np.zeros(len(words) + 1, np.int64)
        starts[1:] = np.cumsum(kept)[ends]
        return sym[kept].astype(np.int32), starts

    @staticmethod
    def apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of runs of overlapping pairs of one symbol, every other one from the left."""
        linked = np.concatenate(([False], after[at[:-1]] == at[1:]))
        run = np.cumsum(~linked) - 1
        heads = np.flatnonzero(~linked)
        return at[(np.arange(len(at)) - heads[run]) % 2 == 0]

    def learn(self) -> None:
        """Encode the chunks that were met since the last call: their new words all together."""
        fresh = self.chunks.fresh()
        counts, row = [], []
        for chunk in fresh:
            words = [chunk] if isinstance(chunk, tuple) else self.split(chunk)
            counts.append(len(words))
            row += words
        row = self.pieces.numbers(row)
        words = self.pieces.fresh()
        if words:
            flat, starts = self.merged([w.encode() if isinstance(w, str) else b"!" for w in words])
            for i, w in enumerate(words):
                if isinstance(w, tuple):  # a place of one id, filled with the special token's
                    flat[starts[i]] = w[0]
            self.pieces.add(flat, np.diff(starts))
        if fresh:
            flat, length = self.pieces.ids(row)
            ends = np.concatenate(([0], np.cumsum(length)))
            bounds = np.concatenate(([0], np.cumsum(np.array(counts, np.int64))))
            self.chunks.add(flat, np.diff(ends[bounds]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > WORDS_HELD:
            self.clear()
        rows = [self.chunks.numbers(self.chunked(text)) for text in texts]
        self.learn()
        return [self.chunks.ids(row)[0].astype("<u4") for row in rows]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens with a space between them: the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_loaded: dict[str, WordBpe] = {}


def vocabulary(path: str) -> WordBpe:
    """The vocabulary of a Python worker, read once."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encoded(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` of each text.

    ``path`` names the vocabulary on every machine. With ``digests`` the columns are instead
    ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, so that no ids leave the tasks.
    """
    schema = (
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else OUT
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                texts = [x or "" for x in part.column(1).to_pylist()]
                ids = bpe.encode(texts)
                plain = map(bpe.decode, ids)
                if digests:
                    columns = [
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in plain]),
                    ]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    columns = [
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        pa.array(list(plain), pa.string()),
                    ]
                    names = ["doc_id", "ids", "decoded"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)
        # The Python worker lives on and serves other steps; its memory is theirs then.
        bpe.clear()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
