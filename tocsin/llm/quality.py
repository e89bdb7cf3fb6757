"""Quality rules: figures of each text, and lines that too many documents of a host share.

Each text is read once. It leaves its figures and the hashes of its normalised lines (lower case,
single spaces); only those are counted and joined. A line is over the limit if more distinct
documents of the host hold it than a share of all its documents, and than a least number. Such
lines are taken out, and a document that keeps too few of its words is rejected.

Documents of a host that are equal to the last byte count as one: a copy is no second document.

Defined results: null and empty texts have no words and fail the base rules; a null source is a
host of its own; rows with equal text and source get equal results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.llm.bpe import Table
from tocsin.llm.common import Written, slices
from tocsin.llm.lines import host_key

LEAST_WORDS, MOST_REPEATED = 50, 50
#: Limits of a line, and the share of its words that a document must keep.
LINE_SHARE, LINE_DOCUMENTS, LEAST_KEPT = 0.1, 10, 0.5
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
WORDS_HELD = 800_000

SCHEMA = (
    "doc_id long, host string, page binary, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<line: binary, words: long>>"
)


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    if len(words) < 4:
        return 0
    most = int(words.max()) + 1
    pair = words[:-2] * most + words[1:-1]
    if most >= 1 << 21:  # three numbers would not fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, window, count = np.unique(
        pair * most + words[2:], return_inverse=True, return_counts=True
    )
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(again) + shift] |= again
    return int(covered.sum())


def figures(text: str, numbers: Table) -> tuple:
    data = text.encode()
    words = data.split()
    raw = [x for x in data.split(b"\n") if x.strip(BLANKS)]
    lines: dict[bytes, int] = {}
    for line in text.lower().encode().split(b"\n"):
        if parts := line.split():
            key = xxhash.xxh3_128_digest(b" ".join(parts))
            lines[key] = lines.get(key, 0) + len(parts)
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, BLANKS))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(raw) - len(set(raw)),
        repeated_words(numbers.numbers(words)),
        [{"line": k, "words": n} for k, n in lines.items()],
    )


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """The figures of each text and its normalised lines, each with the words it holds in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Table()
        lines = pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())]))
        names = [part.split()[0] for part in SCHEMA.split(", ", 8)]
        for batch in batches:
            for part in slices(batch, 2):
                rows = []
                for text in part.column(2).to_pylist():
                    if len(numbers) > WORDS_HELD:
                        numbers = Table()
                    rows.append(figures(text or "", numbers))
                page = [hashlib.md5((t or "").encode()).digest() for t in part.column(2).to_pylist()]
                found = [*zip(*rows)]
                columns = [pa.array(x, pa.int64()) for x in found[:5]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(page, pa.binary()),
                        *columns, pa.array(found[5], lines),
                    ],
                    names,
                )

    rows = docs.select("doc_id", host_key(host).alias("host"), "text")
    return rows.mapInArrow(run, SCHEMA)


def judged(
    docs: DataFrame,
    host: str = "source",
    share: float = LINE_SHARE,
    least: int = LINE_DOCUMENTS,
    least_kept: float = LEAST_KEPT,
) -> DataFrame:
    """Figures of every row with ``lost_words`` (in lines over the limit), ``base_failed`` and
    ``kept``."""
    held = Written(docs.sparkSession, "quality")
    rows = held.table(measured(docs, host))
    pages = held.table(
        rows.groupBy("host", "page").agg(F.any_value("lines").alias("lines"))
    )
    totals = held.table(pages.groupBy("host").agg(F.count("*").alias("documents")))
    lines = pages.select("host", "page", F.inline("lines"))
    counts = held.table(
        lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > least)
    )
    over = held.table(
        counts.join(totals, "host")
        .where(F.col("n") > share * F.col("documents"))
        .select("host", "line")
    )
    hit = held.table(lines.join(over, ["host", "line"]).select("host", "page", "words"))
    lost = held.table(hit.groupBy("host", "page").agg(F.sum("words").alias("lost_words")))
    words = F.col("n_words")
    return (
        rows.drop("lines")
        .join(lost, ["host", "page"], "left")
        .withColumn("lost_words", F.coalesce("lost_words", F.lit(0)))
        .withColumn(
            "base_failed",
            (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words),
        )
        .withColumn(
            "kept", ~F.col("base_failed") & (words - F.col("lost_words") >= least_kept * words)
        )
        .drop("host", "page")
    )
