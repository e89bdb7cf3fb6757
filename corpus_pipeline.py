"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixing, encoding.

Each stage takes the documents that the one before it kept, works on all of them, and returns a
table; ``run`` writes it to the shared folder and hands the reread table on. All stages but the
last return the columns of ``documents``.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns are treated as the
operators' docstrings say. A rejected document goes; a document that no stage rejects stays, but
for copies: of each group of near duplicates the row with the smallest doc_id stays. Mixing repeats
or drops documents to meet the sources' targets: a document appears as often as the mix takes it,
to the nearest whole number, and one without words appears once.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.llm import bpe, lines, mixing, simhash
from tocsin.llm.common import Written, documents, text_or_empty
from tocsin.llm.queries import TOXIC_AT, WORD_VOCABULARY, labels, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of two thirds of
    the documents; scores use the text alone."""
    model = toxicity_model(docs, labels(spark, sf_dir))
    return docs.where(model.score("text") < TOXIC_AT)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that too many pages of a source share; ``n_chars`` follows."""
    # The operator adds a column; one of the same name that the documents bring stays theirs.
    own = {c: f"{c}_of_documents" for c in docs.columns if c.startswith("_removed")}
    kept = lines.drop_boilerplate(docs.withColumnsRenamed(own)).drop("_removed")
    kept = kept.withColumnsRenamed({v: k for k, v in own.items()})
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the row with the group's smallest doc_id.

    Where a doc_id names several rows of a group, the one with the smallest hash of its text stays,
    and any one of those that are equal in that too. Rows go through the operator under id and hash
    together, so the one that stays is found without a second look at the fingerprints.
    """
    held = Written(spark, "pipeline")
    key = F.xxhash64(text_or_empty())
    name = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", key.alias("key"))
    found = simhash.near_duplicates(docs.select(name.alias("doc_id"), "text"))
    kept = held.table(
        found.select("component_id.doc_id", "component_id.key").distinct()
        .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    )
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_of"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_key"))
    return rows.join(kept, same).dropDuplicates(["_id", "_key"]).select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the slots that take them.

    The first copy stands where the mix first goes through the document, the next one where it does
    so again. Documents without words come last.
    """
    held = Written(spark, "pipeline")
    taken = mixing.taken(docs)
    key = ["doc_id", "source", "size"]
    passes = [F.min(F.get("slots", F.lit(i))).alias(f"_{i}") for i in range(mixing.MOST_TIMES)]
    grouped = taken.groupBy(*key).agg(
        F.sum("taken").alias("taken"), F.count("*").alias("n"), *passes
    )
    times = held.table(
        grouped.select(
            *[F.col(c).alias(f"_{c}") for c in key],
            F.when(F.col("size") == 0, 1)
            .otherwise(F.round(F.col("taken") / (F.col("size") * F.col("n"))))
            .cast("int")
            .alias("_times"),
            F.array(*[f"_{i}" for i in range(mixing.MOST_TIMES)]).alias("_slots"),
        )
    )
    rows = docs.select(F.struct("*").alias("_row"), mixing.word_count("text").alias("_words"))
    on = (
        F.col("_row.doc_id").eqNullSafe(F.col("_doc_id"))
        & F.col("_row.source").eqNullSafe(F.col("_source"))
        & (F.col("_words") == F.col("_size"))
    )
    copies = rows.join(times, on).select(
        "_row", "_slots", F.posexplode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_copy", "_")
    )
    order = [F.asc_nulls_last("_slot"), F.asc("_row.doc_id")]
    placed = copies.select("_row", F.get("_slots", F.col("_copy")).alias("_slot"))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document with digests of them and of the text that they decode to."""
    return bpe.encoded(docs, public_tokenizers.path(WORD_VOCABULARY), digests=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Neither the classifier nor fingerprint links within components are expressible in plain SQL;
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    held = Written(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        after = held.table(stage(spark, docs, sf_dir))
        if number:
            held.drop(docs)
        docs = after
    return docs
