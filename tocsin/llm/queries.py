"""The operators of this package as queries over the test tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.llm import (
    bpe, embedding_dedup, factoring, licences, lines, mixing, quality, resampling, simhash,
    spelling, suffix_dedup, token_files, toxicity,
)
from tocsin.llm.common import documents
from tocsin.sources.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BYTE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"
END_ID = 2


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder)).select(
        "doc_id", simhash.hex_digits("print").alias("fingerprint"), "component_id"
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def held_out() -> Column:
    """A third of the documents, by id, whose labels are not learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def toxicity_model(docs: DataFrame, labelled: DataFrame) -> toxicity.ToxicityModel:
    learnt = labelled.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", "text")
    others = texts.where(~held_out()).join(learnt, "doc_id", "left_anti")
    return toxicity.fit(texts.join(learnt, "doc_id"), others)


TOXIC_AT = 0.7


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity_model(docs, labels(spark, folder))
    return docs.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        model.score("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= TOXIC_AT).cast("int"))


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(documents(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot"
    )


ORACLE["op3_mixing"] = mixing.SQL


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicated(documents(spark, folder), texts=False)


@query
def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return licences.scanned(docs, licences.fit(docs)).select(
        "doc_id", F.array_join("licences", ";").alias("licences"),
        F.size(F.array_distinct("spans.paragraph")).alias("n_paragraphs"),
    )


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs).withColumnRenamed("_removed", "n_removed")


ORACLE["op6_line_dedup"] = lines.SQL


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(
        documents(spark, folder), path, public_tokenizers.path(BYTE_VOCABULARY), END_ID
    )
    return token_files.read_token_files(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(documents(spark, folder))


@query
def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return embedding_dedup.near_duplicates(vectors).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


@query
def op10_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(
        documents(spark, folder), public_tokenizers.path(WORD_VOCABULARY), digests=True
    )


#: One in so many occurrences of a run, by document and run, loses a code point.
MISSPELT = 31


def misspelt(doc_id: Column, run: Column) -> Column:
    """A run as the document spells it."""
    name = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run)
    h = F.crc32(name.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.left(run, at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % MISSPELT == 0, shorter).otherwise(run)


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling.runs(documents(spark, folder))
    words = runs.select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    return spelling.grouped(spelling.vocabulary(words))


ORACLE["op11_spelling_variants"] = spelling.SQL


@query
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    return resampling.resampled(documents(spark, folder), target)


ORACLE["op12_importance_resampling"] = resampling.SQL


@query
def op13_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return factoring.deduplicated(documents(spark, folder), texts=False)


ORACLE["op13_passage_dedup"] = factoring.SQL
