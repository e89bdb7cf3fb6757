"""The corpus pipeline, stage by stage and as a whole."""

from __future__ import annotations

from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pytest
import samples
from pyspark.sql import functions as F
from test_dedup import by_hand
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tocsin.llm import lines, mixing, simhash
from tocsin.llm.common import documents

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_operators_are_registered():
    names = set(contract.queries())
    for number in range(1, 14):
        assert any(n.startswith(f"op{number}_") for n in names)
    assert "pipeline" in names
    assert set(contract.oracle_sql()) <= names


def test_toxic_documents_go(spark):
    docs = documents(spark, FOLDER)
    kept = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert kept.columns == COLUMNS
    scores = contract.queries()["op2_toxicity"](spark, FOLDER).collect()
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores if not r.predicted}


def test_one_document_of_each_group_stays(spark):
    docs = samples.messy(spark)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    groups = simhash.near_duplicates(docs)
    assert kept.count() == groups.select("group").distinct().count()
    again = simhash.near_duplicates(kept).groupBy("group").count()
    assert again.filter("count > 1").count() == 0
    least = {r.component_id for r in groups.collect()}
    assert {r.doc_id for r in kept.collect()} >= least - {None}


def test_lines_go_and_documents_stay(spark):
    docs = samples.messy(spark)
    kept = corpus_pipeline.drop_boilerplate(spark, docs, FOLDER)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    expected = lines.drop_boilerplate(docs).select("doc_id", "text")
    assert Counter(map(tuple, kept.select("doc_id", "text").collect())) == Counter(
        map(tuple, expected.collect())
    )
    wrong = kept.filter("text IS NOT NULL AND n_chars <> length(text)")
    assert wrong.count() == 0


def test_own_columns_of_documents_stay(spark):
    docs = samples.messy(spark).drop("n_chars").withColumns(
        {"_removed": F.lit("mine"), "slots": F.lit(1), "_slot": F.lit(2), "_times": F.lit(3)}
    )
    for stage in (
        corpus_pipeline.drop_boilerplate, corpus_pipeline.drop_near_duplicates,
        corpus_pipeline.mix_sources,
    ):
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        assert {(r._removed, r.slots, r._slot, r._times) for r in kept.collect()} == {("mine", 1, 2, 3)}


def test_mix_is_in_the_order_of_its_slots(spark):
    docs = documents(spark, FOLDER)
    mixed = [r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, FOLDER).collect()]
    first = {r.doc_id: r.first_slot for r in mixing.taken(docs).collect()}
    seen, slots = set(), []
    for doc_id in mixed:
        if doc_id not in seen and first[doc_id] is not None:
            slots.append(first[doc_id])
        seen.add(doc_id)
    assert slots == sorted(slots) and len(slots) > 500


def test_mixing_repeats_and_drops(spark):
    docs = samples.messy(spark)
    kept = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    times = Counter((r.doc_id, r.source) for r in kept.collect())
    sums: dict = {}
    for r in mixing.taken(docs).collect():
        key = sums.setdefault((r.doc_id, r.source, r["size"]), [0, 0])
        key[0] += r.taken
        key[1] += 1
    expected = Counter()
    for (doc_id, source, size), (taken, n) in sums.items():
        each = 1 if size == 0 else int(taken / (size * n) + 0.5)
        expected[doc_id, source] += each * n
    assert times == +expected
    assert max(times.values()) <= 6


@pytest.mark.parametrize("stage", range(1, len(corpus_pipeline.STAGES)))
def test_stages_take_empty_tables(spark, stage):
    name, function = corpus_pipeline.STAGES[stage]
    assert function(spark, samples.empty(spark), FOLDER).collect() == []


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert len(corpus_pipeline.STAGES) == 5
    ids = {r.doc_id for r in found}
    known = {r.doc_id for r in documents(spark, FOLDER).select("doc_id").collect()}
    assert 0.5 * len(known) < len(ids) < len(known) and ids <= known
    assert all(len(r.ids_sha256) == 64 and r.n_tokens >= 0 for r in found)
    # A document has the same ids however often it stands in the mix.
    assert len({(r.doc_id, r.ids_sha256) for r in found}) == len(ids)
    assert max(Counter(r.doc_id for r in found).values()) <= 3


def without_boilerplate(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text, source) with the lines gone that too many pages of the source share."""
    pages = {(source, text or "") for _, text, source in rows}
    totals, holding = Counter(), Counter()
    for source, text in pages:
        totals[source] += 1
        for line in {x for x in text.split("\n") if x.split()}:
            holding[source, line] += 1
    gone = {
        (s, x) for (s, x), n in holding.items()
        if n >= lines.LEAST_PAGES and n > lines.BOILERPLATE_RATIO * totals[s]
    }
    return [
        (d, None if t is None else "\n".join(x for x in t.split("\n") if (s, x) not in gone), s)
        for d, t, s in rows
    ]


def test_run_equals_brute_force(spark):
    """Every row of the whole run, with each stage done by plain means."""
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in documents(spark, folder).select("doc_id", "text", "source").collect()]
    scores = contract.queries()["op2_toxicity"](spark, folder).collect()
    fine = {r.doc_id for r in scores if r.score < corpus_pipeline.TOXIC_AT}
    rows = without_boilerplate([r for r in rows if r[0] in fine])
    near = by_hand([r[:2] for r in rows])
    first = {group for _, _, group in near}
    rows = [r for r in rows if r[0] in first]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    taken = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall()
    times = {d: 1 if size == 0 else int(n / size + 0.5) for d, size, n in taken}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[
            doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            sha256(decoded.encode()).hexdigest(),
        ] += times[doc_id]
    found = corpus_pipeline.run(spark, folder).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )
    assert Counter(map(tuple, found.collect())) == +expected
    assert len(rows) < 200 and max(times.values()) > 1


def test_near_duplicates_of_the_pipeline_are_the_operators(spark):
    docs = documents(spark, FOLDER).select("doc_id", "text")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    found = contract.queries()["op1_simhash"](spark, FOLDER)
    stays = found.filter(F.col("doc_id") == F.col("component_id"))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in stays.collect()}
