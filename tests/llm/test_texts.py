"""Encoding, token files, line dedup, quality rules, mixing, licences and toxicity."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import samples
from compare import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tocsin.llm import bpe, licences, lines, mixing, quality, token_files, toxicity
from tocsin.llm.queries import BYTE_VOCABULARY, ORACLE, QUERIES, WORD_VOCABULARY
from tocsin.sources.workspace import fresh_path

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return samples.messy(spark).persist()


@pytest.fixture(scope="module")
def con(texts):
    """The messy table for the SQL engine."""
    con = duckdb.connect()
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    frame = texts.select(*columns).toArrow()
    con.register("documents", frame)
    return con


# --- BPE --------------------------------------------------------------------------------------


def test_bpe_equals_the_library(texts):
    path = public_tokenizers.path(WORD_VOCABULARY)
    library = Tokenizer.from_file(path)
    expected, plain = Counter(), Counter()
    for r in texts.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        data = np.array(ids, "<u4").tobytes()
        expected[r.doc_id, len(ids), hashlib.sha256(data).hexdigest(),
                 hashlib.sha256(decoded.encode()).hexdigest()] += 1
        plain[r.doc_id, data, decoded] += 1
    found = bpe.encoded(texts, path, digests=True).collect()
    assert Counter(map(tuple, found)) == expected
    assert Counter(
        (r.doc_id, bytes(r.ids), r.decoded) for r in bpe.encoded(texts, path).collect()
    ) == plain


def test_bpe_of_all_characters():
    path = public_tokenizers.path(WORD_VOCABULARY)
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    some = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    some = some[:0x3000] + some[0x3000::97]
    batch = [f"a{chr(c)}b {chr(c)}Σ{chr(c)}x1{chr(c)}" for c in some]
    expected = [e.ids for e in library.encode_batch(batch, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(batch)] == expected


def test_bpe_tables_start_anew(monkeypatch):
    path = public_tokenizers.path(WORD_VOCABULARY)
    own = bpe.WordBpe(path)
    before = [own.encode([t])[0].tolist() for t in ("one two", "three four", "one two")]
    monkeypatch.setattr(bpe, "WORDS_HELD", 1)
    assert [own.encode([t])[0].tolist() for t in ("one two", "three four", "one two")] == before


# --- token files ------------------------------------------------------------------------------


def test_token_files_round_trip(spark, texts, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 2000)
    path = public_tokenizers.path(BYTE_VOCABULARY)
    library = Tokenizer.from_file(path)
    folder = fresh_path(spark, "test-token-files")
    token_files.write_token_files(texts, folder, path, 2)
    found = token_files.read_token_files(spark, folder).collect()
    expected = Counter(
        (r.doc_id, np.array(
            library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
        for r in texts.collect()
    )
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order)
    manifest = spark.read.parquet(f"{folder}/manifest").orderBy("part", "seq").collect()
    assert len(manifest) > 3
    one = token_files.read_document(folder, manifest[1].file, 0)
    start = manifest[0].n_tokens
    assert one.tobytes() == next(bytes(r.ids) for r in found if r.start == start)


def test_token_files_under_any_partitioning(spark, monkeypatch):
    """Many rows of one id keep one order, whatever tasks they come from and go to."""
    monkeypatch.setattr(token_files, "FILE_BYTES", 500)
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.range(120).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("doc_id"),
        F.concat(F.lit("a text with number "), (F.col("id") * 37 % 80).cast("string")).alias("text"),
    )
    found = []
    for some in (docs.repartition(7), docs.coalesce(1)):
        folder = fresh_path(spark, "tokens")
        token_files.write_token_files(some, folder, path, 2)
        found.append(token_files.read_token_files(spark, folder).orderBy("start").collect())
    assert found[0] == found[1] and len(found[0]) == 120


def test_new_words_together_equal_the_library():
    bpe_ = token_files.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [
        "Hi there\nYou  two", "a b c", " lead", "trail ", "", " ", "x\ty z\x85w", "it's we'll 3rd", "é\xa0ö ü",
        "one\n\ntwo three", "<|endoftext|> mark", "tab\t end", "Ġ odd Ġword", "\u2028 line sep",
    ]
    expected = [x.ids + [2] for x in bpe_.library.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [x.tolist() for x in bpe_.encode(texts, 2)] == expected


def test_token_files_of_nothing(spark):
    folder = fresh_path(spark, "test-token-files")
    path = public_tokenizers.path(BYTE_VOCABULARY)
    token_files.write_token_files(samples.empty(spark), folder, path, 2)
    assert token_files.read_token_files(spark, folder).collect() == []


def test_token_files_of_a_table(spark):
    library = Tokenizer.from_file(public_tokenizers.path(BYTE_VOCABULARY))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    at, expected = 0, set()
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected.add((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert set(map(tuple, QUERIES["op7_token_files"](spark, SMALL).collect())) == expected


# --- lines and quality ------------------------------------------------------------------------


def test_line_dedup_equals_sql(texts, con):
    found = lines.drop_boilerplate(texts)
    assert found.columns == [*texts.columns, "_removed"]
    narrow = found.select("doc_id", "source", F.col("_removed").alias("n_removed"), "text")
    assert difference(narrow, con, lines.SQL) is None
    assert found.agg(F.sum("_removed")).first()[0] > 0


def test_line_dedup_of_nothing(spark):
    assert lines.drop_boilerplate(samples.empty(spark)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None


def judged_by_hand(rows: list[tuple]) -> Counter:
    pages, holders = defaultdict(set), defaultdict(set)
    for _, source, text in rows:
        pages[source].add(text or "")
        for line in (text or "").lower().split("\n"):
            if words := WORDS.findall(line):
                holders[source, " ".join(words)].add(text or "")
    found = []
    for doc_id, source, text in rows:
        text = text or ""
        words = WORDS.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {
            i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
            for k in range(3)
        }
        own = [x for x in text.split("\n") if WORDS.search(x)]
        lost = 0
        for line in own:
            held = len(holders[source, " ".join(WORDS.findall(line.lower()))])
            if held > quality.LINE_DOCUMENTS and held > quality.LINE_SHARE * len(pages[source]):
                lost += len(WORDS.findall(line))
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        found.append((
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(own) - len(set(own)), len(again), lost, failed,
            not failed and len(words) - lost >= 0.5 * len(words),
        ))
    return Counter(found)


@pytest.mark.parametrize("least", [10, 1])
def test_quality_equals_brute_force(texts, monkeypatch, least):
    monkeypatch.setattr(quality, "LINE_DOCUMENTS", least)
    found = quality.judged(texts, least=least).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "lost_words", "base_failed", "kept",
    )
    rows = [(r.doc_id, r.source, r.text) for r in texts.collect()]
    assert Counter(map(tuple, found.collect())) == judged_by_hand(rows)


def test_quality_of_a_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    found = QUERIES["op8_quality_rules"](spark, folder)
    assert Counter(map(tuple, found.collect())) == judged_by_hand(rows)
    assert quality.judged(samples.empty(spark)).collect() == []


def test_repeated_words_of_many_numbers():
    words = np.array([5, 1 << 40, 7, 9, 5, 1 << 40, 7], np.int64)
    words = np.unique(words, return_inverse=True)[1] + (1 << 21)
    assert quality.repeated_words(words) == 6


# --- mixing -----------------------------------------------------------------------------------


def test_mixing_equals_sql(texts, con):
    found = mixing.taken(texts).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot"
    )
    expected = con.execute(mixing.SQL).fetchall()
    # Equal rows share what their place gives, in either order.
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    for r in found.collect():
        assert r.taken <= 3 * r.size
    assert mixing.taken(samples.empty(texts.sparkSession)).collect() == []


def test_mixing_follows_its_points(texts):
    """What a source gives is what the points draw for it, and that is near its target."""
    spans, _, targets = mixing.mixed(texts, block=8)
    goal = {r.source: r for r in targets.collect()}
    rows = spans.collect()
    whole = sum(t.words for t in goal.values())
    drawn = Counter()
    for slot in range(-(-whole // 8)):
        u = slot * mixing.GOLDEN % 1
        drawn[next(s for s, t in goal.items() if t.words and t.lo <= float(u) < t.hi)] += 1
    by_source = Counter()
    for r in rows:
        by_source[r.source] += r.words
        assert 0 < r.words <= 8 and r["first"] + r.words <= r["size"]
    assert by_source == {
        s: min(8 * n, 3 * goal[s].source_size) for s, n in drawn.items() if goal[s].source_size
    }
    for source, t in goal.items():
        assert abs(by_source[source] - t.words) <= 8 * 4
    # Any run of slots holds about each source's share.
    order = [source for _, source in sorted({(r.slot, r.source) for r in rows}, key=lambda x: x[0])]
    for source, t in goal.items():
        if t.words > 200:
            half = order[: len(order) // 2].count(source) / (len(order) // 2)
            assert abs(half - t.words / whole) < 0.05


def test_mixing_many_sources(spark):
    """More sources than bins, one of them with a third of all words."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("a b c d "), 20).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 1500))
        .alias("source"),
    )
    found = mixing.taken(docs, block=4).groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken")
    ).collect()
    assert len(found) == 1001
    assert all(abs(r.taken - r.target) <= 4 * 5 for r in found)


# --- licences ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_templates_are_recognised(licence_model):
    for family, templates in licences.TEMPLATES.items():
        for text in templates:
            words = licences.words_of(text)
            assert licence_model.family(words)[0] == family, text
            assert licence_model.family(licences.words_of(text.upper()))[0] == family
    for text in ("the license of the software version", "licensed software public work is the"):
        assert licence_model.family(licences.words_of(text))[0] == licences.UNKNOWN


def test_licences_of_texts(spark, texts, licence_model):
    found = licences.scanned(texts, licence_model).collect()
    has = {r.doc_id: samples.LICENCE in (r.text or "").split("\n") for r in texts.collect()}
    assert len(found) == texts.count()
    for r in found:
        assert r.licences == (["Apache-2.0"] if has[r.doc_id] else [])
    by_id = {r.doc_id: r.text for r in texts.collect()}
    for r in found:
        for s in r.spans:
            assert by_id[r.doc_id][s.start : s.stop] == samples.LICENCE and s.p >= 0.5
    nothing = samples.empty(spark)
    assert licences.scanned(nothing, licences.fit(nothing)).collect() == []


def test_licences_of_a_table(spark):
    """Exactly the lines that are templates: the table holds no others."""
    folder = "/root/testdata/sf0.01"
    known = {t: f for f, of in licences.TEMPLATES.items() for t in of}
    expected = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        own = [known[x] for x in (r.text or "").split("\n") if x in known]
        expected[r.doc_id] = (";".join(sorted(set(own))), len(own))
    found = QUERIES["op5_licence_scan"](spark, folder).collect()
    assert {r.doc_id: (r.licences, r.n_paragraphs) for r in found} == expected
    assert sum(n for _, n in expected.values()) > 5


def test_licences_inside_longer_lines(spark, licence_model):
    """A notice is found wherever it stands: in a long line, in its midst, beside another."""
    rng = random.Random(3)
    around = [samples.prose(rng, n).replace("\n", " ").rstrip(".,! ") for n in (27, 400, 9)]
    bare = licences.TEMPLATES["Apache-2.0"][0].rstrip(".")
    expected, rows = {}, []
    for family, templates in licences.TEMPLATES.items():
        for template in templates:
            for text in (
                f"{around[0]}. {template} {around[1]}",
                f"{around[2]} {template.rstrip('.:')} {around[0]}",
                f"\u0130\n\u0130 {around[1]} {template.rstrip('.:')} {around[0]}",
            ):
                expected[len(rows)] = [family]
                rows.append((len(rows), text))
    expected[len(rows)] = ["Apache-2.0", "MIT"]
    both = f"{around[0]}, {bare}, {around[1]}, Released under the MIT License {around[0]}"
    rows += [(len(rows), both), (len(rows) + 1, around[1] + " the terms of the license")]
    expected[len(rows) - 1] = []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scanned(docs, licence_model).collect()}
    assert {k: r.licences for k, r in found.items()} == expected
    first = found[2].spans[-1]
    stands = licences.words_of(rows[2][1][first.start : first.stop])
    assert stands == licences.words_of(licences.TEMPLATES["AGPL-3.0"][0])
    assert first.paragraph == 1


GRANT = (
    "Redistribution and use in source and binary forms, with or without\n# modification, are "
    "permitted provided that the following conditions\n# are met:"
)


@pytest.mark.parametrize(
    "text, families",
    [
        ("Licensed under the Apache License,\nVersion 2.0.", ["Apache-2.0"]),
        ("Licensed under the Apache\nLicense, Version 2.0.", ["Apache-2.0"]),
        ("/*\n * Licensed under the Apache\n * License, Version 1.1.\n */", ["Apache-1.1"]),
        ("// This work is licensed under a Creative Commons\n// Attribution-NonCommercial 4.0 "
         "International\n// License.", ["CC-BY-NC"]),
        ("# under the terms of the GNU General Public License as published by\n# the Free "
         "Software Foundation, either version 2 of the License, or\n# any later version.",
         ["GPL-2.0"]),
        ("Licensed under the Apache License.", []),
        ("Licensed under the Apache License,\n\nVersion 2.0.", []),
        ("Copyright (c) 2015, Jane Doe. All rights reserved.\n\n# " + GRANT, ["BSD"]),
        ("# Copyright 2015 Jane Doe.\n# All rights reserved.", ["Proprietary"]),
        ("All rights reserved.\n\n" + GRANT, ["BSD", "Proprietary"]),
        ("# SPDX-License-Identifier: MIT", ["MIT"]),
        ("code\n// SPDX-License-Identifier: GPL-2.0-or-later\nmore", ["GPL-2.0"]),
        ("SPDX-License-Identifier: Nothing-1.0", []),
        ("Licensed under the MIT license.", ["MIT"]),
        ("This file is distributed under the terms of the ISC\nLicense.", ["ISC"]),
        ("Licensed under CC BY-ND 4.0.\nReleased under CC BY-NC-SA 4.0.",
         ["CC-BY-NC-SA", "CC-BY-ND"]),
        ("Released under the Unlicense.", ["Unlicense"]),
        ("This program and the accompanying materials are made\navailable under the terms of the "
         "Eclipse Public License 2.0", ["EPL-2.0"]),
    ],
)
def test_wrapped_notices_and_copyright_lines(licence_model, text, families):
    rng = random.Random(5)
    around = [samples.prose(rng, 30), samples.prose(rng, 40)]
    for whole in (text, f"{around[0]}\n\n{text}\n\n{around[1]}"):
        found = licences.notices_of(whole, licence_model, licences.KnownWords())
        assert sorted({s[2] for s in found}) == families, whole


def test_versions_and_kinds_of_licences_differ(licence_model):
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    own, differ = "Licensed under the Apache License, Version {}.", licences.UNKNOWN
    cases = [
        (gnu.format("", "3"), "GPL-3.0"), (gnu.format("", "2"), "GPL-2.0"),
        (gnu.format("Lesser ", "2.1"), "LGPL-2.1"), (gnu.format("", "1"), differ),
        (gnu.format("Affero ", "1"), differ), (own.format("2"), "Apache-2.0"),
        (own.format("1.1"), "Apache-1.1"), (own.format("1.7"), differ),
        ("Licensed under the Mozilla Public License, version 1.1.", "MPL-1.1"),
    ]
    for text, family in cases:
        words = licences.words_of(text)
        assert licence_model.family(words)[0] == family, text
        for other in licences.TEMPLATES:
            assert other == family or not licences.confirmed(words, other), (text, other)


def test_unknown_paragraphs_are_whole(spark, monkeypatch):
    rows = [(i, f"one\n{i} " + "word " * 400 + "\ntwo") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licences.corpus_paragraphs(docs)
    assert found == sorted(text.split("\n")[1] for _, text in rows)
    monkeypatch.setattr(licences, "SAMPLE_BYTES", 5000)
    some = licences.corpus_paragraphs(docs)
    assert len(some) == 3 and set(some) < set(found)


# --- toxicity ---------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [10, 1999, 2000, 3999, 4000, 5999, 50_000])
def test_capitals_are_counted_in_the_whole_text(size):
    for capitals, vote in ((size // 2, "-"), (size // 2 + 1, "t")):
        for text in ("A" * capitals + "a" * (size - capitals), "a" * (size - capitals) + "A" * capitals):
            assert toxicity.votes_of(text, set(), 0)[11] == vote
    assert toxicity.votes_of("", set(), 0)[11] == "-"



def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op2_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    judged = Counter(
        (labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels
    )
    assert judged[1, 1] / (judged[1, 1] + judged[1, 0]) > 0.75
    assert judged[0, 1] / (judged[0, 1] + judged[0, 0]) < 0.01


def test_label_model_discounts_copies_of_a_voter():
    """Three voices that always agree count as one; their accuracy is still estimated."""
    rng = np.random.default_rng(4)
    patterns = Counter()
    for _ in range(4000):
        y = rng.random() < 0.3

        def voice(right: float) -> str:
            return "t" if (rng.random() < right) == y else "c"

        copy = voice(0.7)
        patterns[voice(0.9) + voice(0.85) + voice(0.8) + copy * 3] += 1
    names = sorted(patterns)
    model = toxicity.LabelModel(names, [patterns[n] for n in names])
    assert [3, 4, 5] in [sorted(c) for c in model.cliques]
    for found, true in zip(model.accuracies(), (0.9, 0.85, 0.8, 0.7)):
        assert abs(found - true) < 0.06


def enumerated(patterns, counts, above, rounds, start):
    """The same expectation maximisation, one text and one voter at a time."""
    code = {"c": 0, "-": 1, "t": 2}
    p = list(start)
    for _ in range(rounds):
        prior, tables = [1.0, 1.0], Counter()
        for pattern, n, toxic in zip(patterns, counts, p):
            for y, w in ((0, n * (1 - toxic)), (1, n * toxic)):
                prior[y] += w
                for i, up in above.items():
                    tables[y, i, 0 if up is None else code[pattern[up]], code[pattern[i]]] += w
        for k, pattern in enumerate(patterns):
            odds = prior[1] / prior[0]
            for i, up in above.items():
                row = 0 if up is None else code[pattern[up]]
                chance = [
                    (tables[y, i, row, code[pattern[i]]] + 1 / 9)
                    / sum(tables[y, i, row, v] + 1 / 9 for v in range(3))
                    for y in (0, 1)
                ]
                odds *= chance[1] / chance[0]
            p[k] = odds / (1 + odds)
    return p


def test_label_model_equals_plain_enumeration():
    rng = np.random.default_rng(8)
    patterns = Counter()
    for _ in range(600):
        y = rng.random() < 0.4
        votes = ["ct"[(rng.random() < right) == y] for right in (0.9, 0.8, 0.75, 0.85)]
        chance = "ct"[rng.random() < 0.3]
        patterns["".join(votes[:3]) + 5 * votes[3] + chance] += 1
    names = sorted(patterns)
    counts = [patterns[n] for n in names]
    model = toxicity.LabelModel(names, counts)
    assert [3, 4, 5, 6, 7] in [sorted(c) for c in model.cliques]  # a tree has any size
    expected = enumerated(names, counts, model.above, toxicity.EM_ROUNDS, model.vote())
    assert np.allclose(model.posterior, expected, atol=1e-6)


def test_voters_that_are_mostly_wrong_are_dropped():
    rng = np.random.default_rng(9)
    patterns = Counter()
    for _ in range(3000):
        y = rng.random() < 0.1
        votes = ["ct"[(rng.random() < 0.95) == y] for _ in range(3)]
        patterns["".join(votes) + ("t" if rng.random() < 0.2 else "-")] += 1
    names = sorted(patterns)
    model = toxicity.LabelModel(names, [patterns[n] for n in names])
    assert model.used == [0, 1, 2] and 3 not in model.above


def test_unlabelled_texts_are_voted_on(spark):
    """A word that only texts without a label hold beside a known one is learnt as well."""
    bad = [(i, f"grubel snarth {i} tavon", 1) for i in range(60)]
    good = [(100 + i, f"melor tavon {i} quise", 0) for i in range(60)]
    labelled = spark.createDataFrame(bad + good, "doc_id long, text string, toxic int")
    others = spark.createDataFrame(
        [(300 + i, "grubel snarth tavon" if i % 2 else None) for i in range(80)],
        "doc_id long, text string",
    )
    rows = spark.createDataFrame([("grubel snarth",), ("melor",), (None,)], "text string")
    for model in (toxicity.fit(labelled, others), toxicity.fit(labelled, others.limit(0))):
        scores = [r.s for r in rows.select(model.score("text").alias("s")).collect()]
        assert scores[0] > 0.7 and scores[1] < 0.3


def test_toxicity_without_labels_or_texts(spark, texts):
    none = texts.select("doc_id", "text").withColumn("toxic", F.lit(None).cast("int"))
    model = toxicity.fit(none)
    scores = [r.s for r in texts.select(model.score("text").alias("s")).collect()]
    assert len(scores) == texts.count() and all(s < 1e-6 for s in scores)
    mixed = none.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    model = toxicity.fit(mixed)
    scored = texts.select("text", model.score("text").alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scored)
    assert len({r.s for r in scored if not r.text}) == 1
