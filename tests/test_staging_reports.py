"""Staging, novelty, breakdown, trend, questions and quality on small literal tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tocsin.operators import counts, novelty, quality, questions, reports, staging
from tocsin.schemas import RAW_ADVERSE_EVENTS, RAW_DRUGS, RAW_SALES_VOLUME, STAGED_EVENT_COLUMNS

AS_OF = date(2024, 6, 30)
ENTITIES = [
    ("A", "Alpha", "North", "x", date(2022, 1, 31), 0.2),
    ("B", "Beta", "South", None, date(2023, 3, 1), 0.1),
    ("C", "Gamma", "North", "z", date(2021, 5, 1), 0.3),
]
OUTCOMES = ["Non-serious", "Moderate", "Hospitalization", "Disability", "Death"]


def label(day):
    return f"{day.year}-Q{(day.month - 1) // 3 + 1}"


def event(number, drug, day, reaction="r", novel=0, outcome="Moderate", **other):
    serious = int(outcome in OUTCOMES[2:])
    row = dict(
        report_id=number, drug_id=drug, drug_name="stale", therapeutic_area="stale",
        event_date=day, quarter=label(day), months_on_market=0, reaction=reaction,
        is_novel_reaction=novel, outcome=outcome, is_serious=serious, reporter_type="Physician",
        country="US", age_group="18-44", sex="F",
    )
    return {**row, **other}


@pytest.fixture(scope="module")
def entities(spark):
    return spark.createDataFrame(ENTITIES, RAW_DRUGS)


@pytest.fixture(scope="module")
def history():
    """Two thousand events; entity A, and one reaction of it, have a third of them."""
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        drug = "A" if rng.random() < 0.5 else rng.choice(["A", "B", "C", "ghost"])
        reaction = "hot" if drug == "A" and rng.random() < 0.6 else rng.choice("uvwxy")
        day = date(2021, 1, 1) + timedelta(days=rng.randrange(1400))
        rows.append(event(
            i, drug, day, reaction, rng.randrange(2), rng.choice(OUTCOMES),
            reporter_type=rng.choice(["Physician", "Consumer", None]),
            country=rng.choice(["US", "DE"]), age_group=rng.choice(["18-44", "75+"]),
        ))
    return rows


@pytest.fixture(scope="module")
def raw(spark, history):
    return spark.createDataFrame(
        [tuple(r[f.name] for f in RAW_ADVERSE_EVENTS.fields) for r in history], RAW_ADVERSE_EVENTS
    ).repartition(5)


def frame(spark, rows):
    return spark.createDataFrame(
        [tuple(r[f.name] for f in RAW_ADVERSE_EVENTS.fields) for r in rows], RAW_ADVERSE_EVENTS
    )


# --- staging --------------------------------------------------------------------------------


def test_stage_entities(entities):
    months = {r.drug_id: r.months_since_launch for r in staging.stage_entities(entities, AS_OF).collect()}
    assert months == {"A": 29, "B": 15, "C": 37}


def test_stage_events(spark, entities):
    rows = [
        event(1, "A", AS_OF, outcome="Death", novel=1),
        event(2, "A", AS_OF + timedelta(days=1)),
        event(3, "ghost", AS_OF),
        event(4, "B", date(2020, 1, 1), outcome="Unheard-of"),
    ]
    staged = staging.stage_events(frame(spark, rows), entities, AS_OF)
    assert staged.columns == STAGED_EVENT_COLUMNS
    found = {r.report_id: r for r in staged.collect()}
    assert set(found) == {1, 4}
    first = found[1]
    assert (first.drug_name, first.therapeutic_area) == ("Alpha", "North")
    assert (first.event_year, first.event_quarter_num) == (2024, 2)
    assert (first.is_serious, first.is_novel_reaction) == (True, True)
    assert first.severity_bucket == "Critical"
    assert found[4].severity_bucket == "Mild" and found[4].is_serious is False


def test_severity_of_each_outcome(spark):
    df = spark.createDataFrame([(o,) for o in [*OUTCOMES, "other", None]], "o STRING")
    found = {
        r.o: (r.s, r.f)
        for r in df.select(
            "o", staging.severity_bucket(F.col("o")).alias("s"),
            staging.is_serious_outcome(F.col("o")).alias("f"),
        ).collect()
    }
    assert found == {
        "Death": ("Critical", True), "Disability": ("Critical", True),
        "Hospitalization": ("Serious", True), "Moderate": ("Moderate", False),
        "Non-serious": ("Mild", False), "other": ("Mild", False), None: ("Mild", False),
    }


def test_quarterly_sales_and_trend_reproduce_published_rows(spark, entities):
    # One product's published months, and its published trend rows
    # (quarter, reports, serious %, units, reports per 1k).
    months = dict([
        ("2022-04", 18913), ("2022-05", 17094), ("2022-06", 17834), ("2022-07", 17681),
        ("2022-08", 19200), ("2022-09", 19023), ("2022-10", 19661), ("2022-11", 17277),
        ("2022-12", 18269), ("2023-01", 17108), ("2023-02", 17667), ("2023-03", 18516),
        ("2023-04", 17099), ("2023-05", 17609), ("2023-06", 18944), ("2023-07", 18633),
        ("2023-08", 17673), ("2023-09", 18764), ("2023-10", 19416), ("2023-11", 17039),
        ("2023-12", 19405), ("2024-01", 19086), ("2024-02", 18027), ("2024-03", 17480),
    ])
    published = [
        ("2022-Q1", 47, 87.2, 0, None), ("2022-Q2", 33, 84.8, 53841, 0.61),
        ("2022-Q3", 36, 77.8, 55904, 0.64), ("2022-Q4", 46, 91.3, 55207, 0.83),
        ("2023-Q1", 44, 90.9, 53291, 0.83), ("2023-Q2", 41, 82.9, 53652, 0.76),
        ("2023-Q3", 42, 97.6, 55070, 0.76), ("2023-Q4", 48, 85.4, 55860, 0.86),
        ("2024-Q1", 18, 88.9, 54593, 0.33),
    ]
    sales = spark.createDataFrame([("A", m, u) for m, u in months.items()], RAW_SALES_VOLUME)
    rollup = spark.createDataFrame(
        [("A", q, int(q[:4]), int(q[-1]), n, round(pct * n / 100), 0) for q, n, pct, _, _ in published],
        "drug_id STRING, quarter STRING, event_year INT, event_quarter_num INT, "
        "total_reports BIGINT, serious_reports BIGINT, novel_reports BIGINT",
    )
    trend = reports.sorted_trend(
        reports.quarterly_trend(rollup, entities, staging.stage_quarterly_sales(sales))
    ).collect()
    assert [
        (r.quarter, r.total_reports, r.serious_pct, r.units_sold, r.reports_per_1k) for r in trend
    ] == published


def test_months_on_market(spark, entities):
    rows = [event(1, "A", date(2022, 2, 1)), event(2, "A", date(2022, 1, 31)),
            event(3, "A", date(2021, 12, 31))]
    found = staging.months_on_market(frame(spark, rows), entities).collect()
    assert {r.report_id: r.months_on_market for r in found} == {1: 1, 2: 0, 3: -1}


# --- novelty --------------------------------------------------------------------------------


def known_pairs(history):
    first = {}
    for r in history:
        pair = (r["drug_id"], r["reaction"])
        first[pair] = min(first.get(pair, r["event_date"]), r["event_date"])
    return first


def plus_six_months(day):
    month = day.month - 1 + 6
    year, month = day.year + month // 12, month % 12 + 1
    last = [31, 29 if year % 4 == 0 else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month - 1]
    return date(year, month, min(day.day, last))


def is_novel_by_hand(history):
    launch = {e[0]: plus_six_months(e[4]) for e in ENTITIES}
    return {
        pair: seen >= launch[pair[0]]
        for pair, seen in known_pairs(history).items() if pair[0] in launch
    }


def test_novelty_boundary(spark, entities):
    end = date(2022, 7, 31)
    rows = [
        event(1, "A", end - timedelta(days=1), "late known"), event(2, "A", end, "novel"),
        event(3, "A", end, "seen before launch"), event(4, "A", date(2021, 1, 1), "seen before launch"),
        event(5, "A", date(2024, 1, 1), "late known"),
    ]
    events = frame(spark, rows).drop("is_novel_reaction")
    found = novelty.flag_events(events, novelty.known_pairs(events, entities)).collect()
    assert {r.report_id: r.is_novel_reaction for r in found} == {
        1: False, 2: True, 3: False, 4: False, 5: False,
    }


def test_novel_counts_agree_however_they_are_made(spark, entities, raw, history):
    expected = defaultdict(lambda: [0, 0, 0, 0])
    flags = is_novel_by_hand(history)
    for r in history:
        if r["drug_id"] == "ghost":
            continue
        cell = expected[r["drug_id"]]
        if r["quarter"] == "2023-Q2":
            cell[0] += 1
            cell[1] += r["is_serious"]
            cell[2] += flags[(r["drug_id"], r["reaction"])]
        elif r["quarter"] == "2023-Q1":
            cell[3] += 1
    expected = {k: tuple(v) for k, v in expected.items()}
    events = staging.event_fields(raw.drop("is_novel_reaction"), None)
    known = novelty.known_pairs(events, entities)
    by_row = counts.period_counts(
        staging.stage_events(novelty.flag_events(events, known), entities), "2023-Q2", "2023-Q1"
    )
    by_cells = novelty.novel_quarter_rollup(novelty.pair_cells(events), entities)
    by_rollup = counts.counts_of_rollup(by_cells, "2023-Q2", "2023-Q1")
    for df in (by_row, by_rollup):
        assert {r.drug_id: tuple(r)[1:] for r in df.collect()} == expected


# --- rollup, trend, breakdown ---------------------------------------------------------------


def test_rollup_against_brute_force_and_merge(spark, raw, history):
    expected = defaultdict(lambda: [0, 0, 0])
    for r in history:
        cell = expected[(r["drug_id"], r["quarter"])]
        cell[0] += 1
        cell[1] += r["is_serious"]
        cell[2] += r["is_novel_reaction"]
    events = staging.event_fields(raw, None)
    whole = counts.quarter_rollup(events)
    parts = [counts.quarter_rollup(events.filter(F.col("report_id") % 3 == i)) for i in range(3)]
    united = counts.merge_rollups(parts[0].unionByName(parts[1]).unionByName(parts[2]), *counts.QUARTER_KEYS)
    for df in (whole, united):
        found = {(r.drug_id, r.quarter): list(r)[4:] for r in df.collect()}
        assert found == dict(expected)


def test_lag_is_previous_row_or_previous_calendar_quarter(spark):
    trend = spark.createDataFrame(
        [("A", "2023-Q3", 2023, 3, 5), ("A", "2024-Q1", 2024, 1, 8), ("A", "2024-Q2", 2024, 2, 6),
         ("B", "2024-Q2", 2024, 2, 1)],
        "drug_id STRING, quarter STRING, event_year INT, event_quarter_num INT, total_reports BIGINT",
    )

    def change(calendar):
        rows = reports.with_quarter_change(trend, calendar).collect()
        return {(r.drug_id, r.quarter): (r.prev_quarter_reports, r.qoq_change) for r in rows}

    assert change(False) == {
        ("A", "2023-Q3"): (None, None), ("A", "2024-Q1"): (5, 3), ("A", "2024-Q2"): (8, -2),
        ("B", "2024-Q2"): (None, None),
    }
    assert change(True) == {
        ("A", "2023-Q3"): (None, None), ("A", "2024-Q1"): (0, 8), ("A", "2024-Q2"): (8, -2),
        ("B", "2024-Q2"): (None, None),
    }


def test_breakdown_and_its_views(spark, entities, raw, history):
    quarters = ["2023-Q2", "2023-Q1", "2022-Q4", "2022-Q3"]
    kept = [r for r in history if r["quarter"] in quarters and r["drug_id"] != "ghost"]
    breakdown = reports.ae_breakdown(staging.event_fields(raw, None), entities, quarters)
    rows = reports.sorted_breakdown(breakdown).collect()
    assert sum(r.report_count for r in rows) == len(kept)
    severity = staging.SEVERITY_BUCKETS
    expected = Counter(
        (r["drug_id"], r["quarter"], r["reaction"], bool(r["is_novel_reaction"]),
         severity.get(r["outcome"], "Mild"), r["reporter_type"], r["country"], r["age_group"])
        for r in kept
    )
    assert {
        (r.drug_id, r.quarter, r.reaction, r.is_novel_reaction, r.severity_bucket,
         r.reporter_type, r.country, r.age_group): r.report_count for r in rows
    } == expected
    order = [(r.drug_id, r.quarter, -r.report_count) for r in rows]
    assert order == sorted(order)

    bars = reports.reaction_bars(breakdown, "A").collect()
    assert {r.drug_id for r in bars} == {"A"}
    assert sum(r.report_count for r in bars) == sum(r["drug_id"] == "A" for r in kept)
    reporters = reports.reporter_breakdown(breakdown).collect()
    assert sum(r.report_count for r in reporters) == len(kept)
    for drug in "ABC":
        shares = [r.share_pct for r in reports.severity_share(breakdown).collect() if r.drug_id == drug]
        assert abs(sum(shares) - 100) < 0.3


def test_watchlist_views(spark):
    watchlist = spark.createDataFrame(
        [(f"e{i:02d}", f"n{i}", float(i * 3), "Clear" if i < 14 else "Monitor", 2, 1) for i in range(25)],
        "drug_id STRING, drug_name STRING, composite_score DOUBLE, signal_flag STRING, "
        "total_reports BIGINT, serious_reports BIGINT",
    )
    cards = {r.signal_flag: tuple(r)[1:] for r in reports.kpi_cards(watchlist).collect()}
    assert cards == {"Clear": (14, 28, 14, 39.0), "Monitor": (11, 22, 11, 72.0)}
    line = reports.above_threshold(watchlist, 66.0).collect()
    assert [r.above_line for r in line] == [True] * 3 + [False] * 22
    assert [r.drug_id for r in reports.flag_roster(watchlist, "Monitor").collect()] == [
        f"e{i}" for i in range(14, 25)
    ]
    top = reports.preview(watchlist, [F.desc("composite_score")]).collect()
    assert len(top) == 20 and top[0].drug_id == "e24"


# --- questions ------------------------------------------------------------------------------


def test_questions(spark, entities, raw, history):
    events = staging.event_fields(raw, None)
    known = [r for r in history if r["drug_id"] != "ghost"]
    names = {e[0]: e[1] for e in ENTITIES}
    critical = Counter(r["drug_id"] for r in known if r["outcome"] in ("Death", "Disability"))
    top = questions.most_severe(events, entities).first()
    assert (top.drug_id, top.critical_reports) == critical.most_common(1)[0]
    assert top.drug_name == names[top.drug_id]

    deaths = sum(r["drug_id"] == "B" and r["outcome"] == "Death" for r in known)
    assert questions.fatal_count(events, entities, "Beta").first().fatal_reports == deaths
    assert questions.fatal_count(events, entities, "Nobody").first().fatal_reports == 0

    north = Counter(r["reaction"] for r in known if r["drug_id"] in "AC")
    found = questions.common_reactions(events, entities, "North", 2).collect()
    ranked = sorted(north.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert [(r.reaction, r.report_count) for r in found] == ranked

    year = Counter(r["drug_id"] for r in known if r["event_date"].year == 2022)
    top = questions.top_reports_in_year(events, entities, 2022).first()
    assert (top.drug_id, top.report_count) == year.most_common(1)[0]

    areas = {r.therapeutic_area: (r.total_reports, r.serious_reports)
             for r in questions.compare_areas(events, entities, ["North", "South"]).collect()}
    assert areas["South"] == (
        sum(r["drug_id"] == "B" for r in known),
        sum(r["is_serious"] for r in known if r["drug_id"] == "B"),
    )


# --- quality --------------------------------------------------------------------------------


def test_quality_findings(spark, entities, raw, history):
    rows = [event(1, "A", AS_OF), event(1, "A", AS_OF), event(1, "B", AS_OF), event(2, None, None or AS_OF)]
    nullable = spark.createDataFrame(
        [(r["report_id"], r["drug_id"]) for r in rows], "report_id INT, drug_id STRING"
    )
    assert [tuple(r) for r in quality.duplicate_keys(nullable, ["report_id"]).collect()] == [(1, 3)]
    assert tuple(quality.key_audit(nullable, "t", ["report_id"]).first()) == ("t", 1, 2)
    assert tuple(quality.key_audit(nullable, "t", ["report_id", "drug_id"]).first()) == ("t", 1, 1)
    assert tuple(quality.key_audit(entities, "t", ["drug_id"]).first()) == ("t", 0, 0)
    nulls = {r.column_name: r.null_rows for r in quality.null_counts(nullable, "t").collect()}
    assert nulls == {"report_id": 0, "drug_id": 1}
    ghosts = sum(r["drug_id"] == "ghost" for r in history)
    assert quality.orphan_counts(raw, entities).first().orphan_ae_records == ghosts
    # An event without an entity id is an orphan, too.
    assert quality.orphan_counts(nullable, entities).first().orphan_ae_records == 1


def test_date_guard_counts_missing_dates_as_excluded(spark):
    df = spark.createDataFrame([(AS_OF,), (AS_OF + timedelta(days=1),), (None,)], "event_date DATE")
    assert tuple(quality.guard_future_dates(df, AS_OF).first()) == (1, 2)
