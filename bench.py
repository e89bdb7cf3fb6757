"""Time the headline queries; prints one JSON line.

Each query runs to completion into Spark's no-op sink, which computes every
row and column and stores nothing. The reported time is the second run, after
the JVM has loaded and compiled what the query needs; first runs are listed
under ``cold``.
"""

from __future__ import annotations

import json
import os
import time

from tocsin.plans.queries import QUERIES
from tocsin.session import build_session

HEADLINE = [
    "risk_watchlist", "quarterly_trend_qoq", "ae_breakdown", "stage_events",
    "stage_quarterly_sales", "derive_novelty", "period_counts", "portfolio_avg_rate",
    "severity_share", "distinct_reactions", "kpi_cards", "qa_reactions_by_area",
    "qa_top_reports_in_year", "dq_duplicate_keys", "dq_null_counts", "orphan_events",
    "normalise_sql_text", "gen_sales", "gen_events",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tocsin-bench",
        master=f"local[{cpus}]",
        settings={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: run(spark, name, folder) for name in HEADLINE}
    warm = {name: run(spark, name, folder) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
