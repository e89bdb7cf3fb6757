"""Line dedup by site-relative frequency.

A line is boilerplate on a host if more than a share of the host's pages contain it. Pages are the
distinct texts of a host, so a page that was fetched many times counts once. Boilerplate lines are
taken out of every page of that host; other hosts keep theirs.

Only hashes of lines are counted and joined. Counts combine before each shuffle, so a line or a
page that a third of all rows share costs one row per task and group. Texts are shuffled once.

Defined results: a null host is a host of its own; a null text stays null and counts as the empty
page; lines without a word are never boilerplate; a page all of whose lines go keeps the empty
text; repeated rows are treated alike; all other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import Written, text_or_empty

#: A line goes if it is in more than this share of a host's pages, and in so many at least.
BOILERPLATE_RATIO, LEAST_PAGES = 0.1, 3
HAS_WORD = r"[^\x20\x09-\x0D]"


def digest(column: Column) -> Column:
    return F.unhex(F.md5(column))


def host_key(host: str) -> Column:
    """The host as a key that is never null."""
    return F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit("-"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate_pages(
    docs: DataFrame, held: Written, host: str, ratio: float, least: int
) -> DataFrame:
    """``_host``, ``_page`` and the digests in ``_lines`` of the boilerplate lines of that page."""
    worded = F.filter(lines_of(text_or_empty()), lambda x: x.rlike(HAS_WORD))
    pages = held.table(
        docs.select(
            host_key(host).alias("_host"),
            digest(text_or_empty()).alias("_page"),
            F.array_distinct(F.transform(worded, digest)).alias("_lines"),
        )
        .groupBy("_host", "_page")
        .agg(F.any_value("_lines").alias("_lines"))
    )
    totals = held.table(pages.groupBy("_host").agg(F.count("*").alias("_pages")))
    lines = pages.select("_host", "_page", F.explode("_lines").alias("_line"))
    counts = held.table(
        lines.groupBy("_host", "_line").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    )
    frequent = held.table(
        counts.join(totals, "_host")
        .where(F.col("_n") > F.lit(ratio) * F.col("_pages"))
        .select("_host", "_line")
    )
    hit = held.table(lines.join(frequent, ["_host", "_line"]))
    return held.table(hit.groupBy("_host", "_page").agg(F.collect_set("_line").alias("_lines")))


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    ratio: float = BOILERPLATE_RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """The rows of ``docs`` with boilerplate lines taken out of ``text``, and ``_removed``, their
    number."""
    held = Written(docs.sparkSession, "line-dedup")
    found = boilerplate_pages(docs, held, host, ratio, least_pages)
    rows = docs.select(
        F.struct("*").alias("_row"),
        host_key(host).alias("_host"),
        digest(text_or_empty()).alias("_page"),
    )
    old = lines_of(F.col("_row.text"))
    new = F.filter(old, lambda x: ~F.array_contains(F.col("_lines"), digest(x)))
    hit = F.col("_lines").isNotNull() & F.col("_row.text").isNotNull()
    out = [
        F.when(hit, F.array_join(new, "\n")).otherwise(F.col("_row.text")).alias(c)
        if c == "text"
        else F.col("_row").getField(c).alias(c)
        for c in docs.columns
    ]
    removed = F.when(hit, F.size(old) - F.size(new)).otherwise(0).cast("long").alias("_removed")
    # Few pages have such lines in a small table and many in a large one; the hint keeps one plan,
    # in which both sides are shuffled, for all sizes.
    return rows.join(found.hint("merge"), ["_host", "_page"], "left").select(*out, removed)


SQL = f"""
WITH pages AS (
    SELECT DISTINCT source, coalesce(text, '') AS page FROM documents
), totals AS (
    SELECT source, count(*) AS pages FROM pages GROUP BY source
), lines AS (
    SELECT DISTINCT source, page, line
    FROM (SELECT source, page, unnest(string_split(page, chr(10))) AS line FROM pages)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), frequent AS (
    SELECT l.source, l.line
    FROM (SELECT source, line, count(*) AS n FROM lines GROUP BY source, line) l
    JOIN totals t ON t.source IS NOT DISTINCT FROM l.source
    WHERE n >= {LEAST_PAGES} AND n > {BOILERPLATE_RATIO}::DOUBLE * pages
), per_host AS (
    SELECT source, list(line) AS gone FROM frequent GROUP BY source
), kept AS (
    SELECT d.doc_id, d.source, d.text, string_split(d.text, chr(10)) AS old,
           list_filter(string_split(d.text, chr(10)),
                       lambda x: NOT list_contains(coalesce(gone, []), x)) AS new
    FROM documents d LEFT JOIN per_host p ON p.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, source, coalesce(len(old) - len(new), 0) AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(new, chr(10)) END AS text
FROM kept
"""
