"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equal size in words. Slot ``i`` takes the point ``i * phi mod 1`` (phi
the golden ratio's fraction) through the cumulative weights of the sources, which gives its source;
its rank among that source's slots is the block it takes. A source's documents stand in a shuffled
order fixed by a hash, one after the other and over again, and are cut into blocks of the same
size. Slots and blocks meet in a join on source and rank.

The points decide how much a source gives: as many blocks as they draw, up to ``most`` times its
words. As the points are spread evenly, that is its target to within a few blocks.

Ranks and running sums are taken in two steps, over about the square root of all rows each, so a
source with a third of all documents fills no single task.

Defined results: null and empty texts have size 0 and take nothing; a null source is a source of
its own, the last; a null ``doc_id`` is hashed as an empty text; equal rows stand side by side and
share what their place gives; very long texts are cut into blocks like others; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.llm.common import Written, byte_values

#: Words in a block, and how often a document may be taken.
BLOCK_WORDS, MOST_TIMES = 128, 3
GOLDEN = Decimal("0.61803398874989484820")
#: Parts of the unit interval in which points and sources meet; twice the sources if that is more.
LEAST_BINS = 1024
HASH_BITS = 60


@F.arrow_udf(T.LongType())
def word_count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for array in texts:
        yield pa.array([len(x.split()) for x in byte_values(array)], pa.int64())


def place() -> Column:
    """A row's place in its source's shuffled order: 60 bits of a hash of doc_id."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def cycle_weight(number: Column) -> Column:
    """1, 2, 3, 1, 2, 3, ... for sources numbered from 0."""
    return (number % 3 + 1).cast("double")


def source_targets(sizes: DataFrame, weight=cycle_weight, most: int = MOST_TIMES) -> DataFrame:
    """``source``, ``source_size``, ``target`` and its place ``lo`` to ``hi`` in the unit interval.

    The total is shared by weight; a target stops at ``most`` times the source's size and the rest
    is shared again. In ascending order of cap over weight that is a running sum: a source is
    capped if its share of what the sources before it left reaches its cap. The windows without a
    partition run over one row per source.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    tight = Window.orderBy("tightness", F.col("source").asc_nulls_last())
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    onward = tight.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    upto = by_code_point.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    free = F.when(~F.col("capped"), F.col("weight"))
    spent = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    level = (F.col("total") - spent) / F.sum(free).over(everything)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight(F.row_number().over(by_code_point) - 1))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("tightness", F.col("cap") / F.col("weight"))
        .withColumn("capped", F.col("tightness") <= left / F.sum("weight").over(onward))
        .withColumn(
            "target",
            F.when(F.col("capped"), F.col("cap").cast("double"))
            .otherwise(F.col("weight") * level),
        )
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("hi", F.try_divide(F.sum("words").over(upto), F.sum("words").over(everything)))
        .withColumn("lo", F.coalesce(F.lag("hi").over(by_code_point), F.lit(0.0)))
        .select("source", "source_size", "target", "words", "lo", "hi")
    )


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def streams(sizes: DataFrame, held: Written) -> DataFrame:
    """Every row with ``start``, the words of its source before it in the shuffled order."""
    rows = sizes.count()
    span = -(-(1 << HASH_BITS) // max(1, math.isqrt(rows)))
    parts = held.table(sizes.withColumn("bucket", F.floor(F.col("place") / span).cast("long")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = parts.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    base = held.table(
        sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    )
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumn("row", F.row_number().over(within)).withColumn(
        "local", F.coalesce(F.sum("size").over(earlier), F.lit(0))
    )
    local, base = held.table(local), base.withColumnsRenamed({"source": "s", "bucket": "b"})
    on = same(F.col("source"), F.col("s")) & (F.col("bucket") == F.col("b"))
    return local.join(base, on).withColumn("start", F.col("local") + F.col("base")).drop(
        "s", "b", "base", "local"
    )


def schedule(targets: DataFrame, held: Written, block: int) -> DataFrame:
    """``slot``, ``source`` and ``rank``: the blocks of the mix in its order, as the points fall."""
    found = targets.agg(F.sum("words").alias("words"), F.count("*").alias("sources")).first()
    slots, bins = -(-(found.words or 0) // block), max(LEAST_BINS, 2 * found.sources)
    spark = targets.sparkSession
    point = F.col("slot").cast("decimal(18,0)") * F.lit(GOLDEN)
    points = (
        spark.range(slots).withColumnRenamed("id", "slot")
        .withColumn("u", (point - F.floor(point)).cast("double"))
        .withColumn("bin", F.floor(F.col("u") * bins))
    )
    # A source stands in every bin that its interval meets, so the join needs no range.
    first = F.floor(F.col("lo") * bins)
    last = F.least(F.floor(F.col("hi") * bins), F.lit(bins - 1))
    wide = targets.where("words > 0").select(
        "source", "lo", "hi", F.explode(F.sequence(first, last)).alias("bin")
    )
    drawn = held.table(
        points.join(wide, "bin")
        .where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
        .select("slot", "source", F.floor(F.col("slot") / max(1, math.isqrt(slots))).alias("run"))
    )
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("source", "run").agg(F.count("*").alias("n"))
    base = held.table(
        counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ).withColumnsRenamed({"source": "s", "run": "r"})
    within = Window.partitionBy("source", "run").orderBy("slot")
    local = held.table(drawn.withColumn("local", F.row_number().over(within) - 1))
    on = same(F.col("source"), F.col("s")) & (F.col("run") == F.col("r"))
    return local.join(base, on).select(
        "slot", "source", (F.col("local") + F.col("base")).alias("rank")
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count("text").alias("size"), place().alias("place"))


def mixed(
    docs: DataFrame, weight=cycle_weight, block: int = BLOCK_WORDS, most: int = MOST_TIMES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as ``(spans, rows, targets)``.

    ``rows`` are all documents in their source's order (``source``, ``bucket``, ``row`` name one),
    ``spans`` the parts of documents that each slot takes: ``slot``, ``source``, ``rank``,
    ``bucket``, ``row``, ``doc_id``, ``times`` (how often the source was gone through before),
    ``words`` and ``first``, the place of the span's first word in the document.
    """
    held = Written(docs.sparkSession, "mixing")
    sizes = held.table(sized(docs))
    targets = held.table(source_targets(sizes, weight, most))
    rows = held.table(streams(sizes, held))
    slots = held.table(schedule(targets, held, block)).withColumnRenamed("source", "s")
    drawn = slots.groupBy("s").agg((F.count("*") * block).alias("drawn"))
    goal = targets.join(drawn, same(F.col("source"), F.col("s"))).select(
        "s", "source_size", F.least("drawn", most * F.col("source_size")).alias("goal")
    )
    known = rows.where("size > 0").join(goal, same(F.col("source"), F.col("s"))).drop("s")
    # Every time the source is gone through, a document stands at another place.
    times = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    placed = (
        known.withColumn("times", times)
        .withColumn("at", F.col("start") + F.col("times") * F.col("source_size"))
        .where(F.col("at") < F.col("goal"))
        .withColumn("end", F.least(F.col("at") + F.col("size"), F.col("goal")))
    )
    first_block = F.floor(F.col("at") / block)
    last_block = F.floor((F.col("end") - 1) / block)
    parts = placed.withColumn("block", F.explode(F.sequence(first_block, last_block)))
    begin = F.greatest(F.col("at"), F.col("block") * block)
    stop = F.least(F.col("end"), (F.col("block") + 1) * block)
    spans = parts.join(
        slots, same(F.col("source"), F.col("s")) & (F.col("block") == F.col("rank"))
    ).select(
        "slot", "source", "rank", "bucket", "row", "doc_id", "size", "times",
        (stop - begin).alias("words"), (begin - F.col("at")).alias("first"),
    )
    return spans, rows, targets


def taken(docs: DataFrame, **options) -> DataFrame:
    """Every row's ``doc_id``, ``source``, ``size`` and ``taken``, the words the mix takes of it,
    with ``source_size`` and ``target`` of its source. ``first_slot`` is the slot that takes it
    first, and ``slots`` has that of each time the mix goes through it."""
    spans, rows, targets = mixed(docs, **options)
    columns = ["source", "bucket", "row", "doc_id", "size"]
    none = F.lit(None).cast("long")
    each = (
        spans.groupBy(*columns, "times")
        .agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
        .drop("times")
        .unionByName(rows.select(*columns, F.lit(0).cast("long").alias("words"), none.alias("slot")))
        .groupBy(*columns)
        .agg(
            F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
            F.sort_array(F.collect_list("slot")).alias("slots"),
        )
    )
    goal = targets.select(F.col("source").alias("s"), "source_size", "target")
    return each.join(goal, same(F.col("source"), F.col("s"))).drop("s", "bucket", "row")


SQL = f"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sizes GROUP BY source
), capped AS (
    SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
           3 * source_size / weight::DOUBLE AS tightness
    FROM sources
), settled AS (
    SELECT *, tightness <= (total - coalesce(sum(cap) OVER (
                  ORDER BY tightness, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING
                  AND 1 PRECEDING), 0))::DOUBLE / sum(weight::DOUBLE) OVER (
                  ORDER BY tightness, source NULLS LAST ROWS BETWEEN CURRENT ROW
                  AND UNBOUNDED FOLLOWING) AS is_capped
    FROM capped
), targets AS (
    SELECT source, source_size, CASE WHEN is_capped THEN cap::DOUBLE ELSE weight::DOUBLE
           * ((total - coalesce(sum(cap) FILTER (is_capped) OVER (), 0))::DOUBLE
              / sum(weight::DOUBLE) FILTER (NOT is_capped) OVER ()) END AS target
    FROM settled
), shares AS (
    SELECT *, round(target)::BIGINT AS words,
           sum(round(target)::BIGINT) OVER (ORDER BY source NULLS LAST)::DOUBLE
               / sum(round(target)::BIGINT) OVER ()::DOUBLE AS hi
    FROM targets
), intervals AS (
    SELECT *, coalesce(lag(hi) OVER (ORDER BY source NULLS LAST), 0) AS lo FROM shares
), points AS (
    SELECT slot, (p - floor(p))::DOUBLE AS u FROM (
        SELECT slot, slot::DECIMAL(18,0) * 0.61803398874989484820::DECIMAL(20,20) AS p
        FROM (SELECT unnest(range((SELECT (sum(words) + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}
                                   FROM shares)::BIGINT)) AS slot))
), drawn AS (
    SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
    FROM points JOIN intervals ON u >= lo AND u < hi AND words > 0
), goals AS (
    SELECT t.*, least(3 * source_size, {BLOCK_WORDS} * coalesce(n, 0))::BIGINT AS goal
    FROM targets t LEFT JOIN (SELECT source, count(*) AS n FROM drawn GROUP BY source) d
        ON d.source IS NOT DISTINCT FROM t.source
), placed AS (
    SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.goal,
           (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
                              ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
    FROM sizes d JOIN goals t ON t.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0
            ELSE (goal // source_size) * size
                 + greatest(0, least(size, goal % source_size - start)) END::BIGINT AS taken,
       slot AS first_slot
FROM placed LEFT JOIN drawn ON drawn.source IS NOT DISTINCT FROM placed.source
    AND size > 0 AND start < goal AND rank = start // {BLOCK_WORDS}
"""
