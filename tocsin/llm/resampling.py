"""Importance resampling: draw the documents whose words look most like those of a target.

Words and runs of words are features; a feature counts in the bucket of its crc32. What a bucket
gains is the log ratio of its shares in target and corpus, both smoothed, in thousandths, rounded
down. A document's weight is the mean gain of its features, rounded down, and its score is the
weight with Gumbel noise from a hash of its id, so that the highest scores are a sample without
replacement in which a document's odds grow with the exponential of its weight.

1. Features become an array of buckets for each document. The buckets of corpus and target are
   counted in aggregates that combine before their shuffle; there are never more than ``buckets``
   rows of them. The gains are one array of that size, and each document's buckets are scored
   against it as arrays. Scores are written; texts are not needed after that.
2. The cutoff is found by bisection: exact count jobs over the written scores halve the interval of
   the lowest drawn score, a few halvings a job. Where many rows share that score, the same is done
   for ``doc_id`` among them, and so on down to the number of the written row, so the cutoff cuts
   between two rows whatever they share.
3. The drawn rows are range-partitioned in that order; a row's rank is its place in its partition
   plus the sizes of the partitions before it.

Defined results: null and empty texts have no features, weight 0 and are never drawn with a least
number of words above 0; a null ``doc_id`` hashes as an empty text and counts as larger than any
other; rows with equal score and ``doc_id`` rank by fewest features, and rows equal in that too are
interchangeable, each with a rank of its own; very long texts count whole; empty tables give no
rows, and an empty target gives every bucket its smoothed share; other columns are kept with
``columns`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import Written, text_or_empty

#: Runs of digits, of letters a-z and of everything beyond ASCII.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST_RUN, BUCKETS, SEED = 1, 10_000, 2024
LEAST_WORDS, DRAWN_PERCENT = 20, 10
SCALE, HASHES = 1000, 4294967296
#: Halvings of an interval that one count job does.
HALVINGS = 4
NO_ID = (1 << 63) - 1
#: What settles the order of rows, the highest score first and the smallest of the others.
ORDER = ("score", "doc", "n_features", "row")


def words(text: Column) -> Column:
    lower = F.translate(text, CAPITALS, SMALL)
    return F.regexp_extract_all(lower, F.lit(FEATURE_WORD), F.lit(0))


def feature_buckets(found: Column, longest: int, buckets: int) -> Column:
    """The bucket of every run of 1 to ``longest`` consecutive words."""

    def bucket(feature: Column) -> Column:
        return (F.crc32(feature.cast("binary")) % buckets).cast("int")

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(found) - (size - 1))
        joined = F.transform(
            starts, lambda i: bucket(F.array_join(F.slice(found, i, F.lit(size)), " "))
        )
        return F.when(F.size(found) >= size, joined).otherwise(F.array().cast("array<int>"))

    single = F.transform(found, bucket)
    return F.concat(single, *[runs(size) for size in range(2, longest + 1)])


def counted(featured: DataFrame) -> DataFrame:
    """How many features fall into each bucket that has any."""
    return featured.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n")
    )


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """One row with ``gains``: an array with the gain of every bucket, seen or not."""
    spark = corpus.sparkSession

    def sized(counts: DataFrame, n: str, total: str) -> DataFrame:
        whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double"))
        filled = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(
            counts, "bucket", "left"
        )
        return filled.select(
            "bucket", F.coalesce("n", F.lit(0)).cast("double").alias(n),
            whole.scalar().alias(total),
        )

    both = sized(corpus, "own", "all_own").join(sized(target, "its", "all_its"), "bucket")
    ratio = ((F.col("its") + 1) * (F.col("all_own") + buckets)) / (
        (F.col("own") + 1) * (F.col("all_its") + buckets)
    )
    gain = F.floor(F.lit(float(SCALE)) * F.ln(ratio)).cast("long")
    pairs = F.array_sort(F.collect_list(F.struct("bucket", gain.alias("gain"))))
    return both.agg(pairs["gain"].alias("gains"))


def floored_mean(total: Column, count: Column) -> Column:
    """``total / count`` rounded down, in whole numbers; 0 for a count of 0."""
    exact = (total - F.pmod(total, count)) / count
    return F.when(count > 0, exact).otherwise(F.lit(0.0)).cast("long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text.cast("binary"), 256), F.lit(8)), 16, 10).cast("double")
    uniform = (h + 0.5) / float(HASHES)
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln(uniform))).cast("long")


def scored(
    docs: DataFrame,
    target: DataFrame,
    held: Written,
    columns: tuple[str, ...] = (),
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """A written table with ``doc_id``, ``n_features``, ``n_words``, ``weight`` and ``score``.

    ``doc`` and ``row`` settle ties: the id with null last, and the number of the written row.
    """

    def featured(df: DataFrame, *keep: str) -> DataFrame:
        found = df.select(*keep, words(text_or_empty()).alias("found"))
        return found.select(
            *keep, F.size("found").cast("long").alias("n_words"),
            feature_buckets(F.col("found"), longest, buckets).alias("buckets"),
        )

    own = [F.col(c).alias(f"kept_{c}") for c in columns]
    texts = docs.select("doc_id", "text", *own)
    corpus = held.table(featured(texts, "doc_id", *[f"kept_{c}" for c in columns]))
    table = held.table(gains(counted(corpus), counted(featured(target)), buckets))
    gained = corpus.withColumn("gains", table.scalar())
    total = F.aggregate(
        "buckets", F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(F.col("gains"), b)
    )
    n = F.size("buckets").cast("long")
    weighed = gained.select(
        "doc_id", n.alias("n_features"), "n_words", floored_mean(total, n).alias("weight"),
        *[f"kept_{c}" for c in columns],
    )
    scores = weighed.withColumns({
        "score": F.col("weight") + noise(F.col("doc_id"), seed),
        "doc": F.coalesce("doc_id", F.lit(NO_ID)),
        "row": F.monotonically_increasing_id(),
    })
    return held.table(scores)


# --- cutoff ---------------------------------------------------------------------------------


def first_reaching(rows: DataFrame, key: Column, wanted: int) -> tuple[int, int]:
    """The smallest value of ``key`` up to which at least ``wanted`` rows lie, and how many lie below.

    ``key`` is a whole number. Each job counts the rows up to some evenly spaced values, exactly,
    and leaves the interval between two of them.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0  # rows under ``low``
    while low < high:
        parts = 1 << HALVINGS
        marks = sorted({low + (high - low) * i // parts for i in range(parts)})
        inside = rows.where((key >= F.lit(low)) & (key <= F.lit(high)))
        found = inside.agg(*[F.count_if(key <= F.lit(m)) for m in marks]).first()
        reaching = [i for i, n in enumerate(found) if below + n >= wanted]
        first = reaching[0] if reaching else len(marks)
        if first < len(marks):
            high = marks[first]
        if first > 0:
            low, below = marks[first - 1] + 1, below + found[first - 1]
    return low, below


def drawn_condition(rows: DataFrame, wanted: int) -> Column:
    """Which rows are the first ``wanted`` by highest score, then smallest id, features and row."""
    if wanted <= 0:
        return F.lit(False)
    drawn, tied = F.lit(False), F.lit(True)
    for name in ORDER:
        key = -F.col(name) if name == "score" else F.col(name)
        among = rows.where(tied)
        cut, below = first_reaching(among, key, wanted)
        drawn = drawn | (tied & (key < F.lit(cut)))
        tied = tied & (key == F.lit(cut))
        wanted -= below
        if rows.where(tied).count() == wanted:
            break
    return drawn | tied


def ranked(rows: DataFrame, held: Written) -> DataFrame:
    """The rows with ``rank``, from a range partitioning in which each partition is sorted."""
    order = [F.desc("score"), *[F.asc(name) for name in ORDER[1:]]]
    placed = held.table(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
            "part": F.spark_partition_id(),
            "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        })
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row a partition, so a window over all of them is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "part").withColumn(
        "rank", F.col("start") + F.col("place") + 1
    ).drop("part", "place", "start")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    columns: tuple[str, ...] = (),
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """All documents with ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    ``columns`` names further columns of ``docs`` to return, such as the text of the drawn.
    """
    held = Written(docs.sparkSession, "resampling")
    rows = scored(docs, target, held, columns, longest, buckets, seed)
    able = F.col("n_words") >= least_words
    wanted = rows.where(able).count() * percent // 100
    drawn = able & drawn_condition(rows.where(able), wanted)
    rest = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    found = ranked(rows.where(drawn), held).unionByName(rest)
    return found.select(
        "doc_id", "n_features", "weight", "score", "rank",
        *[F.col(f"kept_{c}").alias(c) for c in columns],
    )


#: The query's rows in another SQL engine that has no crc32: the sum is taken bit by bit, once for
#: each distinct word.
SQL = """
WITH crc_table AS (
    SELECT list(v ORDER BY b) AS entries FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)),
            lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
        FROM (SELECT range AS b FROM range(256))
    )
), doc_words AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS words
    FROM documents
), target_words AS (
    SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+')) AS word
    FROM benchmark
), tokens AS (
    SELECT row, unnest(words) AS word FROM doc_words
), vocabulary AS (
    SELECT word, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1),
                lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])
        ), 4294967295) % 10000 AS bucket
    FROM (
        SELECT word, entries, hex(encode(word)) AS h
        FROM (SELECT word FROM tokens UNION SELECT word FROM target_words), crc_table
    )
), corpus_counts AS (
    SELECT bucket, count(*) AS n FROM tokens JOIN vocabulary USING (word) GROUP BY bucket
), target_counts AS (
    SELECT bucket, count(*) AS n FROM target_words JOIN vocabulary USING (word) GROUP BY bucket
), gains AS (
    SELECT range AS bucket, floor(1000.0 * ln(
        ((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM corpus_counts) + 10000)::DOUBLE)
        / ((coalesce(s.n, 0) + 1)::DOUBLE
            * ((SELECT coalesce(sum(n), 0) FROM target_counts) + 10000)::DOUBLE)
    ))::BIGINT AS gain
    FROM range(10000) LEFT JOIN corpus_counts s ON s.bucket = range
    LEFT JOIN target_counts t ON t.bucket = range
), sums AS (
    SELECT row, sum(gain)::BIGINT AS total
    FROM tokens JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY row
), weighed AS (
    SELECT row, doc_id, len(words)::BIGINT AS n_features,
        CASE WHEN len(words) = 0 THEN 0
            ELSE (total - ((total % len(words)) + len(words)) % len(words)) // len(words)
        END::BIGINT AS weight,
        ('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT AS h
    FROM doc_words LEFT JOIN sums USING (row)
), scored AS (
    SELECT *, weight + floor(-1000.0 * ln(-ln((h + 0.5)::DOUBLE / 4294967296.0::DOUBLE)))::BIGINT
        AS score
    FROM weighed
), placed AS (
    SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, row) AS place
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (
    SELECT 10 * count(*) // 100 FROM placed) THEN place END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (row)
"""
