"""Spelling variants: words one edit apart, and the frequent word each rare one stands for.

Two words are near if one code point inserted, deleted or replaced turns one into the other. Of a
word and a near one that is not shorter, the longer differs in the first or in the second half of
the shorter, so the other half stands in both unchanged, at the start or at the end.

1. Routing. A word goes out under its halves, both as a pattern of its own length and as an entry
   for patterns one shorter. A half that very many words share is cut further: of the part that may
   differ, again one half is equal. So no group grows with the table, and no pair is missed.
2. Index. A shard's words, each between delimiters, get a two-way FM-index: suffix ranks of the
   delimited words for growing a match to the left, and of the reversed ones for growing it to the
   right. A match is an interval of suffix ranks.
3. Search scheme. Each pattern matches its first half exactly and then grows to the right over the
   second, and matches its second half exactly and then grows to the left over the first, allowing
   one error on the way; it ends at a delimiter. Either search grows one way only, so no interval
   has to be kept in step with that of the other direction.
4. Links add up to the number of near words and to the most frequent one. A word's *form* is that
   one if it is frequent enough. Forms are followed to their end by doubling.

Defined results: null and empty texts have no words; a null ``doc_id`` changes nothing here (the
caller's rule for words may use it); the order of rows, copies and other columns do not matter; of
equally frequent near words the smallest in code-point order is the form; a word is as long as it
is, also when a very long text is one word; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import Written, text_or_empty

#: A run of Latin letters, and which of them are lower-cased.
RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_POINTS, LEAST_COUNT, FORM_TIMES = 7, 2, 10
#: Rows of a shard, rows that may share a half before it is cut further, patterns searched at once.
SHARD_ROWS, MOST_ROWS, STEP_PATTERNS = 100_000, 50_000, 8_192
DELIMITER = 0
LINK = "word string, n long, near string, near_n long"


# --- index ----------------------------------------------------------------------------------


class Words:
    """Words as one array of code points with the place and length of each."""

    def __init__(self, words: list[str]):
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.length) - self.length


def spread(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers start, start + 1, ... of each run one after the other, and each one's run."""
    owner = np.repeat(np.arange(len(length)), length)
    first = np.cumsum(length) - length
    return np.arange(len(owner)) - first[owner] + start[owner], owner


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that the ranks tell apart."""
    size, span = len(ranks), 1
    while True:
        ahead = np.zeros(size, np.int64)
        ahead[: size - span] = ranks[span:] + 1
        both = ranks * (int(ranks.max()) + 2) + ahead
        order = np.argsort(both, kind="stable")
        new = np.ones(size, np.int64)
        new[0] = 0
        new[1:] = both[order][1:] != both[order][:-1]
        ranks = np.empty(size, np.int64)
        ranks[order] = np.cumsum(new)
        if ranks[order[-1]] == size - 1 or span >= size:
            return order
        span *= 2


class Direction:
    """Suffix ranks of delimited words, for growing matches before their front.

    Delimiters count by the number of their word, and words come in order, so they are in order as
    suffixes too. ``steps`` holds what stands before each suffix, with the suffix's rank, in order:
    the place of a symbol and a rank in it is the rank that the match grown by the symbol starts at.
    """

    def __init__(self, words: list[str]):
        order = sorted(range(len(words)), key=words.__getitem__)
        listed = Words([words[i] for i in order])
        self.symbols = np.unique(listed.points)
        count, size = len(words), len(listed.points) + len(words) + 1
        text = np.full(size, DELIMITER, np.int64)
        at, owner = spread(listed.start + np.arange(1, count + 1), listed.length)
        text[at] = np.searchsorted(self.symbols, listed.points) + 1
        marks = np.flatnonzero(text == DELIMITER)
        ranks = text + count
        ranks[marks] = np.arange(count + 1)
        suffixes = suffix_order(ranks)
        before = text[suffixes - 1]
        self.size, self.before = size, before
        self.steps = np.sort(before * size + np.arange(size))
        word = np.full(size, -1, np.int64)  # the word that a suffix is the whole of
        word[marks[:-1] + 1] = order
        self.whole = word[suffixes]
        self.delimiters = count + 1

    def codes(self, points: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.symbols, points) + 1

    def grown(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        """The intervals of the matches grown by a symbol each."""
        base = symbol * self.size
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each interval its number of branches, and symbol and interval of every branch."""
        rank, owner = spread(low, high - low)
        kinds = len(self.symbols) + 1
        pair, count = np.unique(owner * kinds + self.before[rank], return_counts=True)
        letter = pair % kinds != DELIMITER
        owner, symbol, count = pair[letter] // kinds, pair[letter] % kinds, count[letter]
        start = np.searchsorted(self.steps, symbol * self.size + low[owner])
        return np.bincount(owner, minlength=len(low)), symbol, start, start + count

    def ended(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The word that each match is the whole of, or -1."""
        first, last = self.grown(np.full(len(low), DELIMITER), low, high)
        found = np.full(len(low), -1, np.int64)
        some = first < last
        found[some] = self.whole[self.steps[first[some]] % self.size]
        return found

    def near(self, patterns: Words, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a pattern and a word that equal each other up to ``exact`` and differ by one
        code point, replaced or inserted into the pattern, after it."""
        codes, start, length = self.codes(patterns.points), patterns.start, patterns.length
        low = np.zeros(len(length), np.int64)
        high = np.full(len(length), self.delimiters, np.int64)
        owners, words = [], []
        erred = (np.zeros(0, np.int64),) * 3  # pattern and interval of matches with the error
        for i in range(int(length.max(initial=-1)) + 1):
            free = np.flatnonzero((exact <= i) & (i <= length))
            here = later = (np.zeros(0, np.int64),) * 3
            if len(free):
                shared, which = np.unique(low[free] * (self.size + 1) + high[free], return_inverse=True)
                count, symbol, first, last = self.branches(*np.divmod(shared, self.size + 1))
                at, owner = spread((np.cumsum(count) - count)[which], count[which])
                owner = free[owner]
                inside = i < length[owner]
                own = codes[np.minimum(start[owner] + i, len(codes) - 1)]
                other = ~inside | (symbol[at] != own)
                at, owner, inside = at[other], owner[other], inside[other]
                here = owner, first[at], last[at]
                later = owner[inside], first[at[inside]], last[at[inside]]
            owner, left, right = (np.concatenate(pair) for pair in zip(erred, here))
            done = length[owner] == i
            word = self.ended(left[done], right[done])
            owners.append(owner[done][word >= 0])
            words.append(word[word >= 0])
            owner, left, right = owner[~done], left[~done], right[~done]
            left, right = self.grown(codes[start[owner] + i], left, right)
            some = left < right
            erred = tuple(
                np.concatenate(pair) for pair in zip((owner[some], left[some], right[some]), later)
            )
            whole = np.flatnonzero(i < length)
            low[whole], high[whole] = self.grown(codes[start[whole] + i], low[whole], high[whole])
        return np.concatenate(owners), np.concatenate(words)


class TwoWayIndex:
    """Suffix ranks of the words of a shard for both directions, built where they are asked for."""

    def __init__(self, rightward: list[str], leftward: list[str]):
        self.sides = rightward, leftward

    def links(self, patterns: tuple[list[str], list[str]]) -> Iterator[tuple[str, str]]:
        """Each pair of a pattern and a near word that is not shorter; of equal length once."""
        for leftward in (False, True):
            words, asked = self.sides[leftward], patterns[leftward]
            if not asked:
                continue
            turned = (lambda w: w) if leftward else (lambda w: w[::-1])
            # A match grows before its front, so growing to the right reads words backwards.
            index = Direction([turned(w) for w in words])
            for i in range(0, len(asked), STEP_PATTERNS):
                some = asked[i : i + STEP_PATTERNS]
                listed = Words([w[::-1] if leftward else w for w in some])
                half = listed.length // 2
                exact = listed.length - half if leftward else half
                for p, w in zip(*(x.tolist() for x in index.near(listed, exact))):
                    pattern, word = some[p], words[w]
                    if leftward and word.startswith(pattern[: len(pattern) // 2]):
                        continue  # found from the other half
                    if len(word) > len(pattern) or pattern < word:
                        yield pattern, word


# --- routing --------------------------------------------------------------------------------


def part_key() -> Column:
    """What the words of a group share: ``head`` code points at the start, ``tail`` at the end."""
    return F.xxhash64(
        "size", "leftward", "head", "tail",
        F.left("word", F.col("head")), F.right("word", F.col("tail")),
    )


def routed(
    words: DataFrame, least: int, held: Written, most: int
) -> tuple[DataFrame, bool]:
    """Each word under the parts that a pattern of ``size`` code points near it leaves unchanged.

    Also says whether parts were cut further: a pair that two finer parts share is found twice.
    """
    length, half = F.char_length("word"), F.floor(F.col("size") / 2).cast("int")
    sizes = F.when(length > least, F.array(length, length - 1)).otherwise(F.array(length))
    sides = F.array(
        F.struct(F.lit(False).alias("leftward"), half.alias("head"), F.lit(0).alias("tail")),
        F.struct(
            F.lit(True).alias("leftward"), F.lit(0).alias("head"),
            (F.col("size") - half).alias("tail"),
        ),
    )
    rows = words.withColumn("size", F.explode(sizes)).select("word", "n", "size", F.inline(sides))
    rows = held.table(rows.withColumn("part", part_key()))
    settled = []
    # What may differ; a single code point is not cut.
    rest = F.col("size") - F.col("head") - F.col("tail")
    while True:
        crowded = held.table(
            rows.where(rest > 1).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > most).select("part")
        )
        if crowded.isEmpty():
            break
        settled.append(rows.join(crowded, "part", "left_anti"))
        cut = F.floor(rest / 2).cast("int")
        finer = F.array(
            F.struct((F.col("head") + cut).alias("head"), F.col("tail").alias("tail")),
            F.struct(F.col("head").alias("head"), (F.col("tail") + rest - cut).alias("tail")),
        )
        rows = held.table(
            rows.join(crowded, "part", "left_semi")
            .select("word", "n", "size", "leftward", F.inline(finer))
            .withColumn("part", part_key())
        )
    for other in settled:
        rows = rows.unionByName(other)
    return rows, bool(settled)


def shard_links(table: pa.Table) -> pa.Table:
    """The links of one shard."""
    counts = dict(zip(table["word"].to_pylist(), table["n"].to_pylist()))
    sides, patterns = ([], []), ([], [])
    known: tuple[dict, dict] = ({}, {})
    for word, size, leftward in zip(*(table[c].to_pylist() for c in ("word", "size", "leftward"))):
        own = len(word) == size
        known[leftward][word] = own or known[leftward].get(word, False)
    for leftward in (False, True):
        sides[leftward].extend(known[leftward])
        patterns[leftward].extend(w for w, own in known[leftward].items() if own)
    found = [*zip(*TwoWayIndex(*sides).links(patterns))] or [(), ()]
    return pa.table({
        "word": pa.array(found[0], pa.string()),
        "n": pa.array([counts[w] for w in found[0]], pa.int64()),
        "near": pa.array(found[1], pa.string()),
        "near_n": pa.array([counts[w] for w in found[1]], pa.int64()),
    })


def links(words: DataFrame, least: int, held: Written, most: int = MOST_ROWS) -> DataFrame:
    """Every pair of near words once, with the number of each."""
    rows, finer = routed(words, least, held, most)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    dealt = rows.withColumn("shard", F.pmod("part", F.lit(shards)))
    found = dealt.groupBy("shard").applyInArrow(shard_links, LINK)
    return held.table(found.distinct() if finer else found)


# --- grouping -------------------------------------------------------------------------------


def runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``run`` of every run of letters, capitals A-Z in lower case."""
    found = F.regexp_extract_all(text_or_empty(), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).withColumn(
        "run", F.translate("run", CAPITALS, SMALL)
    )


def vocabulary(
    words: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """The distinct values of ``word`` that are long and frequent enough, with their number ``n``."""
    counts = words.where(F.char_length("word") >= least_points).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.where(F.col("n") >= least_count)


def roots(forms: DataFrame, held: Written) -> DataFrame:
    """Where each word's forms end, from ``word`` and ``form``: ``word`` and ``root``."""
    reached = held.table(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = held.table(reached.join(ahead, "root", "left").select("word", "root", "further"))
        if further.where("further IS NOT NULL").isEmpty():
            return reached
        reached = held.table(
            further.select("word", F.coalesce("further", "root").alias("root"))
        )


def grouped(
    words: DataFrame, least_points: int = LEAST_POINTS, times: int = FORM_TIMES
) -> DataFrame:
    """Each of the distinct ``word`` (with its number ``n``) with its form and root.

    ``form`` is the most frequent near word if it is ``times`` as frequent at least, ``form_n`` its
    number, ``n_near`` how many words are near, ``root`` where forms lead in the end.
    """
    held = Written(words.sparkSession, "spelling")
    words = held.table(words.select("word", "n"))
    found = links(words, least_points, held)
    both = found.unionByName(found.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"),
        F.col("word").alias("near"), F.col("n").alias("near_n"),
    ))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    around = held.table(
        both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    enough = -F.col("best.less") >= times * F.col("n")
    placed = held.table(
        words.join(around, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(placed.where("form IS NOT NULL"), held)
    return placed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The rows of the query in another SQL engine. Near words share what is left of them without one
#: code point. That engine has no crc32, so the sum is taken byte by byte.
SQL = """
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY b) AS entries FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)),
            lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
        FROM (SELECT range AS b FROM range(256))
    )
), runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents)
    GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1),
                lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])
        ), 4294967295) AS crc
    FROM (SELECT run, n, entries, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h
          FROM runs, crc_table)
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN crc % 31 = 0
            THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
            ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (i, rest)
    WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), around AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near,
        max(near_n) AS near_n
    FROM links GROUP BY word
), placed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= 10 * n THEN near END AS form,
        CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
    FROM words LEFT JOIN around USING (word)
), walk AS (
    SELECT word, word AS reached FROM placed
    UNION ALL
    SELECT walk.word, placed.form FROM walk JOIN placed ON placed.word = walk.reached
    WHERE placed.form IS NOT NULL
)
SELECT word, form, reached AS root, n, n_near, form_n
FROM walk JOIN (SELECT word AS reached, form IS NULL AS ends FROM placed) USING (reached)
JOIN placed USING (word) WHERE ends
"""
