"""Toxicity by weak supervision.

1. A lexicon of words and word beginnings is read off labelled texts.
2. Many voters look at each training text, labelled or not: groups of lexicon entries, counts of
   hits, and patterns of shouting and of odd symbols; the annotator's label, where there is one, is
   one more voice. A voter says toxic, clean or nothing.
3. A generative model of the votes, fitted by expectation maximisation, takes no voice for the
   truth and estimates each voter's accuracy. Voters that stay correlated when the class is known
   are linked into trees, strongest links first, and each is read beside the one above it, so that
   voices that say the same are not counted twice, however many they are. Voters that are wrong
   more often than right are dropped. It gives each text a posterior probability of being toxic.
4. A logistic regression on words and word beginnings is trained on those posteriors. It alone
   scores texts.

Scores use the text only. Defined results: null and empty texts get the score of a text without
any known feature; rows with equal text get equal scores; without labelled rows of both classes
every score is the share of toxic rows (0 where there is none). An empty table gives no rows; rows
keep their ``doc_id``, null too; very long texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import Written, slices

#: The model is fitted on about so many labelled rows, chosen by a hash of doc_id.
TRAIN_ROWS = 20_000
#: About so many texts without a label are voted on too.
UNLABELLED_ROWS = 10_000
#: Features of the classifier; the voters' lexicon is a part of them.
FEATURES = 2048
#: A lexicon entry is so many times as frequent in toxic texts, and in this share of them.
LEXICON_RATIO, LEXICON_SHARE, LEAST_TEXTS = 50.0, 0.005, 3
#: The G statistic of word and class from which a word is no chance find among tens of thousands.
LEAST_GAIN = 20.0
BEGINNINGS = (4, 5, 6, 7, 8)
LEXICON_GROUPS = 8
#: Two voters are correlated if their votes share more information than this, given the class, and
#: the same voice if they share nearly all of it.
CORRELATED, SAME, EM_ROUNDS = 0.02, 0.95, 60
#: Voters whose votes agree with the posterior less often than this are dropped.
LEAST_ACCURACY = 0.5
CHUNKS_HELD = 150_000
WORDS = re.compile(r"[^\W\d_]+")


def features_of(chunk: str) -> tuple[str, ...]:
    """The words of a lower-case chunk and their beginnings, marked by a length."""
    found = []
    for word in WORDS.findall(chunk):
        found.append(word)
        found += [f"{n}:{word[:n]}" for n in BEGINNINGS if len(word) >= n]
    return tuple(found)


class KnownFeatures(dict):
    """For each chunk of a text, those of its features that are in a vocabulary."""

    def __init__(self, vocabulary):
        self.vocabulary = frozenset(vocabulary)

    def __missing__(self, chunk: str) -> tuple[str, ...]:
        if len(self) > CHUNKS_HELD:
            self.clear()
        found = tuple(x for x in features_of(chunk) if x in self.vocabulary)
        self[chunk] = found
        return found

    def of(self, text: str) -> set[str]:
        found: set[str] = set()
        for some in filter(None, map(self.__getitem__, set(text.lower().split()))):
            found.update(some)
        return found


@dataclass
class ToxicityModel:
    """Weights of the features; accuracies and correlated voters as the label model found them."""

    intercept: float
    weights: dict[str, float] = field(default_factory=dict)
    accuracies: list[float] = field(default_factory=list)
    cliques: list[list[int]] = field(default_factory=list)

    def score(self, column: str) -> Column:
        """The probability that a text is toxic."""
        weights, intercept = self.weights, self.intercept

        @F.arrow_udf("double")
        def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = KnownFeatures(weights)
            for array in texts:
                found = []
                for value in array:
                    total = intercept + sum(weights[x] for x in sorted(known.of(value.as_py())))
                    found.append(1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, total)))))
                yield pa.array(found, pa.float64())
            known.clear()

        return run(F.coalesce(F.col(column), F.lit("")))


# --- lexicon --------------------------------------------------------------------------------


def feature_counts(rows: DataFrame) -> DataFrame:
    """``feature``, and how many texts of either class have it: counted in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 2 << 20):
                counts = (Counter(), Counter())
                for text, toxic in zip(*(c.to_pylist() for c in part.columns)):
                    seen = set()
                    for chunk in set(text.lower().split()):
                        seen.update(features_of(chunk))
                    counts[toxic].update(seen)
                for toxic in (0, 1):
                    names = list(counts[toxic])
                    n = pa.array(counts[toxic].values(), pa.int64())
                    none = pa.array([0] * len(names), pa.int64())
                    columns = [pa.array(names, pa.string()), *((none, n) if toxic else (n, none))]
                    yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    found = rows.mapInArrow(run, "feature string, clean long, toxic long")
    return found.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def choose_features(rows: DataFrame, clean: int, toxic: int) -> list[tuple[str, int, int]]:
    """The features that tell most about the class; at most ``FEATURES`` reach the driver."""
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    total = toxic + clean + 2.0
    here, gain = t + c, F.lit(0.0)
    for seen, n in ((t, toxic + 1.0), (c, clean + 1.0)):
        gain += 2 * seen * F.log(seen * total / (n * here))
        gain += 2 * (n - seen) * F.log((n - seen) * total / (n * (total - here)))
    top = (
        feature_counts(rows)
        .where((F.col("toxic") + F.col("clean") >= LEAST_TEXTS) & (gain >= LEAST_GAIN))
        .orderBy(gain.desc(), "feature")
        .limit(FEATURES)
    )
    return [(r.feature, r.clean, r.toxic) for r in top.collect()]


def lexicon_of(chosen: list[tuple[str, int, int]], clean: int, toxic: int) -> list[str]:
    least = max(LEAST_TEXTS, LEXICON_SHARE * toxic)
    return [
        name
        for name, c, t in chosen
        if t >= least and (t + 0.5) / (toxic + 1) >= LEXICON_RATIO * (c + 0.5) / (clean + 1)
    ]


# --- votes ----------------------------------------------------------------------------------


def votes_of(text: str, hits: set[str], label: int | None) -> str:
    """One letter per voter: ``t`` toxic, ``c`` clean, ``-`` nothing."""
    groups = {zlib.crc32(x.encode()) % LEXICON_GROUPS for x in hits}
    votes = ["t" if g in groups else "-" for g in range(LEXICON_GROUPS)]
    words = max(1, text.count(" ") + text.count("\n") + 1)
    whole = sum(":" not in x for x in hits)
    votes.append("t" if len(hits) >= 2 else "c" if not hits else "-")
    votes.append("t" if whole >= 2 else "c" if not whole else "-")
    votes.append("t" if 100 * len(hits) >= words else "c" if not hits else "-")
    capitals = sum(n for c, n in Counter(text).items() if c.isupper())
    votes.append("t" if capitals > 0.5 * len(text) else "-")
    marks = text.count("!") + text.count("?")
    votes.append("t" if marks > 0.2 * words else "c" if not marks else "-")
    odd = sum(text.count(c) for c in "#*$%&|<>")
    votes.append("t" if odd > words else "c" if not odd else "-")
    votes.append("-" if label is None else "ct"[label])
    return "".join(votes)


def voted(rows: DataFrame, lexicon: list[str], vocabulary: list[str]) -> DataFrame:
    """``votes`` and the known ``features`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = KnownFeatures(vocabulary), frozenset(lexicon)
        for batch in batches:
            for part in slices(batch, 0):
                texts, labels = (c.to_pylist() for c in part.columns)
                found = [known.of(t) for t in texts]
                votes = [votes_of(t, f & words, y) for t, f, y in zip(texts, found, labels)]
                features = pa.array([sorted(f) for f in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(votes), features], ["votes", "features"])

    return rows.select("text", "toxic").mapInArrow(run, "votes string, features array<string>")


# --- label model ----------------------------------------------------------------------------


class LabelModel:
    """Posterior of the class from votes; correlated voters are linked into trees.

    ``apart`` are voters that come from elsewhere, such as an annotator, and join no tree: where all
    voters of one kind agree, they are what the class is told from. Voters that say the same of all
    texts tell nothing and are left out.
    """

    def __init__(self, patterns: list[str], counts: list[int], apart: tuple[int, ...] = ()):
        self.votes = np.array([[{"c": 0, "-": 1, "t": 2}[x] for x in p] for p in patterns], int)
        self.n = np.array(counts, float)
        self.apart, voters = frozenset(apart), range(self.votes.shape[1])
        self.used = [i for i in voters if len(set(self.votes[:, i])) > 1] or list(voters)
        # Voices that say the same whatever the class are one before anything is estimated;
        # else they would outvote the others and pass for the class itself.
        self.posterior = np.zeros(len(self.votes))
        self.link(self.alike, SAME)
        self.posterior = self.vote()
        self.fit()
        right = self.accuracies()
        self.used = [i for i in self.used if right[i] >= LEAST_ACCURACY] or self.used
        self.link(self.shared, CORRELATED)
        self.posterior = self.vote()
        self.fit()

    def vote(self) -> np.ndarray:
        """The share of cliques that say toxic among those that say anything."""
        said = np.zeros((2, len(self.votes)))
        for clique in self.cliques:
            said[0] += (self.votes[:, clique] == 2).mean(1)
            said[1] += (self.votes[:, clique] == 0).mean(1)
        return np.clip((said[0] + 0.1) / (said.sum(0) + 0.2), 0.02, 0.98)

    def fit(self) -> None:
        """A voter's table has a row for each vote of the one above it (one row for a root)."""
        columns = [
            (0 if above is None else self.votes[:, above], self.votes[:, i])
            for i, above in self.above.items()
        ]
        for _ in range(EM_ROUNDS):
            weight = np.stack([self.n * (1 - self.posterior), self.n * self.posterior])
            logs = np.log(weight.sum(1) + 1.0)[:, None] + np.zeros_like(weight)
            for row, vote in columns:
                code = 3 * row + vote
                table = np.stack([np.bincount(code, w, 9) for w in weight]).reshape(2, 3, 3)
                table += 1.0 / 9
                logs += np.log(table / table.sum(2, keepdims=True)).reshape(2, 9)[:, code]
            self.posterior = 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))

    def shared(self, i: int, j: int) -> float:
        """Information that two votes share once the class is known."""
        total, found = self.n.sum(), 0.0
        for w in (self.n * (1 - self.posterior), self.n * self.posterior):
            joint = np.bincount(3 * self.votes[:, i] + self.votes[:, j], w, 9).reshape(3, 3) + 1e-9
            joint /= joint.sum()
            alone = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
            found += w.sum() / total * float((joint * np.log(joint / alone)).sum())
        return found

    def alike(self, i: int, j: int) -> float:
        """Information that two votes share, as a share of the lesser one's own."""
        own = []
        for k in (i, j):
            p = np.bincount(self.votes[:, k], self.n, 3) / self.n.sum()
            own.append(-(p * np.log(p + 1e-12)).sum())
        return self.shared(i, j) / max(1e-9, min(own)) if min(own) > 1e-6 else 0.0

    def link(self, measure, least: float) -> None:
        """Trees of the voters that are most alike by a measure: the strongest link first, none
        that closes a ring. ``cliques`` are the trees' voters, ``above`` each voter's parent."""
        pairs = sorted(
            (
                (measure(i, j), i, j)
                for i in self.used for j in self.used if j < i and not self.apart & {i, j}
            ),
            reverse=True,
        )
        home, beside = {i: [i] for i in self.used}, {i: [] for i in self.used}
        for value, i, j in pairs:
            if value < least:
                break
            a, b = home[i], home[j]
            if a is not b:
                beside[i].append(j)
                beside[j].append(i)
                a.extend(b)
                home.update(dict.fromkeys(a, a))
        self.cliques = [c for i, c in home.items() if c[0] == i]
        self.above: dict[int, int | None] = {}
        for clique in self.cliques:
            self.above[clique[0]] = None
            ahead = [clique[0]]
            while ahead:
                i = ahead.pop()
                for j in beside[i]:
                    if j not in self.above:
                        self.above[j] = i
                        ahead.append(j)

    def accuracies(self) -> list[float]:
        """Of each voter, the share of its votes that agree with the posterior."""
        found = []
        for v in self.votes.T:
            right = self.n * np.where(v == 2, self.posterior, np.where(v == 0, 1 - self.posterior, 0))
            found.append(float(right.sum() / max(1e-9, self.n[v != 1].sum())))
        return found


# --- the whole ------------------------------------------------------------------------------


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """About so many rows, chosen by a hash of ``doc_id``."""
    share = min(1.0, most / max(1, rows.count()))
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    return rows.where(bucket < int(share * (1 << 30)) + 1)


def fit(labelled: DataFrame, unlabelled: DataFrame | None = None) -> ToxicityModel:
    """Fit on rows of ``doc_id``, ``text``, ``toxic`` (0 or 1) and on texts without a label."""
    rows = labelled.where(F.col("toxic").isin(0, 1)).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("long")
    )
    sample = sampled(rows, TRAIN_ROWS).select("text", "toxic")
    held = Written(rows.sparkSession, "toxicity")
    # Copies of one text would lend their chance words the weight of many texts.
    sample = held.table(sample.dropDuplicates(["text", "toxic"]))
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        held.drop(sample)
        share = toxic / max(1, clean + toxic)
        return ToxicityModel(math.log((share + 1e-12) / (1 - share + 1e-12)))
    chosen = choose_features(sample, clean, toxic)
    vocabulary = [name for name, _, _ in chosen] or ["a"]
    looked_at = sample
    if unlabelled is not None:
        others = sampled(unlabelled, UNLABELLED_ROWS).select(
            F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("long").alias("toxic")
        )
        looked_at = sample.unionByName(others.distinct())
    votes = held.table(voted(looked_at, lexicon_of(chosen, clean, toxic), vocabulary))
    # At most a row for each text of the bounded sample.
    tally = votes.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    annotator = len(tally[0].votes) - 1
    labels = LabelModel([r.votes for r in tally], [r.n for r in tally], (annotator,))
    spark = rows.sparkSession
    posterior = spark.createDataFrame(
        [(r.votes, float(p)) for r, p in zip(tally, labels.posterior)], "votes string, p double"
    )
    counted = CountVectorizerModel.from_vocabulary(vocabulary, "features", "x").setBinary(True)
    soft = counted.transform(votes.join(posterior, "votes"))
    both = soft.select("x", F.lit(1.0).alias("label"), F.col("p").alias("weight")).unionByName(
        soft.select("x", F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight"))
    )
    line = LogisticRegression(
        maxIter=40, regParam=1e-4, standardization=False, weightCol="weight", featuresCol="x"
    ).fit(both.where("weight > 0"))
    held.drop(sample, votes)
    weights = dict(zip(vocabulary, map(float, line.coefficients.toArray())))
    return ToxicityModel(
        float(line.intercept), weights, labels.accuracies(), labels.cliques
    )
