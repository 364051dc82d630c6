"""Quality of documents from their text and from where they come, by hierarchical empirical Bayes.

A logistic regression on words and a few shares gives each document the log odds that it is good. It is fitted on a
bounded sample of the labelled documents. Sites are two levels of places, hosts and paths below them. Each place has
its mean over all documents, of the label where there is one and else of the classifier's probability. A path's mean is
shrunk towards its host's, and a host's towards the mean of all, as if a number of documents with the wider mean were
added. That number is estimated from how much places differ beyond chance: sparse places say little. The document's odds
are then shifted by how far its path's odds lie from those of all documents, its own label left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import LOWER, texts
from remitlens.session import written

#: Labelled documents that the classifier is fitted on, about; words that it knows; fewest documents of such a word;
#: bytes of words' beginnings, which count as words.
SAMPLE, WORDS, LEAST, BEGINNINGS = 20_000, 1024, 5, (5, 6, 8)
#: Steps and ridge of the fit; the largest shift of the log odds by the place.
FIT_STEPS, RIDGE, MOST_SHIFT = 500, 1e-4, 4.0

_MARKS = b""".,;:!?'"()[]{}|#*$%&<>-"""
_SYMBOLS, _DIGITS, _CAPITALS = b"#*$%&|<>", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHARES = 9


def shares(text: bytes, words: list[bytes]) -> list[float]:
    """Shares that tell junk from text, each from 0 to 1 or a bounded logarithm."""
    size, count = max(len(text), 1), max(len(words), 1)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        (len(text) - len(text.translate(None, _SYMBOLS))) / size,
        (len(text) - len(text.translate(None, _DIGITS))) / size,
        (len(text) - len(text.translate(None, _CAPITALS))) / size,
        (len(text) - len(text.translate(None, b".,;:!?"))) / size,
        1 - len(set(lines)) / max(len(lines), 1),
        1 - len(set(words)) / count,
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / max(len(words) - 2, 1) if len(words) > 2 else 0.0,
        min(math.log1p(len(words)) / 10, 1.0),
        min(sum(map(len, words)) / count / 20, 1.0),
    ]


def word_set(words: list[bytes]) -> set[bytes]:
    """The words of a text, and beginnings of the longer ones, which forms of one word share."""
    plain = {w.strip(_MARKS) for w in set(words)}
    return plain.union(*[{b"^" + w[:n] for w in plain if len(w) > n} for n in BEGINNINGS])


@dataclass
class Classifier:
    """Weights of known words and of shares, and how the shares are scaled."""

    words: dict[bytes, int]
    weights: np.ndarray  # of the words, then of the shares, then the bias
    mean: np.ndarray
    scale: np.ndarray

    def log_odds(self, text: bytes) -> float:
        words = text.translate(LOWER).split()
        known = [self.words[w] for w in word_set(words) if w in self.words]
        dense = (np.array(shares(text, words)) - self.mean) / self.scale
        return float(self.weights[known].sum() + dense @ self.weights[len(self.words) : -1] + self.weights[-1])


# -- fitting -----------------------------------------------------------------------------------------


def sampled(labels: DataFrame, most: int) -> DataFrame:
    """About ``most`` labelled documents, chosen by a hash of their id: ``doc_id`` and ``good``.

    A document that is labelled more than once is good if all its labels say so; null labels say nothing.
    """
    rows = labels.filter("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    share = min(1.0, most / max(rows.count(), 1))
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def _word_use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        use: dict[bytes, list[int]] = {}
        for text, good in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            for word in word_set(text.translate(LOWER).split()):
                use.setdefault(word, [0, 0])[good] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(use, pa.binary()), *[pa.array([u[k] for u in use.values()], pa.int64()) for k in (0, 1)]], ["word", "bad", "good"]
        )


def _telling_words(sample: DataFrame, most: int, least: int) -> list[bytes]:
    """The words whose presence tells most about the label, by the likelihood ratio of their table of two by two."""
    use = sample.select("text", "good").mapInArrow(_word_use, "word binary, bad long, good long")
    use = use.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(F.col("bad") + F.col("good") >= least)
    whole = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    n, good = whole["n"], whole["good"]
    seen = F.col("bad") + F.col("good")

    def part(observed: Column, row: Column, column: int) -> Column:
        return F.when(observed > 0, observed * F.log(observed * n / (row * column))).otherwise(0.0)

    tell = part(F.col("good"), seen, good) + part(F.col("bad"), seen, n - good)
    tell += part(good - F.col("good"), n - seen, good) + part(n - good - F.col("bad"), n - seen, n - good)
    return [bytes(r["word"]) for r in use.orderBy(F.desc(tell), "word").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, words: int = WORDS, least: int = LEAST) -> Classifier:
    """A classifier from about ``most`` labelled documents; their features, not their texts, come to the driver."""
    # A bounded number of ids: Spark sends them to the texts instead of shuffling these.
    chosen = F.broadcast(sampled(labels, most))
    sample = written(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "good"), "sample")
    known = {w: i for i, w in enumerate(_telling_words(sample, words, least))}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, good in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found = text.translate(LOWER).split()
                rows.append((sorted(known[w] for w in word_set(found) if w in known), shares(text, found), good))
            kinds = (pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32())
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["known", "shares", "good"])

    rows = sample.mapInArrow(features, "known array<int>, shares array<double>, good int").toArrow().combine_chunks()
    count = rows.num_rows
    x = np.zeros((count, len(known) + SHARES + 1), np.float32)
    if count:
        lists = rows.column("known").combine_chunks()
        x[np.repeat(np.arange(count), np.diff(lists.offsets)), lists.flatten().to_numpy()] = 1
    dense = rows.column("shares").combine_chunks().flatten().to_numpy().reshape(-1, SHARES) if count else np.zeros((0, SHARES))
    mean, scale = (dense.mean(0), dense.std(0) + 1e-6) if count else (np.zeros(SHARES), np.ones(SHARES))
    x[:, len(known) : -1], x[:, -1] = (dense - mean) / scale, 1
    return Classifier(known, _regression(x, rows.column("good").to_numpy().astype(np.float32)), mean, scale)


def _regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a ridge on all but the bias, by Adam over all rows."""
    w, first, second = (np.zeros(x.shape[1]) for _ in range(3))
    if not len(y):
        return w
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 0
    for step in range(1, FIT_STEPS + 1):
        chance = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        slope = (chance - y) @ x / len(y) + ridge * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def evidence(text: Column, classifier: Classifier) -> Column:
    """Log odds that a text is good."""

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([classifier.log_odds(t) for t in texts(column)], pa.float64())

    return of(text)


# -- places ------------------------------------------------------------------------------------------


def _strength(places: DataFrame, mean: Column) -> float:
    """Documents that the wider mean counts for, by moments: places' n, s and their wider ``mean``.

    The variance of places' means around the wider mean, beyond that of drawing n documents, is how much places differ.
    """
    rate = F.col("s") / F.col("n")
    r = places.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("between"),
        F.sum(F.col("n") * mean * (1 - mean)).alias("within"),
    ).first()
    if not r["n"]:
        return 1.0
    chance = r["within"] / r["n"]
    differ = max(r["between"] / r["n"] - chance * r["k"] / r["n"], 1e-9)
    return min(max(chance / differ - 1, 1.0), 1e6)


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, classifier: Classifier) -> DataFrame:
    """``doc_id``, ``evidence``, ``host_posterior``, ``path_posterior``, ``posterior`` and ``kept`` of every row.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``good`` (0 or 1). Null places are a place. A null
    text counts as empty. Posteriors of places leave out the row's own value. Repeated rows count and return each.
    """
    row = docs.select("doc_id", host.alias("host"), path.alias("path"), evidence(F.col("text"), classifier).alias("evidence"))
    known = labels.filter("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").cast("double").alias("label"))
    chance = 1 / (1 + F.exp(-F.col("evidence")))
    rows = written(written(row, "evidence").join(known, "doc_id", "left").withColumn("y", F.coalesce("label", chance)).drop("label"), "places")
    sums = [F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s")]
    paths = written(rows.groupBy("host", "path").agg(*sums), "path-sums")
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "host-sums")
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    mean = min(max((whole["s"] or 0) / (whole["n"] or 1), 1e-3), 1 - 1e-3)
    host_weight = _strength(hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s")), F.lit(mean))
    same = F.col("host").eqNullSafe(F.col("of_host"))
    named = hosts.withColumnRenamed("host", "of_host")
    shrunk = (F.col("host_s") + host_weight * mean) / (F.col("host_n") + host_weight)
    # Places by size; both tables are written, so Spark may split the rows of a large host.
    places = written(paths.join(named, same).drop("of_host").withColumn("host_mean", shrunk), "places")
    path_weight = _strength(places, F.col("host_mean"))
    places = places.withColumnsRenamed({"host": "of_host", "path": "of_path"})
    found = rows.join(places, same & F.col("path").eqNullSafe(F.col("of_path")))
    host_posterior = (F.col("host_s") - F.col("y") + host_weight * mean) / (F.col("host_n") - 1 + host_weight)
    path_posterior = (F.col("s") - F.col("y") + path_weight * F.col("host_posterior")) / (F.col("n") - 1 + path_weight)
    odds = lambda p: F.log(p / (1 - p))
    clipped = lambda p: F.greatest(F.least(p, F.lit(1 - 1e-4)), F.lit(1e-4))
    shift = odds(clipped(F.col("path_posterior"))) - math.log(mean / (1 - mean))
    bounded = F.greatest(F.least(shift, F.lit(MOST_SHIFT)), F.lit(-MOST_SHIFT))
    found = found.withColumn("host_posterior", host_posterior).withColumn("path_posterior", path_posterior)
    found = found.withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + bounded))))
    return found.select("doc_id", "evidence", "host_posterior", "path_posterior", "posterior", (F.col("posterior") >= 0.5).alias("kept"))


def good_labels(labels: DataFrame) -> DataFrame:
    """``good``: of quality and not toxic; null where a label is missing, unless the other one is bad."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select("doc_id", F.when(bad, 0).when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).alias("good"))
