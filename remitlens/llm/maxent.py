"""A language model of hashed features: class-factored softmax, trained by distributed gradient updates.

A word's probability is that of its class times that of the word within it. The most frequent words (``INNER``, the end
of a text among them) are dealt into classes by frequency, with a softmax inside each. All other words, also those never
seen, fall into classes by their ending, and share their class by add-one smoothed counts. Both softmaxes are sums of
rows of a hashed weight table: a bias, the last word, the last two, and the word before the last alone.

Counts of all words come from a grouped sum over the training texts. Words above a count, no more than ``HEAD`` of them,
go to every task; counts of the others are joined to the texts that hold them. Training goes in rounds, each over another
part of the training texts: a task starts from the round's weights, updates them by its own texts, and sends the change
of every row with the number of its updates. Changes are averaged by these numbers, slice by slice, on the executors; the
weights of the next round have a fixed size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import slices
from remitlens.session import written

#: Word that ends each text; no word has a line break.
END = b"\n"
#: Most words whose counts go to every task, classes with a softmax inside, words of each, classes by ending.
HEAD, CLASSES, INNER, ENDINGS = 1 << 17, 16, 32, 16
#: Rows of the hashed tables, tokens of an update, step, rounds, slices in which changes are summed.
ROWS, BATCH, STEP, ROUNDS, SLICES = 1 << 13, 8192, 0.3, 3, 16
#: Rows of groups that are added at once with those of all groups of their size.
FEW = 4
#: Bytes of text whose words are counted at once, tokens that are scored at once: few, so that their scores stay cached.
COUNTED, SCORED_AT_ONCE = 16 << 20, 2048
#: Largest score, so that a row's exponentials add up in single precision.
LARGEST = 80.0

_MARKS = b""".,;:!?'"()[]{}|#*$%&<>-"""


def tokens(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of a text column with A-Z lower-cased and an end after each text, null as empty.

    Returns the distinct words (the end first), the tokens as indexes into them, and where each text begins and the last
    one ends.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    coded = split.flatten().dictionary_encode()
    words = [END, *coded.dictionary.cast(pa.binary()).to_pylist()]
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    if b"" in words:  # where white space begins or ends a text
        real = index != words.index(b"")
        bounds = np.r_[0, np.cumsum(real)][bounds]
        index = index[real]
    first = bounds + np.arange(len(bounds))
    whole = np.zeros(first[-1], np.int64)
    inside = np.ones(len(whole), bool)
    inside[first[1:] - 1] = False
    whole[inside] = index
    return words, whole, first


def ending(word: bytes) -> int:
    return zlib.crc32(word.rstrip(_MARKS)[-2:]) % ENDINGS


def is_held_out(doc_id: Column) -> Column:
    """The rows that training leaves out; rows without an id are trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# -- counts ------------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, column in slices(batch.column(0), COUNTED):
            words, index, _ = tokens(column)
            counts = np.bincount(index, minlength=len(words))
            seen = np.flatnonzero(counts)
            words = [words[i] for i in seen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(map(ending, words), pa.int32()), pa.array(counts[seen], pa.int64())],
                ["word", "ending", "count"],
            )


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes), its ``ending`` class and ``count`` over all texts, as a written table."""
    parts = docs.select("text").mapInArrow(_count, "word binary, ending int, count long")
    return written(parts.groupBy("word", "ending").agg(F.sum("count").alias("count")), "word-counts")


def _head_floor(counts: DataFrame, most: int) -> int:
    """A count that no more than ``most`` words reach, from the number of words by size of their count."""
    steps = F.floor(F.log2("count") * 16).cast("int")
    sizes = counts.groupBy(steps.alias("step")).agg(F.min("count").alias("least"), F.count(F.lit(1)).alias("n")).collect()
    floor, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        held += r["n"]
        if held > most:
            break
        floor = r["least"]
    return floor if floor is not None else max((r["least"] for r in sizes), default=0) + 1


@dataclass
class Vocabulary:
    """What every task knows of the words: at most ``HEAD`` of them, and sums over all."""

    train_tokens: int
    distinct: int
    index: dict[bytes, int]
    counts: np.ndarray
    hashes: np.ndarray
    classes: np.ndarray  # of each word: its class
    places: np.ndarray  # and its place in there, -1 in a class by ending
    ending_sums: np.ndarray  # counts and words of each class by ending, plus one for all unseen words

    @classmethod
    def of(cls, counts: DataFrame, head: int = HEAD) -> Vocabulary:
        sums = counts.groupBy("ending").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).collect()
        floor = _head_floor(counts, head)
        rows = counts.filter(F.col("count") >= floor).collect()
        found = sorted(((bytes(r["word"]), r["count"]) for r in rows), key=lambda x: (x[0] != END, -x[1], x[0]))
        words = [w for w, _ in found] or [END]
        number = np.array([c for _, c in found] or [0], np.int64)
        endings = np.array([ending(w) for w in words])
        inner = min(len(words), CLASSES * INNER)
        classes, places = CLASSES + endings, np.full(len(words), -1)
        classes[:inner], places[:inner] = np.arange(inner) // INNER, np.arange(inner) % INNER
        totals = np.ones(ENDINGS)
        for r in sums:
            totals[r["ending"]] += r["n"] + r["v"]
        np.subtract.at(totals, endings[:inner], number[:inner] + (number[:inner] > 0))
        hashes = np.array([zlib.crc32(w) for w in words], np.uint64)
        return cls(sum(r["n"] for r in sums), sum(r["v"] for r in sums), {w: i for i, w in enumerate(words)}, number, hashes, classes, places, totals)


# -- the model ---------------------------------------------------------------------------------------


@dataclass
class Block:
    """Tokens of some texts one after the other, with what the model needs to know of each."""

    hashes: np.ndarray
    classes: np.ndarray
    places: np.ndarray
    known: np.ndarray  # index in the vocabulary, -1 for other words
    first: np.ndarray  # where each text begins

    @classmethod
    def of(cls, words: list[bytes], index: np.ndarray, first: np.ndarray, vocabulary: Vocabulary) -> Block:
        """Tokens as ``tokens`` gives them; each distinct word is looked up once."""
        get = vocabulary.index.get
        known = np.array([get(w, -1) for w in words], np.int64)
        hashes, classes, places = vocabulary.hashes[known], vocabulary.classes[known], vocabulary.places[known]
        other = np.flatnonzero(known < 0)
        if len(other):
            rest = [words[i] for i in other]
            hashes[other] = [zlib.crc32(w) for w in rest]
            classes[other] = [CLASSES + ending(w) for w in rest]
            places[other] = -1
        return cls(hashes[index], classes[index], places[index], known[index], first)

    def features(self) -> np.ndarray:
        """For each token the rows of its last word, its last two words, and the word before the last."""
        last, second = np.zeros_like(self.hashes), np.zeros_like(self.hashes)
        last[1:] = self.hashes[:-1] + np.uint64(1)
        second[2:] = self.hashes[:-2] + np.uint64(1)
        # Nothing stands before a text's first word.
        starts = self.first[:-1]
        last[starts] = second[starts] = 0
        after = starts + 1
        second[after[after < len(second)]] = 0
        with np.errstate(over="ignore"):
            mixed = np.stack([
                last * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1),
                last * np.uint64(0xC2B2AE3D27D4EB4F) ^ second * np.uint64(0x165667B19E3779F9),
                second * np.uint64(0xD6E8FEB86659FD93) + np.uint64(3),
            ], 1)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - int(math.log2(ROWS)))).astype(np.int32)


@dataclass
class Weights:
    """Rows of class scores, and rows of scores inside a class; the last rows are biases."""

    outer: np.ndarray
    inner: np.ndarray

    @classmethod
    def start(cls, vocabulary: Vocabulary) -> Weights:
        """Biases that give every class and word its share of the counts, all other weights zero."""
        outer = np.zeros((ROWS + 1, CLASSES + ENDINGS), np.float32)
        inner = np.zeros((ROWS + CLASSES, INNER), np.float32)
        sums = np.ones(CLASSES + ENDINGS)
        within = np.full((CLASSES, INNER), -30.0)
        held = np.flatnonzero(vocabulary.places >= 0)
        np.add.at(sums, vocabulary.classes[held], vocabulary.counts[held])
        sums[CLASSES:] = vocabulary.ending_sums
        within[vocabulary.classes[held], vocabulary.places[held]] = np.log(np.maximum(vocabulary.counts[held], 0.5))
        outer[ROWS], inner[ROWS:] = np.log(sums / sums.sum()), within
        # A class without any word must not take part of the probability.
        outer[ROWS, : CLASSES][np.bincount(vocabulary.classes[held], minlength=CLASSES)[:CLASSES] == 0] = -30.0
        return cls(outer, inner)

    def copy(self) -> Weights:
        return Weights(self.outer.copy(), self.inner.copy())


def _powers(scores: np.ndarray) -> np.ndarray:
    """Exponentials of scores in place, and their sums by row as a product, which is much faster than a sum over columns.

    Scores are sums of logs of shares and a few weights; those beyond the limit, which no model of ours reaches, would
    overflow and are cut.
    """
    np.minimum(scores, LARGEST, out=scores)
    np.exp(scores, out=scores)
    return scores @ np.ones(scores.shape[1], np.float32) + np.float32(1e-30)


def _softmax(scores: np.ndarray) -> np.ndarray:
    sums = _powers(scores)
    scores *= (1 / sums)[:, None]
    return scores


def _log_chance(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log10 of the softmax at one column of each row."""
    own = np.minimum(scores[np.arange(len(scores)), chosen], LARGEST).astype(float)
    return (own - np.log(_powers(scores))) / math.log(10)


def _inner_rows(features: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rows inside a class: those of the context, shifted by the class."""
    return (features + (classes * 2654435761)[:, None]) & (ROWS - 1)


def _sum_of_rows(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each line of ``rows``, the sum of these rows of the table. ``take`` copies rows as a whole; indexing does not."""
    total = table.take(rows[:, 0], 0, mode="clip")
    held = np.empty_like(total)
    for column in rows.T[1:]:
        total += table.take(column, 0, out=held, mode="clip")
    return total


def _scores(weights: Weights, features: np.ndarray, classes: np.ndarray, inside: np.ndarray):
    """Scores of all classes for each token, and of all words of its class for the tokens ``inside``, with their rows."""
    outer = _sum_of_rows(weights.outer, features)
    outer += weights.outer[ROWS]
    of = classes[inside]
    rows = _inner_rows(features.take(inside, 0), of)
    inner = _sum_of_rows(weights.inner, np.column_stack([rows, ROWS + of]))
    return outer, inner, rows


def _group_sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the values' rows in groups: those of ``order`` from each start on, as many as its size.

    Most groups have a few rows, for which ``reduceat`` would take longer than their rows do: those of up to ``FEW`` rows are
    added at once, in its order (the first row plus the sum of the others), and only larger ones go through it.
    """
    sums = values.take(order[starts], 0)
    for size in range(2, FEW + 1):
        groups = np.flatnonzero(sizes == size)
        if len(groups):
            rest = values.take(order[starts[groups] + 1], 0)
            for n in range(2, size):
                rest += values.take(order[starts[groups] + n], 0)
            sums[groups] = sums.take(groups, 0) + rest
    groups = np.flatnonzero(sizes > FEW)
    if len(groups):
        many = sizes[groups]
        begins = np.cumsum(many) - many
        rows = np.arange(many.sum()) + np.repeat(starts[groups] - begins, many)
        sums[groups] = np.add.reduceat(values.take(order[rows], 0), begins, axis=0)
    return sums


def _update(table: np.ndarray, squares: np.ndarray, updates: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """One step for every row: its slopes summed, and divided by the root of all squares so far."""
    for feature in rows.T:
        order = np.argsort(feature.astype(np.uint16), kind="stable")  # by radix
        ordered = feature[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        sizes, at = np.diff(np.r_[starts, len(ordered)]), ordered[starts]
        summed = _group_sums(slope, order, starts, sizes)
        squares[at] += (summed * summed) @ np.full(summed.shape[1], 1 / summed.shape[1], np.float32)
        summed *= STEP
        summed /= np.sqrt(squares[at] + 1.0)[:, None]
        table[at] = np.subtract(table.take(at, 0), summed, out=summed)
        updates[at] += sizes


class Learner:
    """Weights that follow the texts of one task."""

    def __init__(self, start: Weights):
        self.start, self.weights = start, start.copy()
        self.squares = [np.zeros(len(w), np.float32) for w in (start.outer, start.inner)]
        self.updates = [np.zeros(len(w), np.int64) for w in (start.outer, start.inner)]

    def learn(self, block: Block) -> None:
        features = block.features()
        for i in range(0, len(features), BATCH):
            part, classes, places = features[i : i + BATCH], block.classes[i : i + BATCH], block.places[i : i + BATCH]
            inside = np.flatnonzero(places >= 0)
            outer, inner, rows = _scores(self.weights, part, classes, inside)
            outer, inner = _softmax(outer), _softmax(inner)
            outer[np.arange(len(part)), classes] -= 1
            _update(self.weights.outer, self.squares[0], self.updates[0], part, outer)
            if len(inside):
                inner[np.arange(len(inside)), places[inside]] -= 1
                _update(self.weights.inner, self.squares[1], self.updates[1], rows, inner)

    def changes(self) -> Iterator[tuple[int, bytes, bytes]]:
        """The change of each slice of rows times its updates, in single precision, and the updates."""
        pairs = ((self.weights.outer, self.start.outer), (self.weights.inner, self.start.inner))
        for kind, ((now, before), updates) in enumerate(zip(pairs, self.updates, strict=True)):
            for part, rows in enumerate(np.array_split(np.arange(len(now)), SLICES)):
                if updates[rows].any():
                    times = updates[rows].astype(np.float32)
                    yield kind * SLICES + part, ((now[rows] - before[rows]) * times[:, None]).tobytes(), times.tobytes()


CHANGE = "slice int, change binary, updates binary"


def _change_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["slice", "change", "updates"])


def _sum_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each slice among those that come by; holds one sum a slice."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for number, change, updates in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            parts = [np.frombuffer(x, np.float32) for x in (change, updates)]
            held[number] = [a + b for a, b in zip(held[number], parts, strict=True)] if number in held else [p.copy() for p in parts]
    yield _change_batch([(n, a.tobytes(), b.tobytes()) for n, (a, b) in held.items()])


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: Weights
    counts: DataFrame


def train(docs: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> Model:
    """A model of all texts of ``docs`` (``doc_id``, ``text``): every text is counted and trained on once."""
    counts = word_counts(docs)
    vocabulary = Vocabulary.of(counts, head)
    weights = Weights.start(vocabulary)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(vocabulary)  # at most HEAD words
    turn = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(rounds))
    for number in range(rounds):
        sent = context.broadcast(weights)  # of a fixed size

        def learn(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            learner = Learner(sent.value)
            for batch in batches:
                for _, column in slices(batch.column(0)):
                    learner.learn(Block.of(*tokens(column), shared.value))
            yield _change_batch(list(learner.changes()))

        changes = docs.filter(turn == number).select("text").mapInArrow(learn, CHANGE)
        summed = changes.repartition(2 * SLICES, "slice").mapInArrow(_sum_changes, CHANGE).collect()
        weights = weights.copy()
        for r in summed:
            table = (weights.outer, weights.inner)[r["slice"] // SLICES]
            rows = np.array_split(np.arange(len(table)), SLICES)[r["slice"] % SLICES]
            times = np.frombuffer(r["updates"], np.float32)[:, None]
            table[rows] += np.frombuffer(r["change"], np.float32).reshape(len(rows), -1) / np.maximum(times, 1)
        sent.unpersist()
    return Model(vocabulary, weights, counts)


# -- scores ------------------------------------------------------------------------------------------


def chances(block: Block, model_weights: Weights, vocabulary: Vocabulary) -> np.ndarray:
    """Log10 probability of each token, short of the smoothed count of words in classes by ending."""
    features = block.features()
    found = np.empty(len(features))
    for i in range(0, len(features), SCORED_AT_ONCE):
        last = i + SCORED_AT_ONCE
        part, classes, places = features[i:last], block.classes[i:last], block.places[i:last]
        inside = np.flatnonzero(places >= 0)
        outer, inner, _ = _scores(model_weights, part, classes, inside)
        here = _log_chance(outer, classes)
        here[inside] += _log_chance(inner, places[inside])
        outside = np.flatnonzero(places < 0)
        here[outside] -= np.log10(vocabulary.ending_sums[classes[outside] - CLASSES])
        found[i:last] = here
    return found


SCORED = "row long, doc_id long, n_tokens long, n_known long, smoothed double, model double, others array<struct<word:binary,n:long>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its scores, as log10 probabilities.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one smoothed
    single words) and ``score`` (the model's). A null text counts as empty, which is its end alone. Rows are scored one by
    one, those that repeat others and those without an id too; columns beside these two are left out.
    """
    context = docs.sparkSession.sparkContext
    shared, sent = context.broadcast(model.vocabulary), context.broadcast(model.weights)
    names = [c.split()[0] for c in SCORED.split(", ")]

    def rows_of(column: pa.Array, vocabulary: Vocabulary, weights: Weights) -> list[pa.Array]:
        words, index, first = tokens(column)
        block = Block.of(words, index, first, vocabulary)
        model_part = chances(block, weights, vocabulary)
        # Counts of words in the head are at hand; those of others are joined later.
        counts = np.where(block.known >= 0, vocabulary.counts[block.known], 0)
        logs = np.log10(counts + 1.0)
        model_part += np.where(block.places < 0, logs, 0.0)
        sums = [np.add.reduceat(x, first[:-1]) for x in ((counts > 0).astype(np.int64), logs, model_part)]
        # Other words of a text, each with how often it occurs there.
        other = np.flatnonzero(block.known < 0)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))[other]
        pairs, times = np.unique(text * len(words) + index[other], return_counts=True)
        kinds = pa.array(words, pa.binary()).take(pa.array(pairs % len(words), pa.int64()))
        offsets = np.searchsorted(pairs // len(words), np.arange(len(first))).astype(np.int32)
        others = pa.StructArray.from_arrays([kinds, pa.array(times, pa.int64())], ["word", "n"])
        return [*[pa.array(x) for x in (np.diff(first), *sums)], pa.ListArray.from_arrays(offsets, others)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, row = shared.value, sent.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, column in slices(batch.column(1)):
                ids, numbers = batch.column(0).slice(start, len(column)), pa.array(np.arange(row, row + len(column)))
                row += len(column)
                yield pa.RecordBatch.from_arrays([numbers, ids, *rows_of(column, vocabulary, weights)], names)

    scored = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORED), "scored")
    others = scored.select("row", F.explode("others").alias("x")).select("row", "x.word", "x.n")
    logs = (
        others.join(model.counts.select("word", "count"), "word")
        .groupBy("row")
        .agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("count") + 1.0)).alias("logs"))
    )
    vocabulary = model.vocabulary
    whole = math.log10(vocabulary.train_tokens + vocabulary.distinct + 1)
    smoothed = F.coalesce("logs", F.lit(0.0))
    return scored.drop("others").join(logs, "row", "left").select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.train_tokens).cast("long").alias("train_tokens"),
        (F.col("smoothed") + smoothed - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") + smoothed).alias("score"),
    )
