"""The language model: exact base scores, probabilities that sum to one, and better held-out scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from remitlens.llm import maxent, queries
from tests.llm.samples import texts

FOLDER = "/root/testdata/sf0.001"


def plain_tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w] + ["\n"]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base(rows):
    counts = Counter(t for i, x in rows if not held_out(i) for t in plain_tokens(x))
    total = sum(counts.values())
    floor = total + len(counts) + 1
    for i, x in rows:
        found = plain_tokens(x)
        score = sum(math.log10((counts[t] + 1) / floor) for t in found)
        yield i, held_out(i), len(found), sum(counts[t] > 0 for t in found), total, pytest.approx(score, rel=1e-9, abs=1e-9)


def scored(spark, rows, head):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return maxent.score(docs, maxent.train(docs.filter(~maxent.is_held_out(docs.doc_id)), head))


@pytest.mark.parametrize("head", [1, 40, 1 << 17])
def test_base_scores(spark, head):
    rows = list(enumerate(texts())) + [(3, "one more"), (3, "one more"), (None, "no id at all")]
    got = sorted((tuple(r)[:6] for r in scored(spark, rows, head).collect()), key=lambda r: (str(r[0]), r[2:5], r[5]))
    want = sorted(base(rows), key=lambda r: (str(r[0]), r[2:5], r[5].expected))
    assert got == want


def test_query_beats_the_base_on_held_out_texts(spark):
    rows = queries.op7_maxent(spark, "/root/testdata/sf0.01").collect()
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.99 * sum(r.base_score for r in out)
    assert len({r.train_tokens for r in rows}) == 1 and all(r.score < 0 for r in rows)


def block_of(found, vocabulary):
    words = sorted({w for text in found for w in text})
    index = np.array([words.index(w) for text in found for w in text])
    return maxent.Block.of(words, index, np.cumsum([0, *map(len, found)]), vocabulary)


def test_tokens():
    found = texts()
    words, index, first = maxent.tokens(pa.array(found))
    got = [[words[i].decode() for i in index[a:b]] for a, b in zip(first, first[1:], strict=False)]
    assert got == [plain_tokens(t) for t in found]


@pytest.mark.parametrize("head", [5, 1 << 17])
def test_probabilities_sum_to_one(spark, head):
    rows = [(i, "a b c d " * 5 + f"word{i} of{i % 3} tail{i}tion end{i}eux") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = maxent.train(docs, head)
    vocabulary, counts = model.vocabulary, {bytes(r.word): r["count"] for r in model.counts.collect()}
    assert np.abs(model.weights.outer[: maxent.ROWS]).max() > 0
    for context in ([], [b"a"], [b"word7", b"of1"], [b"never", b"seen"]):
        words = list(counts)
        found = block_of([[*context, w] for w in words], vocabulary)
        logs = maxent.chances(found, model.weights, vocabulary)[found.first[1:] - 1]
        places = found.places[found.first[1:] - 1]
        known = sum(10**x * (1 if p >= 0 else counts[w] + 1) for x, p, w in zip(logs, places, words, strict=True))
        # An unseen word of every ending takes the rest.
        endings = {}
        for n in range(2000):
            endings.setdefault(maxent.ending(b"zz%d" % n), b"zz%d" % n)
        block = block_of([[*context, w] for w in endings.values()], vocabulary)
        unseen = sum(10 ** maxent.chances(block, model.weights, vocabulary)[block.first[1:] - 1])
        assert len(endings) == maxent.ENDINGS and known + unseen == pytest.approx(1, abs=1e-3)


def test_the_last_two_words_together_decide(spark):
    # Neither word alone tells what follows, nor does any sum of what each tells.
    follows = {("a", "c"): "p", ("a", "d"): "q", ("b", "c"): "q", ("b", "d"): "p"}
    docs = spark.createDataFrame([(i, " ".join([*pair, word])) for i, (pair, word) in enumerate([*follows.items()] * 500)], "doc_id long, text string")
    model = maxent.train(docs)
    for (first, last), word in follows.items():
        found = block_of([[first.encode(), last.encode(), w.encode()] for w in "pq"], model.vocabulary)
        p, q = maxent.chances(found, model.weights, model.vocabulary)[found.first[1:] - 1]
        assert (p - q if word == "p" else q - p) > 0.3


def test_sums_of_groups_of_any_size():
    numbers = np.random.default_rng(7)
    for sizes in ([1, 1, 1], [2, 4, 5, 1, 300, 3, 4], list(range(1, 40)), [900]):
        sizes = np.array(sizes)
        rows, starts = sizes.sum(), np.cumsum(sizes) - sizes
        values, order = numbers.random((rows, 6), dtype=np.float32), numbers.permutation(rows)
        want = np.zeros((len(sizes), 6))
        np.add.at(want, np.repeat(np.arange(len(sizes)), sizes), values[order])
        assert maxent._group_sums(values, order, starts, sizes) == pytest.approx(want, rel=1e-5)


def test_an_update_is_one_step_for_every_row():
    numbers = np.random.default_rng(8)
    rows, slope = numbers.integers(0, 50, (400, 3)).astype(np.int32), numbers.random((400, 4), dtype=np.float32) - 0.5
    rows[:150, 0] = 7
    table, squares, updates = np.ones((60, 4), np.float32), np.zeros(60, np.float32), np.zeros(60, np.int64)
    whole, roots = table.astype(float), squares.astype(float)
    for feature in rows.T:
        for row in np.unique(feature):
            step = slope[feature == row].astype(float).sum(0)
            roots[row] += (step**2).mean()
            whole[row] -= maxent.STEP * step / np.sqrt(roots[row] + 1)
    maxent._update(table, squares, updates, rows, slope)
    assert table == pytest.approx(whole, rel=1e-4, abs=1e-5) and squares == pytest.approx(roots, rel=1e-4)
    assert updates.tolist() == np.bincount(rows.ravel(), minlength=60).tolist()


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert maxent.score(docs, maxent.train(docs)).count() == 0
