"""Best-fit packing against plain best-fit decreasing, exact optima and the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from remitlens.llm import best_fit, queries
from remitlens.llm.common import tokenizer_file
from remitlens.session import written
from tests.llm.samples import texts

FILE = queries.PACKING_TOKENIZER


def plain_best_fit(items, capacity):
    rooms = []
    for item in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= item]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - item)
    return len(rooms)


def optimum(items, capacity):
    """Fewest bins, by trying."""
    items = sorted(items, reverse=True)

    def fits(at, rooms):
        if at == len(items):
            return True
        tried = set()
        for i, room in enumerate(rooms):
            if room >= items[at] and room not in tried:
                tried.add(room)
                if fits(at + 1, [*rooms[:i], room - items[at], *rooms[i + 1 :]]):
                    return True
        return False

    bins = 0
    while not fits(0, [capacity] * bins):
        bins += 1
    return bins


def cases(seed, many=True):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 64])
    kinds = [range(1, capacity + 1), range(capacity // 3, capacity // 2 + 3), (1, capacity), (capacity // 2, capacity // 2 + 1)]
    kind = list(rng.choice(kinds))
    return capacity, [rng.choice(kind) for _ in range(rng.randint(1, 300 if many else 9))]


@pytest.mark.parametrize("seed", range(40))
def test_as_many_bins_as_plain_best_fit(seed):
    capacity, items = cases(seed)
    counts = Counter(items)
    rows, bins = best_fit.best_fit(list(counts), list(counts.values()), capacity)
    assert bins == plain_best_fit(items, capacity)
    # Every rank has one place, no place has two pieces, and full bins come first.
    filled, ranks, loose_from = defaultdict(list), defaultdict(int), {}
    for r in rows:
        assert r.first == ranks[r.size]
        ranks[r.size] += r.items
        for n in range(r.items):
            filled[r.sequence + n // r.each].append((r.offset + n % r.each * r.size, r.size, r.loose))
        assert not (loose_from.get(r.size) and not r.loose)
        loose_from[r.size] = r.loose
    assert ranks == counts and sorted(filled) == list(range(bins))
    for held in filled.values():
        at = 0
        for offset, size, loose in sorted(held):
            assert offset == at
            at += size
        assert at <= capacity and {x[2] for x in held} == {at < capacity}


@pytest.mark.parametrize("seed", range(40))
def test_the_bound_is_one(seed):
    capacity, items = cases(seed, many=False)
    counts = Counter(items)
    bound = best_fit.lower_bound(np.array([*counts]), np.array([*counts.values()]), capacity)
    assert -(-sum(items) // capacity) <= bound <= optimum(items, capacity)


def test_bounds_beyond_the_sum():
    at = lambda sizes, counts: best_fit.lower_bound(np.array(sizes), np.array(counts), 100)
    assert at([51], [7]) == 7 and at([34], [9]) == 5 and at([60, 45], [3, 1]) == 4 and at([], []) == 0


def check_layout(rows, length):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at and size > 0
            at += size
        assert at <= length
    return by_sequence


def given_counts(spark, parts):
    rows = [(part, size, n) for part, items in enumerate(parts) for size, n in Counter(items).items()]
    return written(spark.createDataFrame(rows, "part int, size int, n long"), "counts")


def given_pieces(spark, parts):
    rows = []
    for part, items in enumerate(parts):
        seen = Counter()
        for size in items:
            rows.append((size, part, size, seen[size]))
            seen[size] += 1
    return spark.createDataFrame(rows, "length int, part int, size int, number long")


@pytest.mark.parametrize("seed", range(4))
def test_partitions_exchange(spark, seed):
    """Partitions that cannot be packed well alone; together they can."""
    rng = random.Random(seed)
    parts = [[60] * 50, [40] * 50, [30] * 33, [rng.randint(1, 100) for _ in range(200)], [70] * 10, [55, 45] * 20, [100] * 5, [], [1]]
    items = [x for part in parts for x in part]
    planned = best_fit.plan(given_counts(spark, parts), 100)
    rows = best_fit.place(given_pieces(spark, parts), planned).collect()
    assert Counter(r["length"] for r in rows) == Counter(items)
    used = check_layout(rows, 100)
    alone = sum(plain_best_fit(part, 100) for part in parts)
    bound = best_fit.lower_bound(np.array([*Counter(items)]), np.array([*Counter(items).values()]), 100)
    assert bound <= len(used) < alone and len(used) <= bound + 2
    for r in best_fit.certificates(planned.layout).collect():
        assert r.bins >= r.bound


def test_gaps_are_closed_by_exchange(spark):
    """Alone, best fit needs a bin more than the bound in either partition; together they meet it."""
    parts = [[6, 5, 4, 4, 3, 3, 3, 2], [9, 6, 5, 4, 4, 4, 3, 2, 2]]
    assert [plain_best_fit(part, 10) for part in parts] == [4, 5]
    planned = best_fit.plan(given_counts(spark, parts), 10)
    assert [(r.bins, r.bound) for r in best_fit.certificates(planned.layout).collect()] == [(7, 7)]
    rows = best_fit.place(given_pieces(spark, parts), planned).collect()
    assert len(check_layout(rows, 10)) == 7
    assert Counter(r["length"] for r in rows) == Counter(x for p in parts for x in p)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [r.asDict() for r in queries.op13_best_fit(spark, folder).collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    library = Tokenizer.from_file(tokenizer_file(FILE))
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert set(by_doc) == set(docs)
    total = 0
    for doc_id, text in docs.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for n, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["start"])):
            assert (r["piece"], r["start"], r["length"]) == (n, 2048 * n, min(2048, len(ids) - 2048 * n))
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        assert 2048 * (n + 1) >= len(ids)
    used = check_layout(rows, 2048)
    sizes = Counter(r["length"] for r in rows)
    assert len(used) <= best_fit.lower_bound(np.array([*sizes]), np.array([*sizes.values()]), 2048) + 1


def test_odd_texts_and_repeats(spark):
    given = [(i if i % 7 else None, t, 1, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(given, "doc_id long, text string, part int, pool string").repartition(5)
    rows = best_fit.pack(docs, FILE, length=64).collect()
    check_layout(rows, 64)
    library = Tokenizer.from_file(tokenizer_file(FILE))
    whole = sorted([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t, _, _ in given)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t, _, _ in given if i is not None}
    for i, found in by_doc.items():
        if i is not None:
            assert [x for _, part in sorted(found) for x in part] == ids[i]
    assert sum(len(w) for w in whole) == sum(r.length for r in rows)
    assert best_fit.pack(docs.limit(0), FILE).count() == 0
