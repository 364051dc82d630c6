"""SimHash near-dedup against all pairs in plain Python."""

import random

import numpy as np
import pytest
import xxhash

from remitlens.llm import simhash
from remitlens.llm.components import connected_components
from remitlens.llm.queries import op1_simhash
from remitlens.session import written

SPACES = " \t\n\x0b\x0c\r"


def plain_fingerprint(text, width=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACES:
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """Smallest id reachable for each (id, print), over all pairs of prints."""
    distinct = sorted(set(p for _, p in prints))
    group = {p: p for p in distinct}
    changed = True
    near = [(p, q) for i, p in enumerate(distinct) for q in distinct[i + 1 :] if (p ^ q).bit_count() <= radius]
    while changed:
        changed = False
        for p, q in near:
            low = min(group[p], group[q])
            changed |= group[p] != low or group[q] != low
            group[p] = group[q] = low
    least = {}
    for i, p in prints:
        if i is not None:
            least[group[p]] = min(least.get(group[p], i), i)
    return [(i, p, least.get(group[p])) for i, p in prints]


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    found = [None, "", " \t\n", "one", "One two", "one two three four", "a\x0bb\x0cc d", "ÄÖ Ü ß é", "x " * 3000]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(40, 400))]
        found.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "Changed"
            found.append("\n".join(copy))
    return found + found[5:15] + [" ".join(rng.choice(words) for _ in range(20_000))]


@pytest.mark.parametrize("text", texts()[:20] + texts()[-1:])
def test_fingerprint(text):
    assert simhash.simhash((text or "").encode()) == plain_fingerprint(text)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_groups_equal_all_pairs(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [rows[12], (None, rows[13][1]), (None, "a text that no other row is near to, without an id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = docs.select("doc_id", simhash.fingerprint(docs.text).alias("fingerprint"))
    got = sorted(map(tuple, simhash.near_duplicates(prints, tile=16).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    want = [(i, signed(p), c) for i, p, c in plain_components([(i, plain_fingerprint(t)) for i, t in rows])]
    assert got == sorted(want, key=str)


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted((i, f"{p:016x}", c) for i, p, c in plain_components(docs))
    assert sorted(map(tuple, op1_simhash(spark, folder).collect())) == want


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
def test_forest_spans_all_links(radius):
    rng = np.random.default_rng(radius)
    prints = np.unique(np.concatenate([rng.integers(0, 2**64, 300, np.uint64), *[
        np.uint64(rng.integers(0, 2**64, 1, np.uint64)[0]) ^ (np.uint64(1) << rng.integers(0, 64, 90, np.uint64)) for _ in range(4)
    ]]))
    a, b = prints[::2], prints[1::2]

    def groups(edges):
        group = {int(p): int(p) for p in prints}
        for _ in range(40):
            for p, q in edges:
                group[p] = group[q] = min(group[p], group[q])
        return group

    found = [tuple(map(int, e)) for x, y in ((a, None), (b, None), (a, b)) for e in zip(*simhash.forest(x, y, radius), strict=True)]
    want = [(int(p), int(q)) for i, p in enumerate(prints) for q in prints[i + 1 :] if int(p ^ q).bit_count() <= radius]
    assert len(set(groups(found).values())) == len(set(groups(want).values()))
    assert all(groups(want)[p] == groups(want)[q] for p, q in found)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)] + [(500, 100 + i) for i in range(40)] + [(7, 7), (900, 901), (901, 900)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {500: 100, 900: 900, 901: 900}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(i, t, "x" if i % 2 else None) for i, t in enumerate(texts())]
    rows += [(3, "one", "b"), (3, "one", "a"), (None, "lonely text here", "z"), (None, "lonely text here", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")  # a clashing name
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = plain_components([(r[0], plain_fingerprint(r[1])) for r in rows])
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == sorted({c for _, _, c in groups if c is not None})
    assert [(r.text, r.fingerprint) for r in kept.collect() if r.doc_id is None] == [("lonely text here", "y")]
    assert [r.fingerprint for r in kept.collect() if r.doc_id == 3] == ["a"]


def test_columns_of_any_name(spark):
    prints = spark.createDataFrame([(1, 5, "x", "y", 3), (2, 5, "x", "y", 4), (3, -1, None, "z", 5)], "doc_id long, fingerprint long, root string, component_id string, node int")
    found = simhash.near_duplicates(written(prints, "prints"))
    assert found.columns == ["fingerprint", "doc_id", "node", "root", "component_id"]
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3}
    docs = spark.createDataFrame([(1, "a b c d e", "x", "y"), (2, "a b c d e", "x", "y")], "doc_id long, text string, root string, fingerprint string")
    assert [tuple(r) for r in simhash.drop_near_duplicates(docs).collect()] == [(1, "a b c d e", "x", "y")]
