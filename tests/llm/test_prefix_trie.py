"""The trie against one that is built turn by turn in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from remitlens.llm import prefix_trie, queries
from remitlens.session import written

SCHEMA = "conv_id long, turn long, role string, text string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_convs(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: tuple((r, t) for _, _, r, t in sorted(turns)) for c, turns in convs.items()}


def rebuilt(convs):
    found = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = convs.get(c - c % 100, ())[:h] + turns[h:]
    return found


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    rows = []
    for node, inside in members.items():
        below = [other for other in members if other[: len(node)] == node]
        ends = sorted(c for c in inside if len(convs[c]) == len(node))
        rows.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children[node]),
            sum(not children[o] for o in below),
            sum((len(members[o]) - 1) * len(o[-1][1].decode()) for o in below if o),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def got(frame):
    return sorted((tuple(r[f] for f in FIELDS) for r in frame.collect()), key=str)


def trie(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return prefix_trie.nodes(written(prefix_trie.packed(docs), "convs"))


def made(seed, convs, depth=6, texts=("", "a", "é😀", "long text")):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for turn in range(rng.randint(0, depth)):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice([*texts, None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed):
    rows = made(seed, 120) + [(None, 1, "user", "lost"), (-3, 1, "user", "a"), (-3, 1, "user", "a"), (7, None, None, None)]
    assert got(trie(spark, rows)) == plain_trie(plain_convs(rows))


def test_shared_heads(spark):
    rows = [(c * 10 + k % 7, *r[1:]) for k, r in enumerate(made(9, 90)) for c in [r[0]]]
    docs = spark.createDataFrame(rows, SCHEMA)
    convs = prefix_trie.with_shared_heads(written(prefix_trie.packed(docs), "convs"))
    assert got(prefix_trie.nodes(written(convs, "rebuilt"))) == plain_trie(rebuilt(plain_convs(rows)))


def test_hot_and_long_conversations(spark):
    """A conversation that thousands share, in more than one range of ids, and one of very many turns."""
    same = [(c, t, "user", "w" * t) for c in range(1000, 10_000) for t in range(2)]
    long = [(5, t, "user", f"turn {t % 3}") for t in range(3000)]
    rows = same + long + [(20_000, 0, "user", ""), (20_000, 1, "user", "other")]
    found = got(trie(spark, rows))
    convs = plain_convs(rows)
    root = next(r for r in found if r[1] == 0)
    assert len(found) == 1 + 3000 + 3 and root[:6] == (5, 0, None, 9002, 2, 3)
    ends = ",".join(str(c) for c in range(1000, 10_000))
    assert (1000, 2, 1000, 9000, 0, 1, 8999, hashlib.sha256(ends.encode()).hexdigest()) in found
    assert max(r[1] for r in found) == len(convs[5])


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "us", "er"), (2, 0, "user", ""), (3, 0, "", "user")]
    assert sum(r[1] == 1 for r in got(trie(spark, rows))) == 3


def test_empty_tables_and_other_columns(spark):
    assert trie(spark, []).count() == 0
    docs = spark.createDataFrame([(1, 0, "user", "a", 5, b"x")], SCHEMA + ", n long, turns binary")
    assert got(prefix_trie.nodes(written(prefix_trie.packed(docs), "convs"))) == plain_trie({1: ((b"user", b"a"),)})


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_prefix_trie(spark, folder)) == plain_trie(rebuilt(plain_convs(rows)))
