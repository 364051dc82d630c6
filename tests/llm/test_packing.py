"""Packing against the tokenizers library and the rules of a layout."""

import os
import random
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from remitlens.llm import packing, queries
from remitlens.llm.common import tokenizer_file
from remitlens.llm.cutting_stock import best_pattern, cutting_stock, inverse_of
from tests.llm.samples import texts

FILE = queries.PACKING_TOKENIZER


def check(rows, given, length=4096):
    """Every id in one piece, gapless sequences of at most ``length``."""
    library = Tokenizer.from_file(tokenizer_file(FILE))
    ids = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 2] for t in given))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return ids, by_doc, by_sequence


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [r.asDict() for r in queries.op2_packing(spark, folder).collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    library = Tokenizer.from_file(tokenizer_file(FILE))
    _, by_doc, by_sequence = check(rows, [])
    assert set(by_doc) == set(docs)
    total = 0
    for doc_id, text in docs.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    assert len(by_sequence) <= 1.02 * total / 4096 + 2


def test_odd_texts_and_repeats(spark):
    given = [(i if i % 7 else None, t) for i, t in enumerate(texts())]
    found = packing.pieces(spark.createDataFrame(given, "doc_id long, text string").repartition(5), FILE, length=64, step=4)
    placed = packing.place(found, length=64, step=4)
    rows = [r.asDict() for r in placed.collect()]
    ids, *_ = check(rows, [t for _, t in given], 64)
    whole = b"".join(np.array(i, "<u4").tobytes() for i in ids)
    assert sorted(np.frombuffer(b"".join(r["ids"] for r in rows), "<u4")) == sorted(np.frombuffer(whole, "<u4"))
    joined = {r.sequence_id: (bytes(r.ids), list(r.offsets)) for r in packing.sequences(placed).collect()}
    for r in rows:
        text, offsets = joined[r["sequence_id"]]
        assert text[4 * r["offset"] :][: 4 * r["length"]] == bytes(r["ids"]) and r["offset"] in offsets


def test_no_rows(spark):
    found = packing.pieces(spark.createDataFrame([], "doc_id long, text string"), FILE)
    assert packing.place(found).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_patterns_hold_the_demand(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    demand = {int(s): int(n) for s, n in zip(rng.integers(1, capacity + 1, 12), rng.integers(1, 5000, 12), strict=True)}
    patterns = cutting_stock(demand, capacity)
    held = defaultdict(int)
    for pattern, times in patterns:
        assert sum(s * n for s, n in pattern.items()) <= capacity and times > 0
        for s, n in pattern.items():
            held[s] += times * n
    assert held == demand
    bins, least = sum(t for _, t in patterns), sum(s * n for s, n in demand.items()) / capacity
    big = sum(n for s, n in demand.items() if 2 * s > capacity)
    assert bins >= max(least, big) and bins <= 1.5 * max(least, big) + 20


def test_knapsack_takes_the_best():
    value, counts = best_pattern(np.array([3, 4, 7]), np.array([0.3, 0.41, 0.7]), 11)
    assert value == pytest.approx(1.12) and list(counts) == [1, 2, 0]


def test_few_bins_where_patterns_matter():
    # Sizes that fill bins only as 5 + 3 + 2 and 6 + 4.
    patterns = cutting_stock({5: 1000, 3: 1000, 2: 1000, 6: 500, 4: 500}, 10)
    assert sum(t for _, t in patterns) == 1500


def test_words_have_the_ids_of_the_text():
    library, ours = Tokenizer.from_file(tokenizer_file(FILE)), packing.WordEncoder(FILE)
    rng = random.Random(9)
    parts = ["The", "it's", "'S", "don't", "é", "é", "İ", "Σ", "ß", "ǆ", ".", "...", "&&&", "'", '"', "<", "<|endoftext|>", "<|ENDOFTEXT|>", "|", "12", "½", "日本", " ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "́", "😀", "x", "K", "Ⅷ"]
    found = [*texts(), *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000))]
    got = [ids for _, part in packing.slices(pa.array(found), 20_000) for ids in ours.encode(part)]
    for text, ids in zip(found, got, strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_many_classes_beside_a_session(spark, tmp_path):
    """The driver must end: in a process of its own, so that a hang is a failure and not the end of all tests."""
    script = tmp_path / "classes.py"
    script.write_text(
        "import random\n"
        "from remitlens.llm.cutting_stock import cutting_stock\n"
        "from remitlens.session import local_session\n"
        "spark = local_session(2, '1g')\n"
        "spark.range(10).count()\n"
        "rng = random.Random(4)\n"
        "demand = {size: int(20000 / size) + rng.randint(1, 50) for size in range(1, 257)}\n"
        "found = cutting_stock(demand, 256)\n"
        "held = {}\n"
        "for pattern, times in found:\n"
        "    assert sum(s * n for s, n in pattern.items()) <= 256 and times > 0\n"
        "    for s, n in pattern.items():\n"
        "        held[s] = held.get(s, 0) + n * times\n"
        "assert held == demand\n"
        "tokens = sum(s * n for s, n in demand.items())\n"
        "assert sum(times for _, times in found) <= 1.02 * tokens / 256 + 256\n"
        "print('whole')\n"
    )
    env = {k: v for k, v in os.environ.items() if not k.endswith("_NUM_THREADS")}
    env["PYTHONPATH"] = os.pathsep.join([os.getcwd(), env.get("PYTHONPATH", "")])
    done = subprocess.run([sys.executable, str(script)], env=env, capture_output=True, text=True, timeout=150)
    assert done.stdout.strip().endswith("whole"), done.stderr[-2000:]


def test_an_early_end_only_costs_bins():
    demand = {size: 40 + size % 7 for size in range(3, 60)}
    for steps in (0, 1, 5):
        held = defaultdict(int)
        for pattern, times in cutting_stock(demand, 64, steps=steps):
            for size, n in pattern.items():
                held[size] += n * times
        assert held == demand


def test_inverse():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30):
        matrix = rng.integers(0, 5, (n, n)) + np.eye(n)[::-1] * 9
        found = inverse_of(matrix)
        assert np.abs(np.einsum("ij,jk->ik", matrix, found) - np.eye(n)).max() < 1e-9
