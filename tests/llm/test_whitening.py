"""Whitening against exact integers and against numpy on all rows at once."""

import json
import math
import os
import subprocess
import sys
from fractions import Fraction

import numpy as np
import pytest

from remitlens.llm import queries, whitening
from remitlens.session import written

SCHEMA = "vec_id long, embedding array<float>, label int"


def eigh(matrix):
    """In a process of its own with one thread: threaded routines may hang beside a session."""
    code = "import json, sys, numpy as np; v, w = np.linalg.eigh(np.array(json.load(sys.stdin))); print(json.dumps([v.tolist(), w.tolist()]))"
    done = subprocess.run(
        [sys.executable, "-c", code], input=json.dumps(matrix.tolist()), env=os.environ | {"OPENBLAS_NUM_THREADS": "1"},
        capture_output=True, text=True, timeout=60, check=True,
    )
    return [np.array(part) for part in json.loads(done.stdout)]


def checked(rows, given, most=8):
    """``given``: id and vector of the usable rows."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in given]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [[Fraction(n * v - s, n) for v, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array([[float(v) for v in row] for row in exact])
    values, vectors = eigh(np.einsum("ri,rj->ij", centred, centred) / n)
    order = np.argsort(-values)
    rank = sum(v > len(values) * np.finfo(float).eps * values.max() for v in values)
    parts = min(most, rank)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    assert len(rows) == n * parts and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-9
    deviation = {}
    for (key, _), row in zip(given, x, strict=True):
        deviation.setdefault(key, []).append(sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)))
    for key, own in by_id.items():
        assert sorted(r.deviation for r in own) == sorted(deviation[key] * parts)
    for k in range(parts):
        e = values[order[k]]
        got = [r for r in rows if r.component == k + 1]
        assert all(abs(r.explained - e / values.sum()) <= 1e-9 for r in got)
        gaps = np.abs(np.delete(values, order[k]) - e).min() if len(values) > 1 else 1
        if gaps > 1e-6 * e:
            plain = (centred * vectors[:, order[k]]).sum(1) / np.sqrt(e)
            mine = {}
            for r in got:
                mine.setdefault(r.vec_id, []).append(r.whitened)
            pairs = [(mine[key][0], v) for (key, _), v in zip(given, plain, strict=True) if len(mine[key]) == 1]
            sign = math.copysign(1, sum(a * b for a, b in pairs))
            assert all(abs(sign * a - b) < 1e-6 for a, b in pairs)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    usable = [(i, v) for i, v in given if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    checked(queries.op12_whitening(spark, folder).collect(), usable)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=3) * [1, 5, 0.1]]) for i in range(200)] + [(7, [0.0, 1.0, 2.0]), (None, [0.0, -1.0, 2.0])]
    bad = [(500, None), (501, [1.0, None, 2.0]), (502, [1.0, float("nan"), 2.0]), (503, [1.0, float("inf"), 2.0]), (504, []), (505, [1.0, 2.0]), (506, [1e30, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in good + bad], SCHEMA).repartition(4)
    rows = whitening.whitened_rows(frame, frame["vec_id"]).collect()
    # Fewer dimensions than components.
    assert {r.component for r in rows} == {1, 2, 3}
    checked(rows, good)


@pytest.mark.parametrize("spread", [1.0, 3e4, 2e7])
def test_large_entries_stay_exact(spark, spread):
    rng = np.random.default_rng(6)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=4) * spread]) for i in range(50)]
    rows = written(whitening.usable(spark.createDataFrame([(i, v, 1) for i, v in good], SCHEMA).drop("label")), "rows")
    fitted = whitening.fit(rows)
    x = {i: [math.floor(1024 * c) + 100000 for c in v] for i, v in good}
    sums = [sum(c) for c in zip(*x.values(), strict=True)]
    assert fitted.sums == tuple(sums) and fitted.n == 50
    for r in whitening.whiten(rows, fitted).collect():
        assert r.deviation == sum((50 * v - s) ** 2 for v, s in zip(x[r.vec_id], sums, strict=True))
    centred = np.array([[float(Fraction(50 * v - s, 50)) for v, s in zip(row, sums, strict=True)] for row in x.values()])
    values = eigh(np.einsum("ri,rj->ij", centred, centred) / 50)[0][::-1]
    assert np.allclose(fitted.variances, values, rtol=1e-10)


def test_pairs_of_squares():
    z = np.random.default_rng(1).integers(-(1 << 20), 1 << 20, (300, 5))
    found = whitening._exact_squares(z)
    assert (found == whitening._exact_squares(z.astype(object))).all()
    for i in range(5):
        for j in range(i, 5):
            assert found[i, j] == sum(int(a + b if j > i else a) ** 2 for a, b in z[:, [i, j]].tolist())


def test_no_rank_and_no_rows(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)] * 3):
        frame = spark.createDataFrame(rows, SCHEMA)
        assert whitening.whitened_rows(frame, frame["vec_id"]).collect() == []


def test_rank_one_and_clashing_names(spark):
    given = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]
    rows = spark.createDataFrame([(i, v, "d") for i, v in given], "vec_id long, x array<float>, deviation string")
    found = whitening.whitened_rows(rows, rows["vec_id"], "x").collect()
    assert {r.component for r in found} == {1}
    checked(found, given)
    kept = whitening.whiten(written(whitening.usable(rows, "x"), "rows"), whitening.fit(written(whitening.usable(rows, "x"), "rows")))
    assert whitening.whiten(written(whitening.usable(rows.withColumnsRenamed({"vec_id": "row"}), "x"), "rows"), whitening.fit(written(whitening.usable(rows, "x"), "rows"))).columns[0] == "row"
    assert kept.columns == ["vec_id", "x", "deviation", "whitened"] and kept.count() == 20
