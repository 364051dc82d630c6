"""The quality classifier: held-out accuracy, and the shrinking of places against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.llm import quality_model as qm
from remitlens.llm import queries
from remitlens.llm.common import table
from tests.llm.samples import texts

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, FOLDER, "documents"), qm.good_labels(table(spark, FOLDER, "labels"))
    classifier = qm.fit(docs, labels, most=2000)
    used = qm.sampled(labels, 2000).select("doc_id")
    rest = labels.join(used, "doc_id", "left_anti")
    # The places' means may only know the labels that the fit has seen.
    judged = qm.judge(docs, labels.join(used, "doc_id", "left_semi"), F.col("source"), F.col("lang"), classifier)
    got = {(r.good, r.kept): r["count"] for r in judged.join(rest, "doc_id").groupBy("good", "kept").count().collect()}
    assert got.get((1, False), 0) <= 0.01 * got[1, True] and got.get((0, True), 0) <= 0.1 * got[0, False]
    assert sum(got.values()) > 1500


def test_query_keeps_every_row(spark):
    rows = queries.op6_quality_model(spark, "/root/testdata/sf0.001").collect()
    ids = [r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids) and all(0 <= r.posterior <= 1 for r in rows)


def strength(places):
    n = sum(p[0] for p in places)
    chance = sum(k * m * (1 - m) for k, _, m in places) / n
    between = sum(k * (s / k - m) ** 2 for k, s, m in places) / n
    return min(max(chance / max(between - chance * len(places) / n, 1e-9) - 1, 1.0), 1e6)


def test_places(spark):
    rng = random.Random(3)
    flat = qm.Classifier({}, np.zeros(qm.SHARES + 1), np.zeros(qm.SHARES), np.ones(qm.SHARES))
    rows, labels = [], []
    for i in range(600):
        host = rng.choice(["good", "bad", "mixed", None])
        path = rng.choice(["a", "b", None])
        rows.append((i, "text", host, path, 1))
        chance = {"good": 0.95, "bad": 0.1, "mixed": 0.9 if path == "a" else 0.3, None: 0.5}[host]
        if rng.random() < 0.6:
            labels.append((i, int(rng.random() < chance)))
    rows += [(1000, "text", "rare", "x", 1), rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string, y int")
    got = qm.judge(docs, spark.createDataFrame(labels, "doc_id long, good int"), F.col("host"), F.col("path"), flat).collect()
    y = [dict(labels).get(r[0], 0.5) for r in rows]
    sums, hosts = {}, {}
    for r, v in zip(rows, y, strict=True):
        for held, key in ((sums, (r[2], r[3])), (hosts, r[2])):
            n, s = held.get(key, (0, 0))
            held[key] = (n + 1, s + v)
    mean = sum(y) / len(y)
    m = strength([(n, s, mean) for n, s in hosts.values()])
    host_mean = {h: (s + m * mean) / (n + m) for h, (n, s) in hosts.items()}
    k = strength([(n, s, host_mean[h]) for (h, _), (n, s) in sums.items()])
    want = []
    for r, v in zip(rows, y, strict=True):
        n, s = hosts[r[2]]
        host = (s - v + m * mean) / (n - 1 + m)
        n, s = sums[r[2], r[3]]
        path = (s - v + k * host) / (n - 1 + k)
        shift = math.log(path / (1 - path)) - math.log(mean / (1 - mean))
        want.append((r[0], host, path, 1 / (1 + math.exp(-shift))))
    for a, b in zip(sorted((r.doc_id, r.host_posterior, r.path_posterior, r.posterior) for r in got), sorted(want), strict=True):
        assert a == pytest.approx(b, rel=1e-6)
    rare = next(r for r in got if r.doc_id == 1000)
    assert rare.path_posterior == pytest.approx(mean, abs=0.05)


def test_odd_rows_and_no_labels(spark):
    rows = [(i if i % 5 else None, t, None, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, host string, evidence string")
    none = spark.createDataFrame([], "doc_id long, good int")
    for labels in (none, spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, None)], none.schema)):
        for given in (docs, docs.limit(0)):
            classifier = qm.fit(given, labels)
            assert qm.judge(given, labels, F.col("host"), F.col("evidence"), classifier).count() == given.count()


def test_labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 1), (5, 1, None), (6, None, None)]
    good = qm.good_labels(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert [r.good for r in good.orderBy("doc_id").collect()] == [1, 0, 0, 0, None, None]
