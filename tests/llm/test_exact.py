"""Exact dedup against plain Python, and its query against its SQL twin."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from remitlens.llm import exact, queries
from tests.compare import differences, given_tables
from tests.llm.samples import texts


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def rows():
    found = [(i, t) for i, t in enumerate(texts())]
    return found + [(i + 500, (t or "").replace(" ", " \t")) for i, t in found[::2]] + found[3:6] + [(None, "one"), (None, "alone, no id"), (None, "alone, no id")]


@pytest.mark.parametrize("buckets", [1 << 20, 4])
def test_groups(spark, monkeypatch, buckets):
    monkeypatch.setattr(exact, "BUCKETS", buckets)
    given = rows()
    got = exact.mark_copies(spark.createDataFrame(given, "doc_id long, text string"), digest=F.sha2("plain", 256)).collect()
    members = {}
    for i, t in given:
        members.setdefault(plain(t), []).append(i)
    want = []
    for text, ids in members.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = ids.index(keep)
        want += [(i, keep, len(ids), n == first, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_row_of_each_text_stays(spark):
    given = [(i, t, "b", 1) for i, t in rows()] + [(i, t, "a", None) for i, t in rows()]
    docs = spark.createDataFrame(given, "doc_id long, text string, full string, bucket int")  # names the operator uses
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    found = {}
    for i, t, *_ in given:
        found.setdefault(plain(t), []).append(i)
    want = {text: min((i for i in ids if i is not None), default=None) for text, ids in found.items()}
    assert {plain(r.text): r.doc_id for r in kept.collect()} == want and kept.count() == len(want)
    assert {r.full for r in kept.collect()} == {"a"}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact.mark_copies(docs).count() == 0 and exact.drop_copies(docs).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    df = queries.op3_exact_dedup(spark, folder)
    assert differences(df, given_tables(folder), queries.oracle_sql()["op3_exact_dedup"]) is None
