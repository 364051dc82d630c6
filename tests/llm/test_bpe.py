"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from remitlens.llm import bpe, queries
from remitlens.llm.common import slices, tokenizer_file
from tests.llm.samples import texts

FILE = queries.BYTE_TOKENIZER


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(FILE))


def random_texts():
    rng = random.Random(8)
    planes = [(0x20, 0x7E), (0x80, 0x24F), (0x300, 0x36F), (0x400, 0x4FF), (0x2000, 0x206F), (0x4E00, 0x4E40), (0x1F600, 0x1F640), (9, 14), (0x1C, 0x20)]
    for _ in range(300):
        yield "".join(chr(rng.randint(*rng.choice(planes))) for _ in range(rng.randint(1, 60)))


def test_encode_and_decode(library):
    ours = bpe.byte_bpe(FILE)
    for text in [*texts(), *random_texts()]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        got = ours.encode(text or "")
        assert np.frombuffer(got, "<u4").tolist() == ids, repr(text)
        assert ours.decode(got) == library.decode(ids, skip_special_tokens=False) == (text or "")


def test_columns_of_texts(library):
    ours, found = bpe.byte_bpe(FILE), [*texts(), *random_texts(), " a", "a ", "a  b", "a \nb", "a\n b", "a\n\nb c", "x <|endoftext|> y", "<|endoftext|> z"]
    column = pa.array(found)
    got = [ids for size in (1, 50_000) for _, part in slices(column, size) for ids in ours.encode_all(part)]
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in found]
    assert got == 2 * want and ours.encode_all(column.slice(0, 0)) == []


def test_broken_ids(library):
    rng = random.Random(2)
    ours = bpe.byte_bpe(FILE)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(30)]
        assert ours.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_heap_and_scan_agree():
    ours, rng = bpe.byte_bpe(FILE), random.Random(4)
    for _ in range(100):
        word = bytes(rng.choice(b"theinrationlyqz ") for _ in range(rng.randint(1, 200)))
        parts = [ours.byte_id[b] for b in word]
        assert ours._scan(list(parts)) == ours._heap(list(parts))


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_byte_bpe(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got.pop(r.doc_id) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))
    assert not got


def test_columns(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b")], "ids long, text string")
    rows = docs.select("ids", bpe.encode(docs.text, FILE).alias("x")).select("ids", "x", bpe.decode(F.col("x"), FILE).alias("t")).collect()
    both = docs.select("ids", bpe.round_trip(docs.text, FILE).alias("x")).select("ids", "x.ids", "x.decoded").collect()
    assert [tuple(r) for r in both] == [tuple(r) for r in rows]
    assert [(r.ids, len(r.x), r.t) for r in rows] == [(1, 0, ""), (2, 0, ""), (None, 8, "a b")]


def test_no_rows(spark):
    docs = spark.createDataFrame([], "ids long, text string")
    assert docs.select("ids", bpe.round_trip(docs.text, FILE).alias("x")).count() == 0
