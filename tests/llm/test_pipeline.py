"""The pipeline against the same stages in plain Python."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from remitlens.llm import queries
from remitlens.llm.common import tokenizer_file
from tests.llm.samples import texts
from tests.llm.test_exact import plain
from tests.llm.test_quality_rules import verdicts
from tests.llm.test_secret_scan import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def redacted(text):
    out, at = "", 0
    for start, _, _, end in plain_spans(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


@pytest.fixture(scope="module")
def expected(spark):
    """Texts by doc_id after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    judged = verdicts(docs)
    stages = [{d.doc_id: d.text for d in docs if judged[d.doc_id][0]}]
    least = {}
    for i, t in sorted(stages[-1].items()):
        least.setdefault(plain(t), i)
    stages.append({i: stages[-1][i] for i in least.values()})
    groups = plain_components([(i, plain_fingerprint(t)) for i, t in stages[-1].items()])
    stages.append({i: stages[-1][i] for i, _, c in groups if i == c})
    stages.append({i: redacted(t) for i, t in stages[-1].items()})
    return stages


def test_every_stage(spark, expected):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = given
    for (_, stage), want in zip(corpus_pipeline.STAGES, expected, strict=False):
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == given.columns and docs.dtypes == given.dtypes
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
        assert all(r.n_chars == len(r.text) for r in rows)
        docs = spark.createDataFrame(rows, given.schema)


def test_run(spark, expected):
    library = Tokenizer.from_file(tokenizer_file(queries.PACKING_TOKENIZER))
    want = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in expected[-1].items()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(want)
    at, used = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = want[r.doc_id]
        assert r.start == at.get(r.doc_id, 0) and r.doc_tokens == len(ids)
        at[r.doc_id] = r.start + r.length
        assert r.ids_crc32 == zlib.crc32(ids[r.start : at[r.doc_id]].tobytes())
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert at == {i: len(ids) for i, ids in want.items()} and max(used.values()) <= 4096


def test_odd_rows_and_no_rows(spark):
    found = [(i if i % 9 else None, t, "en" if i % 2 else None, None, None if t is None else len(t)) for i, t in enumerate(texts())]
    odd = spark.createDataFrame(found + found[:7], "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            rows = docs.collect()
            docs = spark.createDataFrame(rows, docs.schema)
        assert "sequence_id" in docs.columns


def test_no_part_of_a_private_key_is_packed(spark):
    prose = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("lang = 'en' and n_chars > 3000").first()
    body = [f"{n:02d}" + "Ab+/9" * 12 + "xY" for n in range(20)]
    text = "\n".join([prose.text, "-----BEGIN PRIVATE KEY-----", *body, "-----END PRIVATE KEY-----", "The end."])
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    row = dict(corpus_pipeline.STAGES)["secret_scans"](spark, docs, FOLDER).first()
    assert row.text == redacted(prose.text + "\n") + "[SECRET]\nThe end." and row.n_chars == len(row.text)
