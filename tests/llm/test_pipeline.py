from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from candela.llm import bpe, secrets
from candela.llm.common import DOCUMENT_COLUMNS

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_stages_work_on_what_is_left(spark, sf_dir, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in now.collect()}
        out = stage(spark, now, sf_dir)
        rows = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tuple(out.columns) == DOCUMENT_COLUMNS
        ids = [r.doc_id for r in rows]
        assert set(ids) <= set(before)
        if name == "language_id":
            assert len(ids) >= 0.98 * len(before)
        if name == "near_dedup":
            texts = [" ".join(r.text.lower().split()) for r in rows]
            assert len(ids) == len(set(ids)) and len(texts) == len(set(texts)) > 0.8 * len(before)
        if name == "secret_scan":
            assert sorted(ids) == sorted(before) and not any(secrets.spans(r.text) for r in rows)
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "byte_bpe":
            own = bpe.encoder(PATH, PATTERN)
            assert all(own.encode(r.text).tolist() == r.token_ids for r in rows)
        now = spark.createDataFrame(rows, out.schema)


def test_odd_documents_pass_through(spark, odd, sf_dir):
    now = odd.select(*DOCUMENT_COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf_dir)
        now = spark.createDataFrame(out.collect(), out.schema)
    assert now.count() > 0


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    decoded = bpe.decode(rows, PATH, PATTERN).collect()
    assert decoded and all(bytes(r.decoded).decode() == r.text for r in decoded)
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
