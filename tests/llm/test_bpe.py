from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from candela.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(reference, docs):
    r, own = random.Random(2), bpe.encoder(PATH, PATTERN)
    texts = ["", "  a  b ", "a \n b\n\n c", "'s 's it's 'S", "x" * 5000, "ab" * 3000, " \t \n" * 50, "日本語 🎉🎉 ñ x  y", "<|endoftext|>", "\0\1 \x0b"]
    texts += ["".join(r.choice("abcde '\n1 2.,-éß 日 ") for _ in range(r.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(r.choice("etaoinsrh") for _ in range(r.randint(1, 80))) for _ in range(2000)]
    for text in [*texts, *[d.text for d in docs.select("text").collect()]]:
        ids = own.encode(text)
        assert ids.tolist() == reference.encode_ordinary(text), text[:80]
        assert own.decode(ids) == text.encode()


def test_rows(odd, none, reference):
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    rows = bpe.round_trip(odd, PATH, PATTERN).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id is not None:
            ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4")
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(none, PATH, PATTERN).count() == 0


def test_encode_and_decode_columns(odd, none):
    coded = bpe.encode(odd, PATH, PATTERN)  # the clashing column is replaced
    back = bpe.decode(coded, PATH, PATTERN).collect()
    assert len(back) == odd.count() and all(bytes(r.decoded).decode() == (r.text or "") for r in back)
    assert bpe.encode(none, PATH, PATTERN).count() == 0
