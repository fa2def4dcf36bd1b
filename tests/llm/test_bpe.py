"""op3: against the rank library, exact round trips, edge cases."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from quarry.llm import bpe
from quarry.llm.q_bpe import RANKS, op3_byte_bpe
from quarry.session import read_table

from .conftest import ODD_TEXTS, by_id

sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path(RANKS))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_the_library(spark, sf, library):
    got = by_id(op3_byte_bpe(spark, sf).collect())
    docs = read_table(spark, sf, "documents", "doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        assert tuple(got[d["doc_id"]])[1:] == (len(ids), sha(",".join(map(str, ids)).encode()), sha((d["text"] or "").encode()))


def test_fuzz(ranks, library):
    model = bpe.build_model(ranks, P.PATTERN)
    e, d = bpe.Encoder(model), bpe.Decoder(model)
    r = random.Random(5)
    chars = " \n\t\r\x1c\x85  'sletréñ12٣#$́😀漢ab\x00᠎​﻿"
    for _ in range(3000):
        s = "".join(r.choice(chars) for _ in range(r.randint(0, 30)))
        ids = np.frombuffer(e.encode(s), "<i4").tolist()
        assert ids == library.encode_ordinary(s)
        assert d.decode(ids).decode() == s


def test_unreachable_entries_are_whole_words():
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256}       # no merge leads to abc
    m = bpe.build_model(ranks, P.PATTERN)
    assert m.unreachable == {b"abc": 256}
    e = bpe.Encoder(m)
    assert np.frombuffer(e.encode("abc abcd"), "<i4").tolist() == tiktoken.Encoding(
        "x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary("abc abcd")


def test_edges(spark, odd, empty, library):
    model = bpe.load_model(spark, P.path(RANKS), P.PATTERN)
    rows = bpe.decode(bpe.encode(odd, model), model).collect()
    assert len(rows) == odd.count()
    got = by_id(rows)
    for i, t in enumerate(ODD_TEXTS):
        assert got[i]["token_ids"] == library.encode_ordinary(t or "")
        assert bytes(got[i]["decoded"]) == (t or "").encode()
    assert bpe.decode(bpe.encode(empty, model), model).count() == 0
