"""op4: against the library, random access to sequences and masks, edge cases."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quarry.llm import token_files as tf
from quarry.llm.q_tokens import END_ID, TOKENIZER, op4_token_files
from quarry.session import read_table

from .conftest import ODD_TEXTS


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(P.path(TOKENIZER))            # as it is
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def spec(spark):
    return spark.sparkContext.broadcast(open(P.path(TOKENIZER), encoding="utf-8").read())


def test_query_equals_the_library(spark, sf, library):
    got = {r["doc_id"]: tuple(r)[1:4] for r in op4_token_files(spark, sf).collect()}
    start = 0
    docs = read_table(spark, sf, "documents", "doc_id", "text").orderBy("doc_id").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library(d["text"]) + [END_ID]
        assert got[d["doc_id"]] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_fuzz(library):
    e = tf.WordEncoder(open(P.path(TOKENIZER), encoding="utf-8").read(), "<u2")
    r = random.Random(3)
    chars = " \n\t\r\x1c\x85  'streldmv.,;!?_½²9٣É́ΣİJ̌ǰ😀漢\x00<|endoftext|>aB"
    docs = ["".join(r.choice(chars) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    assert [np.frombuffer(b, "<u2").tolist() for b in e.encode(docs)] == [library(d) for d in docs]


def test_sequences_masks_and_spans(spark, odd, spec, library):
    folder = tf.new_folder(spark)
    manifest = tf.write_tokens(odd, folder, spec, END_ID, seq_len=64, batch_rows=4)
    rows = tf.with_global_start(tf.read_documents(spark, folder, manifest), manifest).collect()
    assert len(rows) == odd.count()
    stream = []
    for shard in sorted({r["shard"] for r in rows}):
        s = tf.Shard(folder, shard)
        n = sum(s.tokens.get_batch(i).num_rows for i in range(s.tokens.num_record_batches))
        ids, masks = zip(*(s.sequence(i) for i in range(n)))
        assert all(len(x) == 64 == len(m) for x, m in zip(ids, masks))
        ids, mask = np.concatenate(ids), np.concatenate(masks)
        assert mask[:mask.sum()].all()                              # padding only at the end
        assert (s.span(0, int(mask.sum())) == ids[mask]).all()
        assert not s.sequence(0)[0].flags.owndata                    # a view of the file
        stream += ids[mask].tolist()
    rows.sort(key=lambda r: r["start"])
    for r in rows:
        if r["doc_id"] is not None:
            assert stream[r["start"]:r["start"] + r["n_tokens"]] == library(ODD_TEXTS[r["doc_id"]]) + [END_ID]
    assert [r["doc_id"] for r in rows] == [None, None, 0, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert sum(r["n_tokens"] for r in rows) == len(stream)


def test_empty(spark, empty, spec):
    folder = tf.new_folder(spark)
    manifest = tf.write_tokens(empty, folder, spec, END_ID)
    assert tf.with_global_start(tf.read_documents(spark, folder, manifest), manifest).count() == 0


def test_special_strings_are_one_id(library):
    enc = tf.WordEncoder(open(P.path(TOKENIZER), encoding="utf-8").read(), "<u2")
    a, b = "<|startoftext|>", "<|endoftext|>"
    texts = [a, f"x{a}y", f"it{a}'s  {b}{b}\n{a} end.{b}.", "<|EndOfText|> <|endoftext", f"İ{b}e\u0301 {b.upper()}", f"<{b}>", f"<|{b}|>",
             f"don{b}'t 12{a}34", f"{a.replace('|', '')} {b[:-1]} {b[1:]}", f" {b} ", f"a\0{b}\0b"] + [b.join(["w."] * 300)]
    r = random.Random(3)
    pieces = [a, b, " ", "\n", "ab", "Cd.", "'s", "é", "1", "<|", "|>", "\0"]
    texts += ["".join(r.choice(pieces) for _ in range(r.randrange(12))) for _ in range(300)]
    for _ in range(2):                                         # the second time from the cache
        for t, ids in zip(texts, enc.encode(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == library(t)
