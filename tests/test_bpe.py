"""Batched distributed BPE equals one-merge-at-a-time BPE; encode equals tiktoken."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import bpe
from quarry.operators.pretokenize import pretoken_counts


def sequential_bpe(words: dict[tuple[int, ...], int], n_merges: int) -> list[tuple[int, int]]:
    """Brute force: count all adjacent pairs, merge the best (count desc, left, right)."""
    merges, next_id = [], 256
    words = dict(words)
    for _ in range(n_merges):
        counts = {}
        for w, n in words.items():
            for a, b in zip(w, w[1:]):
                counts[(a, b)] = counts.get((a, b), 0) + n
        if not counts:
            break
        (a, b), _ = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
        merges.append((a, b))
        new = {}
        for w, n in words.items():
            out, i = [], 0
            while i < len(w):
                if i + 1 < len(w) and w[i] == a and w[i + 1] == b:
                    out.append(next_id)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + n
        words = new
        next_id += 1
    return merges


def random_corpus(seed: int) -> list[tuple[str, int]]:
    rng = random.Random(seed)
    alphabet = "abcd"
    words = {}
    for _ in range(rng.randint(5, 40)):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 8)))
        words[w] = words.get(w, 0) + rng.randint(1, 5)
    words["aaaa"] = words.get("aaaa", 0) + rng.randint(1, 4)   # equal-symbol pairs
    return sorted(words.items())


@pytest.mark.parametrize("seed", range(6))
def test_batched_equals_sequential(spark, seed):
    corpus = random_corpus(seed)
    counts = spark.createDataFrame(corpus, "piece string, n long")
    expect = sequential_bpe({tuple(w.encode()): n for w, n in corpus}, 25)
    for top_k, inc in ((3, True), (4096, True), (4096, False)):   # small top_k: unseen-pair bound
        tok = bpe.train_bpe(spark, None, vocab_size=256 + 4 + 25, counts=counts, top_k=top_k, incremental=inc)
        assert tok.merges == expect[:len(tok.merges)]
        assert len(tok.merges) == len(expect)


def test_select_batch_rules():
    # disjoint, strictly above every touching pair → batched
    ranked = [(1, 2, 10), (3, 4, 9), (2, 5, 5), (6, 7, 4)]
    assert bpe.select_batch(ranked, True) == [(1, 2, 10), (3, 4, 9)]      # (2, 5) touches the batch
    # a pair touching the batch with an equal count stops the batch
    assert bpe.select_batch([(1, 2, 10), (3, 4, 9), (2, 5, 9)], True) == [(1, 2, 10)]
    # (a, a) ends its batch
    assert bpe.select_batch([(1, 1, 10), (3, 4, 9)], True) == [(1, 1, 10)]


def test_wide_batches_equal_sequential_on_real_text(spark):
    """Many merges a round on documents, with few candidates so that the ranking is refilled often."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40)
    counts = pretoken_counts(docs).persist()
    words = {tuple(r["piece"].encode()): r["n"] for r in counts.collect()}
    expect, sizes = sequential_bpe(words, 220), []
    for top_k in (40, 100_000):
        tok = bpe.train_bpe(spark, None, vocab_size=256 + 4 + 220, counts=counts, top_k=top_k,
                            log=lambda r, m, b: sizes.append(len(b)))
        assert tok.merges == expect
    assert max(sizes) > 5 and len(sizes) < 220                # rounds merge several pairs


def test_runs_of_one_symbol(spark):
    corpus = [("a" * n, n) for n in range(1, 40)] + [("ab" * 7, 3), ("aab" * 5, 2), ("é" * 9, 4)]
    counts = spark.createDataFrame(corpus, "piece string, n long")
    expect = sequential_bpe({tuple(w.encode()): n for w, n in corpus}, 60)
    assert bpe.train_bpe(spark, None, vocab_size=256 + 4 + 60, counts=counts).merges == expect


def test_words_run_out(spark):
    """Fewer merges than asked for, when every word is one symbol in the end."""
    counts = spark.createDataFrame([("ab", 2), ("c", 5), ("", 1)], "piece string, n long")
    assert bpe.train_bpe(spark, None, counts=counts).merges == [(97, 98)]
    with pytest.raises(ValueError):
        bpe.train_bpe(spark, None, counts=counts.where("false"))


def test_ids_equal_tiktoken_on_a_whole_table(spark):
    """H5 and H6 by value: every document of the table, special strings as ordinary text."""
    tiktoken = pytest.importorskip("tiktoken")
    from quarry.constants import BOS_TOKEN, SPECIAL_TOKENS, SPLIT_PATTERN
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    docs = docs.unionByName(spark.createDataFrame([(f"a {BOS_TOKEN} b{t}",) for t in SPECIAL_TOKENS] + [("",), (" \u3000\n",)], "text string"))
    tok = bpe.train_bpe(spark, docs.limit(300), vocab_size=600)
    enc = tiktoken.Encoding(name="t", pat_str=SPLIT_PATTERN, mergeable_ranks=tok.ranks(), special_tokens={})
    rows = bpe.encode(bpe.encode(docs, tok), tok, out="with_bos", prepend_bos=True).collect()
    assert len(rows) == 1006
    for r in rows:
        assert r["ids"] == enc.encode_ordinary(r["text"]) and r["with_bos"] == [tok.bos_id, *r["ids"]]


def test_bytes_of_and_roundtrip(spark):
    from quarry.constants import ROUNDTRIP_SAMPLE
    df = spark.createDataFrame([(ROUNDTRIP_SAMPLE,), ("naïve café 123456",), ("\t tab\r\n",)], "text string")
    got = [r[0] for r in df.select(bpe.bytes_of(F.col("text"))).collect()]
    assert got[0] == list(ROUNDTRIP_SAMPLE.encode())
    tok = bpe.train_bpe(spark, df, vocab_size=256 + 4 + 20)
    rt = bpe.roundtrip_check(df, tok).collect()
    assert all(r["roundtrip_ok"] for r in rt)


def test_encode_matches_tiktoken(spark):
    tiktoken = pytest.importorskip("tiktoken")
    from quarry.constants import SPLIT_PATTERN, SPECIAL_TOKENS
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    tok = bpe.train_bpe(spark, docs, vocab_size=256 + 4 + 40)
    enc = tiktoken.Encoding(name="t", pat_str=SPLIT_PATTERN, mergeable_ranks=tok.ranks(),
                            special_tokens={s: tok.special_id(s) for s in SPECIAL_TOKENS})
    rows = bpe.encode(docs.limit(30), tok).collect()
    for r in rows:
        assert r["ids"] == enc.encode_ordinary(r["text"])
    # H4 quirk: a lone continuation byte decodes to U+FFFD, three bytes
    assert bpe.decoded_len(bytes([0x80])) == 3 and bpe.decoded_len(b"A") == 1


def test_pretoken_pieces_equal_python_regex(spark):
    regex = pytest.importorskip("regex")
    from quarry.constants import SPLIT_PATTERN
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    got = {r["piece"]: r["n"] for r in pretoken_counts(docs).collect()}
    exp = {}
    for (t,) in docs.collect():
        for p in regex.findall(SPLIT_PATTERN, t):
            exp[p] = exp.get(p, 0) + 1
    assert got == exp


def test_save_and_load_tokenizer(spark, tmp_path):
    from quarry.sources.vocab_io import load_tokenizer, save_tokenizer
    tok = bpe.Tokenizer(merges=[(104, 101), (256, 108), (32, 116)])
    save_tokenizer(spark, tok, str(tmp_path / "tok"))
    back = load_tokenizer(spark, str(tmp_path / "tok"))
    assert back.merges == tok.merges and back.bos_id == tok.bos_id
    v = spark.read.parquet(str(tmp_path / "tok" / "vocab"))
    assert v.count() == tok.vocab_size and v.where("is_special").agg({"n_bytes": "max"}).first()[0] == 0
