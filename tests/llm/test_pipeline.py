"""The pipeline's stages: columns, effect of the decisions, the whole against its parts."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from quarry.llm import bpe
from quarry.session import read_table

from .conftest import by_id
from .test_near_dup import brute_classes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        f(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "byte_bpe"]
    assert all(s.columns == stages[0].columns for s in stages[1:5])
    assert C.ORACLE_SQL is None


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    kept = stages[1].select("doc_id").withColumn("kept", F.lit(True))
    rows = read_table(spark, SF, "labels", "doc_id", "toxic").join(kept, "doc_id", "left").collect()
    clean = [r["kept"] for r in rows if r["toxic"] == 0]
    toxic = [r["kept"] for r in rows if r["toxic"] == 1]
    assert clean.count(True) >= 0.99 * len(clean) and toxic.count(True) <= 0.25 * len(toxic)


def test_lines_go_but_one_holder_keeps_each(stages):
    before, after = by_id(stages[1].collect()), by_id(stages[2].collect())
    lines = lambda rows: {x.strip(" ") for r in rows.values() for x in (r["text"] or "").split("\n")}
    assert lines(before) == lines(after)
    assert sum(r["n_chars"] for r in after.values()) < sum(r["n_chars"] for r in before.values())
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_one_of_each_group_stays(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    classes = brute_classes(texts)
    assert {r["doc_id"] for r in stages[3].collect()} == set(classes.values())
    assert stages[3].count() == len(set(classes.values()))


def test_mixing_loses_no_document(stages):
    before, after = (s.groupBy("doc_id").count().collect() for s in stages[3:5])
    assert {r["doc_id"] for r in before} == {r["doc_id"] for r in after}
    assert stages[4].count() > stages[3].count()


def test_tokens_equal_the_library(stages):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(C.RANKS)), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r["token_ids"] == enc.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_equals_the_stages(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["ids_sha256"]) for r in df.select("doc_id", "ids_sha256").collect())
    assert key(C.run(spark, SF)) == key(stages[5])


def test_odd_and_empty_inputs(spark, odd, empty, sf):
    for docs, n in ((odd, None), (empty, 0)):
        for _, stage in C.STAGES[:4]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            rows = out.collect()
            assert n is None or len(rows) == n
        assert C.STAGES[4][1](spark, docs, sf).count() == docs.count()
    kept = C.drop_near_duplicates(spark, odd, sf).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert sum(r["doc_id"] is None for r in kept) == 2
