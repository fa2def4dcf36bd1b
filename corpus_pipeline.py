"""The training-data pipeline: five stages from ``documents`` to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns are treated
as the operators say; a stage adds: extra columns pass through, and a document whose every word
was boilerplate goes in line dedup."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry.llm import bpe, line_spread, mixing, near_dup, toxicity  # noqa: E402
from quarry.llm.common import fresh, written  # noqa: E402
from quarry.llm.q_bpe import RANKS  # noqa: E402
from quarry.llm.q_mixing import WEIGHTS, labelled  # noqa: E402
from quarry.llm.q_toxicity import learned  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under their language's threshold."""
    net = learned(spark, sf_dir)
    at = fresh(docs, "score")
    rows = toxicity.score(docs, net, keep=tuple(docs.columns), out=at)
    return rows.where(F.col(at) < toxicity.threshold(net)).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; those that had nothing else go, empty ones stay."""
    rows = line_spread.remove_boilerplate(docs, long_lines=line_spread.LONG_LINES)
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    rows = rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                           .otherwise(F.col("n_chars")))
    return rows.where(~F.coalesce(emptied, F.lit(False))).select(*[c for c in docs.columns if c in rows.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of texts, once; rows of one id with unrelated
    texts and documents without an id stay."""
    return near_dup.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by rates from one to ``mixing.MAX_RATE``, so that the languages' expected
    tokens come to the target weights and no document is lost; a language that would need more copies
    stays short of its weight, which is logged."""
    rows, _, _, _ = mixing.mix(docs, labelled(spark, sf_dir), WEIGHTS, budget="keep", keep=list(docs.columns), floor=1.0,
                               limit=mixing.MAX_RATE)
    return mixing.repeat_by_rate(rows).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, token_ids, n_tokens`` and digests of the ids and of the bytes they decode to."""
    model = bpe.load_model(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.digests(bpe.encode_and_decode(docs, model), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]

# A trained network and iterative fits: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"stage-{name}")
    return docs
