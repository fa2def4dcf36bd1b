"""The tokenizer kept as two parquet tables (merges M7, vocabulary M6) instead of a
pickle; both are bounded by the vocabulary size."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from quarry.operators.bpe import Tokenizer, merges_frame, tokenizer_from_frames, vocab_frame


def save_tokenizer(spark: SparkSession, tok: Tokenizer, root: str, mode: str = "errorifexists") -> None:
    merges_frame(spark, tok).coalesce(1).write.mode(mode).parquet(os.path.join(root, "merges"))
    vocab_frame(spark, tok).coalesce(1).write.mode(mode).parquet(os.path.join(root, "vocab"))


def load_tokenizer(spark: SparkSession, root: str) -> Tokenizer:
    return tokenizer_from_frames(spark.read.parquet(os.path.join(root, "merges")))
