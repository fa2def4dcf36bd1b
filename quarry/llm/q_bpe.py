"""op3: byte-level BPE encoding and decoding of ``documents``."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe
from quarry.llm.registry import register
from quarry.session import read_table

RANKS = "byte_bpe_multi_50k.tiktoken"


@register("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of the ids and of the decoded bytes."""
    model = bpe.load_model(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.digests(bpe.encode_and_decode(read_table(spark, sf_dir, "documents", "doc_id", "text"), model))
