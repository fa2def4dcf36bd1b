"""End-to-end corpus preparation: sources → union → length (and keyword)
filter → seeded shuffle, split and shards → partitioned parquet.  The corpus counts (C1) are
gathered by ``observe`` during the write, not by extra passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.constants import DOCS_PER_SHARD, MIN_DOC_CHARS
from quarry.operators.corpus import shard_assignment
from quarry.operators.text_ops import filter_keywords_any
from quarry.sources.shards import write_shards
from quarry.sources.tabular import union_sources


def prepare_corpus(sources: dict[str, DataFrame], out: str, key: str = "doc_key",
                   keywords: Sequence[str] | None = None, min_chars: int = MIN_DOC_CHARS,
                   docs_per_shard: int = DOCS_PER_SHARD, mode: str = "errorifexists") -> dict:
    """Write the shards of the combined sources and return the counts of the run."""
    docs = union_sources(sources).where(F.length("text") > min_chars)
    if keywords:
        docs = filter_keywords_any(docs, keywords)
    assigned = shard_assignment(docs, key=["source", key], docs_per_shard=docs_per_shard)
    obs = Observation("corpus")
    write_shards(assigned, out, mode, columns=("text", "source", key), observe=(
        obs, F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("split") == "val").alias("n_val"),
        F.count_if(F.col("split") == "train").alias("n_train"), F.sum(F.octet_length("text")).alias("n_bytes")))
    return dict(obs.get)
