"""Corpus preparation: seeded shuffle, train/val split, shards, budgets, counts
(SURVEY §2.C1, C2, D8, D9, E5, A9, L2).

The seeded shuffle is an order by ``md5(seed:doc_id)`` (stable across machines and equal in
DuckDB); the position in that order comes from ``global_index`` (range-partitioned, no
single-task window)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.constants import (DOCS_PER_SHARD, IBD_KEYWORDS, MIN_DOC_CHARS, MIN_VAL_DOCS,
                              SHUFFLE_SEED, VAL_FRACTION, VAL_SHARD)
from quarry.functions.text import contains_any
from quarry.operators.scan import global_index, prefix_scan


def shuffle_key(key: str | Column = "doc_id", seed: int = SHUFFLE_SEED) -> Column:
    """E5: the seeded order, ``md5('<seed>:<key>')``."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def n_val_docs(n: int, fraction: float = VAL_FRACTION, minimum: int = MIN_VAL_DOCS) -> int:
    return max(minimum, int(n * fraction))


def shard_assignment(docs: DataFrame, key: str | Sequence[str] = "doc_id", seed: int = SHUFFLE_SEED,
                     fraction: float = VAL_FRACTION, minimum: int = MIN_VAL_DOCS,
                     docs_per_shard: int = DOCS_PER_SHARD, val_shard: int = VAL_SHARD) -> DataFrame:
    """The first ``max(50, int(n·0.10))`` documents of the shuffled order are the
    validation split (shard 6542); the rest go to train shards 0, 1, … of ``docs_per_shard``.

    ``key`` (one column or several) identifies a document.  Keys alone are sorted; the other
    columns meet the result in one join, and only if they are asked for."""
    keys = [key] if isinstance(key, str) else list(key)
    tag = shuffle_key(keys[0], seed) if len(keys) == 1 else shuffle_key(F.concat_ws(":", *keys), seed)
    indexed, n = global_index(docs, [tag, *keys], "idx")
    n_val = n_val_docs(n, fraction, minimum)
    is_val = F.col("idx") < F.lit(n_val)
    return (indexed.withColumn("split", F.when(is_val, F.lit("val")).otherwise(F.lit("train")))
                   .withColumn("shard", F.when(is_val, F.lit(val_shard).cast("long")).otherwise(
                       F.floor((F.col("idx") - F.lit(n_val)) / F.lit(docs_per_shard)).cast("long"))))


def stream_split(docs: DataFrame, key: str = "doc_id", seed: int = SHUFFLE_SEED,
                 fraction: float = VAL_FRACTION) -> DataFrame:
    """L2: stateless split for streams: validation when the first 32 bits of the shuffle key
    fall below ``fraction · 2^32``.  Approximately, not exactly, ``fraction`` of the rows."""
    h = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("long")
    return docs.withColumn("split", F.when(h < F.lit(int(fraction * 2 ** 32)), "val").otherwise("train"))


def shard_stats(assigned: DataFrame, text: str = "text") -> DataFrame:
    """Documents and UTF-8 bytes per (split, shard)."""
    return assigned.groupBy("split", "shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.octet_length(text)).cast("long").alias("n_bytes"))


def corpus_counts(docs: DataFrame, text: str = "text", min_chars: int = MIN_DOC_CHARS,
                  phrases=IBD_KEYWORDS, fraction: float = VAL_FRACTION,
                  minimum: int = MIN_VAL_DOCS) -> DataFrame:
    """Documents loaded, long enough, relevant (keyword), and the train/val sizes of the
    long-enough set — one aggregate pass."""
    long_enough = F.length(text) > min_chars
    agg = docs.agg(F.count(F.lit(1)).alias("n_loaded"),
                   F.count_if(long_enough).alias("n_long"),
                   F.count_if(long_enough & contains_any(text, phrases)).alias("n_relevant"))
    n_val = F.greatest(F.lit(minimum).cast("long"), F.floor(F.col("n_long") * F.lit(fraction)).cast("long"))
    n_val = F.least(n_val, F.col("n_long"))
    return agg.withColumn("n_val", n_val).withColumn("n_train", F.col("n_long") - F.col("n_val"))


def char_budget(docs: DataFrame, order: str, length: Column, max_chars: int) -> DataFrame:
    """Documents in ``order`` until the running character count reaches ``max_chars``;
    the document that crosses the budget is included.

    Lengths are summed per order value (equal values enter together, null before all others),
    the values are indexed and prefix-summed in chunks; the result is a plain filter on the
    input by the last value that starts below the budget."""
    sums = docs.groupBy(F.col(order).alias("_k")).agg(F.coalesce(F.sum(length.cast("long")), F.lit(0)).alias("_len"))
    indexed, _ = global_index(sums, ["_k"], "_i")
    run = prefix_scan(indexed, [], "_i", [("_before", "sum", "_len", False)])
    cut = (run.where(F.coalesce("_before", F.lit(0)) < max_chars)
              .agg(F.max(F.struct("_i", "_k"))["_k"].alias("k"), F.count(F.lit(1)).alias("n")).first())
    if not cut["n"]:
        return docs.where(F.lit(False))
    null = F.col(order).isNull()
    return docs.where(null) if cut["k"] is None else docs.where(null | (F.col(order) <= F.lit(cut["k"])))


def plan_missing_shards(spark: SparkSession, existing: DataFrame, num_shards: int,
                        max_shard: int = VAL_SHARD, val_shard: int = VAL_SHARD) -> DataFrame:
    """A9 (+ F2, G3): wanted shard ids are ``range(min(n, max_shard))`` plus the pinned
    validation shard; each is flagged present or missing by an anti/semi join."""
    wanted = spark.range(min(num_shards, max_shard)).select(F.col("id").alias("shard"))
    wanted = wanted.unionByName(spark.range(1).select(F.lit(val_shard).cast("long").alias("shard"))).distinct()
    have = existing.select(F.col("shard").cast("long").alias("shard")).distinct()
    missing = wanted.join(have, "shard", "left_anti").withColumn("present", F.lit(False))
    present = wanted.join(have, "shard", "left_semi").withColumn("present", F.lit(True))
    return missing.unionByName(present)
