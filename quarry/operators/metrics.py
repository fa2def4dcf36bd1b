"""Bits per byte.

Losses are in nats per target token; special tokens have 0 bytes and count in neither sum.
The vocabulary side of the lookup join is broadcast up to MAX_VOCAB entries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

MAX_VOCAB = 1_000_000


def bits_per_byte(scored: DataFrame, vocab: DataFrame, keys: Sequence[str] = (),
                  token: str = "token_id", nll: str = "nll") -> DataFrame:
    """Σ nll (tokens with bytes) / (ln 2 · Σ bytes), globally or per ``keys``.  A token that the
    vocabulary lacks counts as a token without bytes."""
    v = vocab.select(F.col("token_id").alias(token), "n_bytes")
    v = F.broadcast(v) if v.limit(MAX_VOCAB + 1).count() <= MAX_VOCAB else v
    j = scored.join(v, token, "left")
    agg = j.groupBy(*keys).agg(
        F.sum(F.when(F.col("n_bytes") > 0, F.col(nll)).otherwise(F.lit(0.0))).alias("total_nats"),
        F.sum(F.coalesce("n_bytes", F.lit(0))).cast("long").alias("total_bytes"),
        F.count(F.lit(1)).alias("n_tokens"))
    return agg.withColumn("bpb", F.try_divide("total_nats", F.lit(math.log(2)) * F.col("total_bytes")))


def unigram_bpb(units: DataFrame, unit: str = "piece", split: str = "split") -> DataFrame:
    """A stand-in scorer when no model is at hand: add-one unigram losses learnt on the units of
    the split ``train``, ``nll = -ln((c + 1) / (N + V + 1))``, scored on those of ``val``, bytes = UTF-8
    length.  One aggregate counts a unit in both splits, so the text is read once and a frequent
    unit is one row; the counts, a row a distinct unit, are written for the two steps that use them."""
    of = lambda name: F.count_if(F.col(split) == name)
    counts = cut_lineage(units.groupBy(unit).agg(of("train").alias("c"), of("val").alias("m")), "unit-counts")
    tot = counts.agg(F.sum("c").alias("N"), F.count_if(F.col("c") > 0).alias("V")).first()   # two scalars
    n_train, n_types = int(tot["N"] or 0), int(tot["V"] or 0)
    nll = -F.log((F.col("c") + 1) / F.lit(float(n_train + n_types + 1)))
    nbytes = F.octet_length(unit)
    agg = counts.where("m > 0").agg(
        F.sum(F.when(nbytes > 0, F.col("m") * nll).otherwise(F.lit(0.0))).alias("total_nats"),
        F.sum(F.col("m") * nbytes).cast("long").alias("total_bytes"),
        F.sum("m").cast("long").alias("n_tokens"))
    return agg.withColumn("bpb", F.try_divide("total_nats", F.lit(math.log(2)) * F.col("total_bytes")))
