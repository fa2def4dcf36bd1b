"""Importance resampling towards a target distribution, ranked by parallel sorting by regular sampling.

Features of a text are its runs of ``lo`` to ``hi`` consecutive words, hashed to buckets.  Feature
counts of all source and of all target texts give each bucket a gain, the scaled logarithm of the
smoothed ratio of its two shares; a document's weight is the sum of the gains over its features,
looked up in one array.  Weight plus Gumbel noise from a hash of the id is the score, and the k
highest scores are a draw without replacement.

The ranks of the drawn rows come from a parallel sort of the scored rows:

1. Each partition is sorted on its own and written: a run.  A row's key is (score falling, id, place),
   and its place (run and position) makes it unique, so equal scores and repeated ids spread as
   evenly as other rows.
2. At most ``SAMPLES`` regularly spaced keys of each run are gathered; every n-th of them in order is
   a splitter.  With r runs no segment then holds much more than its share plus 1/SAMPLES of the rows.
3. Each row finds its segment by binary search among the splitters, the segments are counted, and
   the prefix sums of the counts are the rank before each segment's first row.
4. Rows of segments that begin before the k-th rank are exchanged by segment, merged in order there,
   and get the prefix count plus their number in the segment: exact ranks.

What reaches the driver are the gains' counts (two numbers a bucket), SAMPLES keys a run and one
count a segment."""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices, written

BUCKETS = 10_000
SCALE = 1000                  # of gains and noise, which are whole numbers
SAMPLES = 64                  # keys of a run that may become splitters
SEGMENT_ROWS = 1_000_000      # rows of a segment, about
LEAST_SEGMENTS, MOST_SEGMENTS = 8, 4096
# Fixed values of the word rule: A-Z in lower case, then runs of digits, a-z and what is not ASCII.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


def feature_buckets(w: list[bytes], lo: int, hi: int, buckets: int) -> np.ndarray:
    """Bucket of each feature: crc32 of its bytes, its words joined by one space."""
    parts = []
    for n in range(lo, hi + 1):
        grams = w if n == 1 else list(map(b" ".join, zip(*(w[i:] for i in range(n)))))
        parts.append(np.fromiter(map(crc32, grams), np.int64, len(grams)))
    return np.concatenate(parts) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", lo: int = 1, hi: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one number a bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in slices(batches, "_text"):
            for t in b.column("_text").to_pylist():
                if t:
                    total += np.bincount(feature_buckets(words(t), lo, hi, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = map_arrow(texts.select(F.col(text).cast("string").cast("binary").alias("_text")), run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE · ln of target share over source share), both with one more in every bucket."""
    d = len(source)
    all_s, all_t = float(source.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((t + 1.0) * (all_s + d) / ((s + 1.0) * (all_t + d))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: int, key) -> int:
    """Gumbel noise in whole SCALE-ths from the first 32 bits of SHA-256; a null key is the empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, text: str, key: str, seed: int, lo: int, hi: int) -> DataFrame:
    """``_key, n_words, n_features, weight, score`` per row."""
    kind = docs.schema[key].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(gain)       # one number a bucket

    def run(batches):
        g = table.value
        for b in slices(batches, "_text"):
            keys, out = b.column("_key"), []
            for k, t in zip(keys.to_pylist(), b.column("_text").to_pylist()):
                w = words(t or b"")
                f = feature_buckets(w, lo, hi, len(g))
                weight = int(g[f].sum())
                out.append((len(w), len(f), weight, weight + noise(seed, k)))
            cols = [pa.array(c, pa.int64()) for c in (zip(*out) if out else ((),) * 4)]
            yield pa.RecordBatch.from_arrays([keys, *cols], ["_key", "n_words", "n_features", "weight", "score"])

    src = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    return map_arrow(src, run, f"_key {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def order_key() -> Column:
    """Rows in the order of their ranks: higher scores first, then smaller ids (null last), then place."""
    return F.struct((-F.col("score")).alias("s"), F.col("_key").isNull().alias("z"), F.col("_key").alias("k"),
                    F.col("_place").alias("p"))


def splitters(runs: DataFrame, segments: int) -> list:
    """At most ``segments - 1`` keys: regular samples of the regular samples of the runs."""
    run, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    rows = runs.select(run.alias("run"), at.alias("at"), order_key().alias("key"))
    sizes = rows.groupBy("run").agg(F.max("at").alias("last"))             # a row a run
    stride = F.ceil((F.col("last") + 1) / F.lit(SAMPLES))
    got = sorted((r["key"] for r in rows.join(F.broadcast(sizes), "run").where(F.pmod("at", stride) == 0)
                  .select("key").collect()), key=lambda k: (k["s"], k["z"], k["k"], k["p"]))
    return [got[i * len(got) // segments] for i in range(1, segments)] if len(got) >= segments else got[1:]


def segment_of(cuts: list, kind: str) -> Column:
    """Number of splitters that are not above a row's key, by binary search."""
    if not cuts:
        return F.lit(0)
    element = f"struct<s:bigint,z:boolean,k:{kind},p:bigint>"
    table = F.array(*[F.struct(F.lit(c["s"]).alias("s"), F.lit(c["z"]).alias("z"), F.lit(c["k"]).alias("k"),
                               F.lit(c["p"]).alias("p")).cast(element) for c in cuts])
    bits = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

    def longer(at: Column, bit: Column) -> Column:
        inside = (at + bit <= len(cuts)) & (F.get(table, at + bit - 1) <= order_key())
        return F.when(inside, at + bit).otherwise(at)

    return F.aggregate(bits, F.lit(0), longer)


def resample(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text",
             seed: int = 2024, percent: int = 10, least_words: int = 20, lo: int = 1, hi: int = 1,
             buckets: int = BUCKETS, segments: int | None = None) -> DataFrame:
    """``key, n_features, weight, score, rank`` per row of ``docs``; ``rank`` counts the drawn rows from 1
    in the order of score (ties to the smaller id, null ids last) and is null for the others.  Drawn are
    floor(percent · N / 100) of the N rows with at least ``least_words`` words.

    A null or empty text has no features and weight 0, and counts in no bucket; a null key draws the
    noise of the empty string; repeated rows have equal scores and a rank each; very long texts count
    whole; other columns are left behind; an empty table gives no rows, and an empty target makes
    features that are rare in ``docs`` gain most."""
    kind = docs.schema[key].dataType.simpleString()
    gain = gains(bucket_counts(docs, text, lo, hi, buckets), bucket_counts(target, target_text, lo, hi, buckets))
    rows = scored(docs, gain, text, key, seed, lo, hi)
    enough = F.col("n_words") >= least_words
    # Locally sorted runs, those that take part first; the place is fixed once the run is written.
    rows = rows.withColumn("_in", enough).sortWithinPartitions(F.desc("_in"), F.desc("score"), F.asc_nulls_last("_key"))
    rows = written(rows.withColumn("_place", F.monotonically_increasing_id()), "resample-runs")
    runs = rows.where("_in")
    n = runs.count()
    k = percent * n // 100
    if segments is None:
        segments = min(MOST_SEGMENTS, max(LEAST_SEGMENTS, -(-n // SEGMENT_ROWS)))
    at = segment_of(splitters(runs, segments), kind)
    sizes = {r["segment"]: r["count"] for r in runs.select(at.alias("segment")).groupBy("segment").count().collect()}
    before, starts = 0, {}
    for s in sorted(sizes):
        starts[s] = before
        before += sizes[s]
    last = max([s for s, b in starts.items() if b < k], default=-1)
    dealt = rows.withColumn("_segment", F.when(F.col("_in"), at))
    drawn = F.coalesce(F.col("_segment") <= last, F.lit(False))
    number = F.row_number().over(Window.partitionBy("_segment").orderBy(order_key()))
    first = F.array(*[F.lit(starts.get(s, 0)).cast("long") for s in range(last + 1)] or [F.lit(0).cast("long")])
    ranked = dealt.where(drawn).withColumn("rank", F.get(first, F.col("_segment")) + number)
    rest = dealt.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        F.col("_key").alias(key), "n_features", "weight", "score", F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
