"""op11: against a single sorted list, hot keys, segments, odd inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import resample as R
from quarry.llm.catalog import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, lo=1, hi=1):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, lo=1, hi=1, buckets=10_000, percent=10, least=20, seed=2024):
    """Rows ``(doc_id, n_features, weight, score)`` in place, and the drawn ones' (score, doc_id) in order."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(at(f) for _, t in docs for f in features(t, lo, hi)[1])
    t = Counter(at(f) for x in target for f in features(x, lo, hi)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)]
    rows, pool = [], []
    for i, text in docs:
        n, f = features(text, lo, hi)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[at(x)] for x in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((i, len(f), weight, score))
        if n >= least:
            pool.append((-score, i is None, i or 0))
    pool.sort()
    return rows, [(-s, None if z else i) for s, z, i in pool[:percent * len(pool) // 100]]


def check(got, docs, target, **kw):
    rows, drawn = brute(docs, target, **kw)
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)[:4]) for r in got)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["score"], r["doc_id"]) for r in ranked] == drawn


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    check(QUERIES["op11_resample"](spark, sf).collect(), docs, target)


def test_hot_id_ties_and_segments(spark):
    """A third of all rows are one row, another third has equal scores nowhere; few words in many ways."""
    docs = [(7, "one two three " * 10)] * 300 + [(i, f"word{i % 9} two " * 12) for i in range(300)]
    docs += [(None, "null key " * 15)] * 50 + [(1000 + i, "short") for i in range(250)]
    target = ["two three", None, "", "word3"]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for segments in (1, 3, 40):
        check(R.resample(df, goal, percent=60, segments=segments).collect(), docs, target, percent=60)
    check(R.resample(df, goal, lo=1, hi=3, buckets=97, percent=25).collect(), docs, target, lo=1, hi=3, buckets=97, percent=25)


def test_segments_are_balanced(spark):
    """One row makes up all rows: its copies spread over the segments by their place."""
    df = spark.createDataFrame([(7, "a " * 30)] * 4000, "doc_id bigint, text string").repartition(4)
    rows = R.scored(df, R.gains(*[R.np.zeros(10, R.np.int64)] * 2), "text", "doc_id", 1, 1, 1)
    runs = R.written(rows.sortWithinPartitions(F.desc("score"), "_key").withColumn("_place", F.monotonically_increasing_id()), "t")
    cuts = R.splitters(runs, 8)
    sizes = [r["count"] for r in runs.groupBy(R.segment_of(cuts, "bigint").alias("s")).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 4000 // 8 + 4000 // R.SAMPLES + 16


def test_odd_and_empty(spark, odd, empty):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    target = spark.createDataFrame([("alpha beta",), (None,)], "text string")
    got = R.resample(odd.withColumn("weight", F.lit("x")).withColumn("rank", F.lit("x")), target, percent=50, least_words=1)
    check(got.collect(), docs, ["alpha beta", None], percent=50, least=1)
    assert R.resample(empty, target).count() == 0
    check(R.resample(odd, target.where("false")).collect(), docs, [])
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]


@pytest.mark.parametrize("text", ["", "Ab-Cd é１ x9", "\x00a\x7fb_c", "ÄÖ äö"])
def test_words(text):
    assert [w.decode() for w in R.words(text.encode())] == features(text)[1]
