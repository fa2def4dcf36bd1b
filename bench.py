"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed completely through the ``noop`` sink (every row produced, nothing
collected).  Prints one JSON line: total seconds, seconds per query, and row throughput
figures for the corpus path."""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "pretoken_counts",        # H1 + C8: regex split + partial/final aggregation
    "union_sources",          # A5 + B1/B2/B5/B8: three sources, schema-time column choice
    "shard_assignment",       # D9 + E5: range-partitioned seeded shuffle and global index
    "shard_stats",            # C2 (flagship)
    "filter_keywords_any",    # B9
    "bpe_pair_counts",        # C9
    "train_bpe",              # H2: exact batched merges, all 8,192 entries
    "encode",                 # H5: Arrow-batched BPE encode with broadcast ranks
    "pack_best_fit",          # I3: best-fit packing per pack (applyInPandas)
    "bits_per_byte",          # C10
    "keep_decision",          # D7: skew-safe chunked prefix scan
    "rank_hits",              # D5: skew-safe dense ranking
    "ema_loss",               # D11: affine maps composed over chunks
    "cumulative_train_time",  # D10
    "policy_match",           # G5: prefix-expansion equi-join
    "integrity_check",        # K1
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from quarry.session import get_session
    spark = get_session(f"local[{cpus}]", "quarry-bench",
                        **{"spark.sql.shuffle.partitions": str(max(8, int(cpus)))})
    from quarry.plans.registry import all_queries
    qs = all_queries()
    # warm the JVM and the Python workers once, outside the timings
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for n in names:
        t = time.time()
        qs[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).count()
    total = round(sum(times.values()), 3)
    out = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
           "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
           "documents": docs}
    if times.get("shard_assignment"):
        out["shard_assignment_docs_per_sec"] = round(docs / times["shard_assignment"], 1)
    if times.get("pretoken_counts"):
        out["pretokenize_docs_per_sec"] = round(docs / times["pretoken_counts"], 1)
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
