"""Skew-safe scans equal plain window results, with tiny chunks and a hot key."""

import random

import pandas as pd
from pyspark.sql import functions as F

from quarry.operators.scan import dense_index, global_index, prefix_scan, shift_by_index, top_k_per_group


def frame(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.randint(1, 6)          # key 0 holds a third of all rows
        val = None if rng.random() < 0.1 else rng.randint(0, 50) * 1.0
        rows.append((key, rng.randint(0, 10_000) * 1000 + i, val))
    return spark.createDataFrame(rows, "k long, o long, v double"), pd.DataFrame(rows, columns=["k", "o", "v"])


def test_dense_index(spark):
    df, pdf = frame(spark)
    got = dense_index(df, ["k"], ["o"]).toPandas().sort_values(["k", "o"]).reset_index(drop=True)
    pdf = pdf.sort_values(["k", "o"]).reset_index(drop=True)
    pdf["idx"] = pdf.groupby("k").cumcount()
    assert got["idx"].tolist() == pdf["idx"].tolist()


def test_global_index(spark):
    df, pdf = frame(spark)
    got, n = global_index(df, ["o"])
    got = got.toPandas().sort_values("o")
    assert n == len(pdf) and got["idx"].tolist() == list(range(len(pdf)))


def test_prefix_scan_matches_pandas(spark):
    df, pdf = frame(spark)
    idx = dense_index(df, ["k"], ["o"])
    got = prefix_scan(idx, ["k"], "idx", [("mn", "min", "v", True), ("sm_ex", "sum", "v", False),
                                          ("cnt", "count", "v", False), ("mx_ex", "max", "v", False)],
                      chunk=3).toPandas().sort_values(["k", "o"]).reset_index(drop=True)
    pdf = pdf.sort_values(["k", "o"]).reset_index(drop=True)
    # the scan keeps the running value at a null row; the running-best report leaves it out there
    exp_min = pdf.groupby("k")["v"].transform(lambda s: s.expanding().min())
    for a, b in zip(got["mn"], exp_min):
        assert (pd.isna(a) and pd.isna(b)) or a == b
    exp_cnt = pdf.groupby("k")["v"].transform(lambda s: s.notna().cumsum().shift(1, fill_value=0))
    assert got["cnt"].tolist() == exp_cnt.astype(int).tolist()
    exp_sum = pdf.groupby("k")["v"].transform(lambda s: s.expanding().sum().shift(1))
    for a, b, c in zip(got["sm_ex"], exp_sum, exp_cnt):
        assert (c == 0 and pd.isna(a)) or abs(a - b) < 1e-9


def test_top_k_and_shift(spark):
    df, pdf = frame(spark)
    top = top_k_per_group(df, ["k"], [F.col("o").desc()], 4, salt_col="o", buckets=5, rank_col="r").toPandas()
    exp = pdf.sort_values(["k", "o"], ascending=[True, False]).groupby("k").head(4)
    assert sorted(top["o"]) == sorted(exp["o"])
    idx = dense_index(df, ["k"], ["o"])
    sh = shift_by_index(idx, ["k"], "idx", ["o"]).toPandas().sort_values(["k", "o"])
    exp = pdf.sort_values(["k", "o"]).groupby("k")["o"].shift(1)
    assert [None if pd.isna(x) else int(x) for x in sh["prev_o"]] == [None if pd.isna(x) else int(x) for x in exp]


def test_global_index_with_repeated_and_null_keys(spark):
    """As many rows out as in, whatever the keys: a third of all rows with one id, null ids, copies."""
    rows = [(7, f"t{i}") for i in range(300)] + [(None, "n")] * 40 + [(i, "x") for i in range(100, 600)] + [(3, "same")] * 10
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out, n = global_index(df, ["doc_id"], "idx")
    got = out.collect()
    assert n == len(rows) == len(got) and sorted(r["idx"] for r in got) == list(range(len(rows)))
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(a), b) for a, b in rows)
    by_idx = [r["doc_id"] for r in sorted(got, key=lambda r: r["idx"])]
    assert by_idx == sorted((a for a, _ in rows), key=lambda a: (a is not None, a or 0))
    assert out.columns == ["doc_id", "text", "idx"]


def test_shard_assignment_keeps_every_row(spark):
    from quarry.operators.corpus import shard_assignment
    rows = [(i, f"t{i}") for i in range(190)] + [(5, f"again {i}") for i in range(9)] + [(None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = shard_assignment(df, docs_per_shard=20).collect()
    assert sorted(r["text"] for r in out) == sorted(t for _, t in rows)
    assert sorted(r["idx"] for r in out) == list(range(200)) and sum(r["split"] == "val" for r in out) == 50
    assert shard_assignment(df.where("false")).count() == 0
