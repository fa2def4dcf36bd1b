"""Packing invariants, audit checks on files, streaming = batch."""

import base64
import hashlib
import json

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import audit as A
from quarry.operators import packing as P


def test_pack_rows_invariants():
    rng = np.random.default_rng(0)
    docs = [np.concatenate([[999], rng.integers(0, 50, rng.integers(1, 150))]).astype(np.int32) for _ in range(400)]
    rows, cropped, complete, _ = P.pack_rows(docs, 65, 50)
    assert all(len(r) == 65 for r, c in zip(rows, complete) if c)
    assert all(r[0] == 999 for r in rows)                      # every row starts with a document
    assert sum(len(r) for r in rows) + sum(cropped) == sum(len(d) for d in docs)


def test_pack_best_fit_spark(spark):
    rows = [(i, [7] + list(range(1 + i % 40))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    packed = P.pack_best_fit(df, seq_len=64, buffer_size=20, docs_per_pack=100)
    got = packed.collect()
    assert {r["pack_id"] for r in got} == {0, 1, 2}
    assert all(r["tokens"][0] == 7 for r in got)
    assert sum(len(r["tokens"]) for r in got) + sum(r["cropped"] for r in got) == sum(len(i) for _, i in rows)


def test_integrity_on_files(spark, tmp_path):
    prog = tmp_path / "program.md"
    prog.write_text("do the experiment\n")
    digest = hashlib.sha256(prog.read_bytes()).hexdigest()
    stmt = {"_type": "https://in-toto.io/Statement/v1", "subject": [{"name": "program.md", "digest": {"sha256": digest}}]}
    bundle = {"dsseEnvelope": {"payloadType": "application/vnd.in-toto+json",
                               "payload": base64.b64encode(json.dumps(stmt).encode()).decode()}}
    b = spark.createDataFrame([(json.dumps(bundle),)], "bundle string")
    files = A.read_files(spark, str(prog))
    assert A.integrity_check(files, A.bundle_subjects(b)).first()["state"] == "ok"
    prog.write_text("tampered\n")
    assert A.integrity_check(A.read_files(spark, str(prog)), A.bundle_subjects(b)).first()["state"] == "changed"


def test_policy_components(spark):
    rules = A.policy_rules(spark, "/home/u")
    ops = spark.createDataFrame([(1, "/tmp/x"), (2, "/tmpfoo/x"), (3, "/proc/self/task/1"), (4, "/proc/self"),
                                 (5, "/home/u/.ssh/id"), (6, "/tmp")], "op_id long, path string")
    got = {r["op_id"]: r["access"] for r in A.policy_match(ops, rules).collect()}
    assert got == {1: "allow", 2: "denied", 3: "allow", 4: "read", 5: "denied", 6: "allow"}


def test_stream_ingest_equals_batch(spark, tmp_path):
    from quarry.streaming import jobs
    src = tmp_path / "in"
    d = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 90).cast("int")).alias("text"))
    d.where("doc_id < 200").write.parquet(str(src / "a"))
    d.where("doc_id >= 200").write.parquet(str(src / "b"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    jobs.stream_ingest(spark, str(src / "*"), d.schema, out, ck, max_files=1)
    got = sorted((r["doc_id"], r["split"]) for r in spark.read.parquet(out).collect())
    exp = sorted((r["doc_id"], r["split"]) for r in jobs.ingest_transform(d).collect())
    assert got == exp and len(got) > 0


def encoded(spark, n=400, seed=1):
    r = np.random.default_rng(seed)
    rows = [(i, [7] + [int(x) for x in r.integers(8, 99, r.integers(0, 150))]) for i in range(n)] + [(n, None), (n + 1, [])]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>"), [a for _, a in rows if a]


def test_packs_are_cut_by_ids_and_one_short_row_remains(spark):
    df, docs = encoded(spark)
    total = sum(map(len, docs))
    placed = P.packs_by_ids(df.selectExpr("coalesce(ids, array()) AS ids", "1 AS epoch", "doc_id AS order_key"), 2000)
    sizes = [r["n"] for r in placed.groupBy("pack_id").agg(F.sum(F.size("ids")).alias("n")).collect()]
    assert max(sizes) <= 2000 + 150 and total / 2150 <= len(sizes) <= 2 * total / 2000 + 1
    got = P.pack_best_fit(df, seq_len=64, buffer_size=20, ids_per_pack=2000).collect()
    assert sum(not r["complete"] for r in got) <= 1
    assert all(len(r["tokens"]) == 65 for r in got if r["complete"]) and all(r["tokens"][0] == 7 for r in got)
    assert sum(len(r["tokens"]) + r["cropped"] for r in got) == total == sum(r["pack_input"] for r in got)
    assert sum(r["pack_skipped"] for r in got) == 2 and len({(r["pack_id"], r["row"]) for r in got}) == len(got)
    one = P.pack_best_fit(df, seq_len=64, buffer_size=20, ids_per_pack=10**9).collect()
    rows, *_ = P.pack_rows([np.array(d, np.int32) for d in docs], 65, 20)
    assert [r["tokens"] for r in sorted(one, key=lambda r: r["row"])] == [r.tolist() for r in rows]
    assert P.pack_best_fit(df.where("false")).count() == 0


def test_epochs_are_replayed_in_place(spark):
    df, docs = encoded(spark, 60)
    total = sum(map(len, docs))
    got = P.pack_best_fit(df, seq_len=64, buffer_size=20, ids_per_pack=10**9, epochs=3).collect()
    rows, *_ = P.pack_rows([np.array(d, np.int32) for d in docs] * 3, 65, 20)
    got.sort(key=lambda r: r["row"])
    assert [r["tokens"] for r in got] == [r.tolist() for r in rows]
    assert sum(r["pack_input"] for r in got) == 3 * total
    assert {r["epoch"] for r in got} == {1, 2, 3}
    wanted = P.pack_best_fit(df, seq_len=64, buffer_size=20, ids_per_pack=1000, rows_wanted=500)
    rows = wanted.collect()
    assert 500 <= len(rows) < 520 and all(len(r["tokens"]) == 65 for r in rows)
    assert P.eval_rows(wanted, 10, 64, 500 * 64).count() == 500
    assert P.pack_best_fit(df.where("ids IS NULL"), seq_len=64, rows_wanted=5).count() == 0


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """A batch tried again, with other rows even, stands once; a replay after the loss of its commit too."""
    import os
    from quarry.streaming import jobs
    out = str(tmp_path / "sink")
    write = jobs._batch_sink(out)
    rows = lambda *v: spark.createDataFrame([(x, 1.0 * x) for x in v], "run long, best_bpb double")
    write(rows(1, 2), 0)
    write(rows(1), 1)
    write(rows(1, 3), 1)
    got = sorted((r["run"], r["batch_id"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 0), (1, 1), (2, 0), (3, 1)]

    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    log = spark.createDataFrame([(1, "KEEP", 0.9), (1, "KEEP", 0.8), (2, "DISCARD", 0.1), (2, "KEEP", 0.7)],
                                "run long, status string, val_bpb double").coalesce(1)
    log.write.parquet(src)
    for _ in range(2):
        jobs.stream_running_best(spark, src, log.schema, out, ckpt)
        got = sorted(tuple(r)[:3] for r in spark.read.parquet(out).collect())
        assert got == [(1, 0.8, 2), (2, 0.7, 1)]
        for name in os.listdir(f"{ckpt}/commits"):
            if name.strip(".").split(".")[0] == "0":
                os.remove(f"{ckpt}/commits/{name}")          # as if the driver died before the commit
