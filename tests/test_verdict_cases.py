"""Cases where rows were once lost, cut or changed: each keeps its answer here."""

import io
import json
import math
import random
import re
import time
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import audit as A
from quarry.operators import bpe, corpus as C, experiments as X, metrics, packing as P, runlogs as R
from quarry.operators.scan import dense_index, global_index, prefix_scan
from quarry.sources import shards as SH
from quarry.sources import tabular as TB

LONG = "Patient presented with ulcerative colitis and " + "x" * 80


# ------------------------------------------------------------------ scans

def test_null_groups_keep_their_rows(spark):
    rows = [(None if i % 3 == 0 else i % 2, i, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    got = dense_index(df, ["k"], ["o"], num_partitions=5)
    assert got.count() == 60
    out = prefix_scan(got, ["k"], "idx", [("s", "sum", "v", True), ("n", "count", "v", False), ("p", "last", "o", False)],
                      chunk=2, block=3).collect()
    seen: dict = {}
    for r in sorted(out, key=lambda r: r["o"]):
        s, n, p = seen.get(r["k"], (0.0, 0, None))
        assert (r["idx"], r["n"], r["p"]) == (n, n, p) and r["s"] == pytest.approx(s + r["v"])
        seen[r["k"]] = (s + r["v"], n + 1, r["o"])


def test_last_keeps_null_values(spark):
    rows = [(1, i, None if i % 2 else i) for i in range(20)]
    got = prefix_scan(spark.createDataFrame(rows, "k long, i long, v long"), ["k"], "i", [("p", "last", "v", False)], chunk=3)
    assert [r["p"] for r in got.orderBy("i").collect()] == [None] + [v for _, _, v in rows[:-1]]


def test_global_index_moves_keys_only(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("long text "), 50).alias("text"))
    idx, n = global_index(df, [C.shuffle_key("doc_id"), "doc_id"], "i", num_partitions=7)
    assert n == 500 and sorted(r["i"] for r in idx.select("i").collect()) == list(range(500))
    plan = C.shard_assignment(df).select("shard").distinct()._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan


def test_kept_deltas_is_one_scan(spark):
    rows = [(r, i, "KEEP" if (r + i) % 3 else "DISCARD", float((i * 7) % 11), "c", "d") for r in range(3) for i in range(30)]
    log = spark.createDataFrame(rows, "run long, idx long, status string, val_bpb double, commit string, description string")
    d = X.kept_deltas(log.cache())
    plan = d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    print(plan)
    assert len(re.findall(r"\bExchange hash", plan)) <= 6
    for run in range(3):
        kept = [(i, v) for r, i, s, v, *_ in rows if r == run and s == "KEEP"]
        got = [(r["idx"], r["delta"], r["prev_idx"]) for r in d.where(F.col("run") == run).orderBy("idx").collect()]
        assert got == [(i, p - v, j) for (j, p), (i, v) in zip(kept, kept[1:])]


def test_total_delta_names_every_log(spark):
    rows = [("a", 0, "KEEP", 1.0), ("b", 0, "KEEP", 1.0), ("b", 1, "KEEP", 0.5), ("c", 0, "CRASH", 0.0)]
    log = spark.createDataFrame(rows, "run string, idx long, status string, val_bpb double")
    assert {r["run"]: (r["total_delta"], r["n_hits"]) for r in X.total_delta(log).collect()} == {"a": (0.0, 0), "b": (0.5, 1)}


def test_running_best_has_no_value_without_one(spark):
    log = spark.createDataFrame([(1, 0, "KEEP", 2.0), (1, 1, "KEEP", None), (1, 2, "KEEP", 3.0)], "run long, idx long, status string, val_bpb double")
    assert [r["running_best"] for r in X.running_best(log).orderBy("idx").collect()] == [2.0, None, 2.0]


def test_char_budget_with_null_and_equal_keys(spark):
    df = spark.createDataFrame([(None, 3), (None, 3), (1, 4), (2, 4), (2, 4), (3, 4)], "k long, n long")
    keep = lambda b: sorted((r["k"] or 0) for r in C.char_budget(df, "k", F.col("n"), b).collect())
    assert keep(1) == [0, 0] and keep(7) == [0, 0, 1] and keep(11) == [0, 0, 1, 2, 2] and keep(10**9) == [0, 0, 1, 2, 2, 3]
    assert C.char_budget(df.where("false"), "k", F.col("n"), 5).count() == 0


# ------------------------------------------------------------------ EMA

@pytest.mark.parametrize("beta", [0.0, 0.05, 0.9, 0.99, 0.999])
def test_ema_equals_the_recursion(spark, beta):
    rng = random.Random(3)
    xs = [rng.random() * 10 for _ in range(9000)]
    xs[8500] = None
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(xs)] + [(None, i, 1.0) for i in range(5)], "run string, step long, loss double")
    got = {(r["run"], r["step"]): r["ema_loss"] for r in R.ema_loss(df, beta=beta, chunk=1000, block=3).collect()}
    assert len(got) == 9005 and got[None, 4] == pytest.approx(1.0)
    s = 0.0
    for i, x in enumerate(xs):
        s = beta * s + (1 - beta) * (math.nan if x is None else x)
        want = s / (1 - beta ** (i + 1))
        assert (math.isnan(got["a", i]) and math.isnan(want)) or got["a", i] == pytest.approx(want, rel=1e-9)
    assert math.isnan(got["a", 8999])


# ------------------------------------------------------------------ policy

def test_policy_root_depth_nulls_and_repeated_ids(spark):
    deep = "/" + "/".join(f"d{i}" for i in range(100))
    rules = spark.createDataFrame([("read", "/"), ("allow", "/tmp/"), ("allow", deep), (None, None), ("read", None)], "kind string, prefix string")
    rules = rules.withColumn("prefix", F.regexp_replace("prefix", "/+$", ""))
    ops = spark.createDataFrame([(1, "/etc/x"), (1, "/tmp/x"), (None, deep + "/file"), (2, None), (3, "relative/x"), (4, "/")], "op_id long, path string")
    got = {r["path"]: (r["access"], r["matched_prefix"]) for r in A.policy_match(ops, rules).collect()}
    assert got == {"/etc/x": ("read", "/"), "/tmp/x": ("allow", "/tmp"), deep + "/file": ("allow", deep), None: ("denied", None),
                   "relative/x": ("denied", None), "/": ("read", "/")}
    assert A.policy_match(ops, rules).count() == 6


# ------------------------------------------------------------------ packing

def test_epochs_share_a_buffer(spark):
    r = np.random.default_rng(0)
    docs = [(i, [7] + r.integers(8, 90, int(n)).tolist()) for i, n in enumerate(r.integers(1, 120, 100))]
    df = spark.createDataFrame([*docs, (200, None), (201, [])], "doc_id long, ids array<int>")
    total = sum(len(x) for _, x in docs)
    for epochs in (1, 7):
        rows = P.pack_best_fit(P.repeat_epochs(df, epochs), seq_len=64, buffer_size=20, docs_per_pack=50).collect()
        packs = {x["pack_id"] for x in rows}
        assert sum(not x["complete"] for x in rows) <= len(packs) <= 3
        assert all(x["tokens"][0] == 7 and (len(x["tokens"]) == 65 or not x["complete"]) for x in rows)
        placed, cropped = sum(len(x["tokens"]) for x in rows), sum(x["cropped"] for x in rows)
        assert placed + cropped == sum(x["pack_input"] for x in rows) == epochs * total
        assert sum(x["pack_skipped"] for x in rows) == 2 * epochs
        assert {x["epoch"] for x in rows} == set(range(1, epochs + 1))


def best_fit(docs, capacity, size, refill):
    """The loader's rule, one document at a time."""
    buf, nxt, rows, row = [], 0, [], []
    while True:
        while len(buf) < size and nxt < len(docs):
            buf += docs[nxt:nxt + refill]
            nxt += refill
        if not buf:
            return rows + ([row] if row else [])
        space = capacity - len(row)
        fit = [d for d in buf if len(d) <= space]
        pick = max(fit, key=len) if fit else min(buf, key=len)
        buf.pop(next(i for i, d in enumerate(buf) if d is pick))
        row = row + list(pick[:space])
        if len(row) == capacity:
            rows, row = rows + [row], []


def test_pack_rows_equals_the_plain_rule():
    r = np.random.default_rng(5)
    docs = [r.integers(0, 9, int(n)) for n in r.integers(1, 40, 300)]
    rows, *_ = P.pack_rows(docs, 33, 25, 8)
    assert [x.tolist() for x in rows] == [list(map(int, x)) for x in best_fit(docs, 33, 25, 8)]


def test_unknown_tokens_count_without_bytes(spark):
    scored = spark.createDataFrame([(1, 2.0), (99, 5.0)], "token_id int, nll double")
    vocab = spark.createDataFrame([(1, 4)], "token_id int, n_bytes int")
    r = metrics.bits_per_byte(scored, vocab).first()
    assert (r["n_tokens"], r["total_bytes"], r["total_nats"]) == (2, 4, 2.0)


# ------------------------------------------------------------------ encoder

def plain_encode(data, ranks):
    parts = [data[i:i + 1] for i in range(len(data))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_encode_piece_equals_the_plain_rule_and_is_fast():
    rng = random.Random(1)
    for _ in range(300):
        ranks = {bytes([i]): i for i in range(256)}
        tokens = [b"a", b"b", b"c"]
        for k in range(rng.randint(0, 12)):
            t = rng.choice(tokens) + rng.choice(tokens)
            if t not in ranks:
                ranks[t] = 256 + k
                tokens.append(t)
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25)))
        if data not in ranks:
            assert bpe.encode_piece(data, ranks) == plain_encode(data, ranks)
    ranks = {bytes([i]): i for i in range(256)} | {b"a" * 2 ** k: 255 + k for k in range(1, 8)}
    t = time.perf_counter()
    assert len(bpe.encode_piece(b"a" * 8000, ranks)) == 63
    assert time.perf_counter() - t < 0.1


# ------------------------------------------------------------------ sources

def test_json_takes_strings_of_objects_only(spark, tmp_path):
    (tmp_path / "mixed.json").write_text(json.dumps([3, {"abstract": LONG, "body": {"a": "y" * 200}, "text": 12345678901234567890123}, "x", None]))
    (tmp_path / "cut.json").write_text('[{"abstract": "' + LONG)
    (tmp_path / "latin.json").write_bytes('[{"abstract": "é"}]'.encode("latin-1"))
    rows = TB.scan_json_cases(spark, str(tmp_path / "*.json"), errors=True).collect()
    assert [(r["row"], r["text"]) for r in rows if r["error"] is None] == [(1, LONG)]
    assert sorted(r["path"].split("/")[-1] for r in rows if r["error"]) == ["cut.json", "latin.json"]


def test_load_dir_reads_every_type_and_keeps_failures(spark, tmp_path):
    d = tmp_path / "in" / "sub"
    d.mkdir(parents=True)
    spark.createDataFrame([(1, [("c" * 101,), ("short",)])], "id int, cases array<struct<case_text:string>>").coalesce(1).write.parquet(str(tmp_path / "in" / "p1"))
    spark.createDataFrame([("r" * 101, 1)], "findings string, n int").coalesce(1).write.parquet(str(tmp_path / "in" / "p2"))
    (d / "broken.parquet").write_bytes(b"PAR1 not really")
    (d / "list.json").write_text(json.dumps([{"abstract": LONG}]))
    (d / "a.csv").write_text(f"id,report\n1,{LONG}\n2,{LONG},extra,fields\n3,short\n")
    (d / "b.csv").write_text(f"id,report\n9,{LONG} b\n")
    (d / "c.tsv").write_text("x\ty\n" + "z" * 60 + "\t" + "w" * 60 + "\n")
    (d / "notes.txt").write_text(LONG)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("in/a.csv", f"id,report\n1,{LONG} zipped\n")
        z.writestr("in/b.json", "[1, 2")
    (d / "x.zip").write_bytes(buf.getvalue())
    (d / "bad.zip").write_bytes(b"not a zip")
    good, bad = TB.quarantine(TB.load_dir(spark, str(tmp_path / "in")))
    texts = sorted(r["text"] for r in good.collect())
    assert texts == sorted(["c" * 101, "r" * 101, LONG, LONG, LONG + " b", "z" * 60 + "\n\n" + "w" * 60, LONG + " zipped"])
    errors = {(r["path"].split("/")[-1], r["member"]) for r in bad.collect()}
    assert errors == {("broken.parquet", None), ("a.csv", None), ("x.zip", "in/b.json"), ("bad.zip", None)}
    zipped = [r for r in good.collect() if r["text"].endswith("zipped")][0]
    assert zipped["path"].endswith("x.zip") and zipped["member"] == "in/a.csv"
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "readme.md").write_text("x")
    assert TB.load_dir(spark, str(tmp_path / "none")).count() == 0


def test_corrupt_lines_are_kept_apart(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,2\n1,2,3,4\n5,6\n")
    rows = TB.scan_delimited(spark, str(p), corrupt_col="bad").cache()
    assert [r["bad"] for r in rows.where("bad IS NOT NULL").collect()] == ["1,2,3,4"]
    assert rows.where("bad IS NULL").count() == 2


def test_results_log_line_ends_and_quotes(spark, tmp_path):
    p = tmp_path / "results.tsv"
    p.write_bytes(b'commit\tval_bpb\tmemory_gb\tstatus\tdescription\r\na1\t1.5\t2.0\tkeep\t"say ""hi"" now"\r\nb2\t1.4\t2.0\tdiscard\tplain\r\n')
    got = [tuple(r) for r in TB.scan_experiment_log(spark, str(p)).orderBy("idx").select("idx", "status", "description").collect()]
    assert got == [(0, "keep", 'say "hi" now'), (1, "discard", "plain")]


def test_shards_without_rows_are_listed(spark, tmp_path):
    spark.range(3).select(F.lit("t").alias("text")).coalesce(1).write.parquet(str(tmp_path / "s" / "a"))
    spark.range(0).select(F.lit("t").alias("text")).coalesce(1).write.parquet(str(tmp_path / "s" / "b"))
    assert SH.list_shards(spark, str(tmp_path / "s")).count() == 2


def test_preconditions_stop_the_job(spark, tmp_path):
    (tmp_path / "e").mkdir()
    with pytest.raises(ValueError):
        SH.scan_split(spark, str(tmp_path / "e"), "test")
    with pytest.raises(FileNotFoundError):
        SH.scan_split(spark, str(tmp_path / "e"), "train")
    with pytest.raises(ValueError):
        bpe.train_bpe(spark, spark.createDataFrame([], "text string"))


# ------------------------------------------------------------------ results row, stream

def test_results_status_follows_the_keep_rule(spark):
    s = spark.createDataFrame([(1, 1.0, 1024.0), (2, 0.9, 2048.0), (3, 0.95, 1.0), (4, None, None), (5, 0.8, 1.0)], "run long, val_bpb double, peak_vram_mb double")
    meta = s.select("run", "val_bpb", "peak_vram_mb", F.lit("abcdefghij").alias("commit"), F.lit("d").alias("description"))
    got = R.build_results_log(meta, R.detect_crash(s, s)).orderBy("run").collect()
    assert [r["status"] for r in got] == ["keep", "keep", "discard", "crash", "keep"]
    assert got[1]["memory_gb"] == 2.0 and got[3]["val_bpb"] == 0.0 and got[0]["commit"] == "abcdefg"


def test_last_summary_block_counts(spark):
    lines = spark.createDataFrame([("r", 0, "val_bpb:          1.5"), ("r", 9, "val_bpb:          1.25")], "run string, at long, line string")
    assert R.parse_summary(lines, order="at").first()["val_bpb"] == 1.25


def test_monitor_does_not_depend_on_order(spark, tmp_path):
    from quarry.streaming import jobs
    rng = random.Random(2)
    rows = [(run, i, rng.random(), 0.5) for run in (1, 2) for i in range(40)]
    rows[7] = (1, 7, math.nan, 0.5)
    schema = "run long, step long, loss double, dt double"
    orders = [rows, rows[::-1], rng.sample(rows, len(rows))]
    got = []
    for n, o in enumerate(orders):
        src = tmp_path / f"in{n}"
        for k in range(0, len(o), 16):
            spark.createDataFrame(o[k:k + 16], schema).coalesce(1).write.mode("append").parquet(str(src))
        out = str(tmp_path / f"out{n}")
        jobs.stream_step_monitor(spark, str(src), spark.createDataFrame([], schema).schema, out, str(tmp_path / f"ck{n}"), max_files=1)
        got.append({r["run"]: (r["last_step"], round(r["train_seconds"], 9), r["failed"], r["first_bad_step"], r["ema_loss"])
                    for r in jobs.latest_per_key(spark.read.parquet(out)).collect()})
    s = 0.0
    for _, _, x, _ in rows[40:]:
        s = 0.9 * s + 0.1 * x
    for g in got:
        assert g[1][:4] == (39, 14.5, True, 7) and (g[1][4] is None or math.isnan(g[1][4]))
        assert g[2][:4] == (39, 14.5, False, None) and g[2][4] == pytest.approx(s / (1 - 0.9 ** 40))


def test_stream_ingest_combines_and_caps(spark):
    from quarry.streaming import jobs
    df = spark.createDataFrame([(1, " " + "a" * 80, "b" * 80), (2, "nan", "short")], "doc_id long, report string, findings string")
    got = jobs.ingest_transform(df, text_columns=("report", "findings"), cap=90).collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(1, "a" * 80 + "\n\n" + "b" * 8)]


def test_no_shared_folder_is_an_error_on_a_cluster():
    from quarry.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
