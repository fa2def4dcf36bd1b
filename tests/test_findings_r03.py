"""Cases of FINDINGS_r03.md."""

import numpy as np
from pyspark.sql import functions as F


# --------------------------------------------------------------------------- stream_ingest

def test_stream_ingest_reads_a_table_of_several_files(spark, tmp_path):
    """the documents are a folder of files, in part too short, or all of them."""
    from quarry.plans.catalog.streaming_queries import q_stream_ingest
    rows = [(i, "word " * (30 if i % 3 else 2), "en", "s", 150) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(4).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    got = q_stream_ingest(spark, str(tmp_path / "many"))
    assert sorted(r["doc_id"] for r in got.collect()) == [i for i in range(60) if i % 3]
    df.where("doc_id % 3 = 0").repartition(2).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    got = q_stream_ingest(spark, str(tmp_path / "none"))
    assert got.columns[-1] == "split" and got.count() == 0


# --------------------------------------------------------------------------- tokenizer training

def test_rounds_merge_ahead_of_a_skipped_pair():
    """A pair behind one that touches the round is merged in the same round, and gets
    its id at its turn."""
    from quarry.operators.bpe import ID_SHIFT, Ranking
    r = Ranking(100)
    pairs = {(1, 2): 10, (2, 3): 9, (5, 6): 8, (6, 7): 7}
    r.keys = np.array(sorted(a * ID_SHIFT + b for a, b in pairs), np.int64)
    r.counts = np.array([pairs[divmod(k, ID_SHIFT)] for k in r.keys.tolist()], np.int64)
    assert r.walk(100, 50) == ([(1, 2)], [(1, 2, 256), (5, 6, 257)])         # (2, 3) touches (1, 2)
    first = np.array([1 * ID_SHIFT + 2, 2 * ID_SHIFT + 3, 5 * ID_SHIFT + 6, 6 * ID_SHIFT + 7, 256 * ID_SHIFT + 3, 257 * ID_SHIFT + 7], np.int64)
    r.update(first, np.array([-10, -4, -8, -7, 4, 7], np.int64), 256)
    final, plan = r.walk(100, 50)
    assert final[0] == (5, 6) and r.ids[257] == 257
    assert plan == [(2, 3, 258), (256, 3, 259)]                              # (257, 7) waits for its id


# --------------------------------------------------------------------------- logs

def test_logs_of_many_runs_are_few_files(spark, tmp_path, monkeypatch):
    """the files written do not grow with the runs; rows, order and hot runs are kept."""
    import datetime
    import glob
    from quarry.plans.catalog import file_queries as Q
    from quarry.plans.catalog.file_queries import q_scan_experiment_log, q_scan_run_log, q_tail_log_lines
    from quarry.plans.standins import experiment_log, step_table
    day = datetime.datetime(2024, 1, 1)
    o = [(i, 7 if i < 120 else i % 200, "FOP"[i % 3], 10.0 + i, day + datetime.timedelta(days=i % 50), "1-URGENT") for i in range(400)]
    spark.createDataFrame(o, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
                             "o_orderpriority string").write.parquet(str(tmp_path / "t" / "orders.parquet"))
    e = [(i, day + datetime.timedelta(seconds=37 * i), 3 if i < 150 else i % 120, "view", 1.0 + i % 90, '{"k": 1}') for i in range(500)]
    spark.createDataFrame(e, "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
                          ).write.parquet(str(tmp_path / "t" / "events.parquet"))
    sf, folders = str(tmp_path / "t"), []
    monkeypatch.setattr(Q, "scratch_dir", lambda spark, name: folders.append(str(tmp_path / name)) or folders[-1])
    log = q_scan_experiment_log(spark, sf)
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, experiment_log(spark, sf).select(*log.columns).collect()))
    steps = {(r["run"], r["step"]) for r in step_table(spark, sf).collect()}
    assert {(r["run"], r["step"]) for r in q_scan_run_log(spark, sf).collect()} == steps
    last = {run: max(s for r, s in steps if r == run) for run, _ in steps}
    got = {(r["run"], r["from_end"], r["step"]) for r in q_tail_log_lines(spark, sf).collect()}
    assert got == {(r, last[r] - s + 1, s) for r, s in steps if s > last[r] - 50}
    assert len(folders) == 3
    for f in folders:
        assert 0 < len(glob.glob(f + "/logs/**/part-*", recursive=True)) <= 40


# --------------------------------------------------------------------------- load_dir

def test_files_of_one_task_are_bounded(spark, tmp_path, monkeypatch):
    """JSON, CSV and zip files that one task must read do not grow with the table, and no row is lost."""
    import glob
    import os
    from quarry.plans.catalog import file_queries as Q
    text = lambda i: f"row {i} " + "words of a text " * 30
    docs = [(i, text(i), "en", "s", 500) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "t" / "documents.parquet"))
    spark.createDataFrame([(i, 0, "user", text(i)) for i in range(90)], "conv_id long, turn long, role string, text string"
                          ).coalesce(1).write.parquet(str(tmp_path / "t" / "conversations.parquet"))
    spark.createDataFrame([(i, f"http://x/{i}", f"<p>{text(i)}\n</p>") for i in range(90)], "page_id long, url string, html string"
                          ).coalesce(1).write.parquet(str(tmp_path / "t" / "pages.parquet"))
    folders = []
    monkeypatch.setattr(Q, "scratch_dir", lambda spark, name: folders.append(str(tmp_path / f"{name}{len(folders)}")) or folders[-1])
    monkeypatch.setattr(Q, "FILE_BYTES", 10_000)
    rows = Q.q_load_dir(spark, str(tmp_path / "t")).collect()
    count = lambda k: sum(r["folder"] == k and not r["failed"] for r in rows)
    assert [count(k) for k in ("docs", "cases", "pages", "zips")] == [20, 90, 90, 90]
    assert sorted(r["folder"] for r in rows if r["failed"]) == ["broken-cases", "broken-docs", "broken-zips"]
    for suffix in ("json", "csv", "zip"):
        sizes = [os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/**/*.{suffix}", recursive=True)]
        assert len(sizes) > 3 and max(sizes) < 40_000


# --------------------------------------------------------------------------- toxicity

def test_every_labelled_row_trains_or_calibrates(spark, monkeypatch):
    """what only rows outside the sample show is learned; rounds and calibration read all labelled rows."""
    from quarry.llm import toxicity as X
    monkeypatch.setattr(X, "MAX_PER_CLASS", 60)
    monkeypatch.setattr(X, "LABELS_A_TASK", 700)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    ids = X.labelled_ids(labels, labels, "doc_id", "toxic")
    first = {r["doc_id"] for r in X.start_ids(ids.where(F.pmod("h", F.lit(X.PARTS)) != 0), "doc_id").collect()}
    assert len(first) == 120
    r = np.random.default_rng(3)
    words = lambda: " ".join("".join(r.choice(list("abcdeo"), 5)) for _ in range(8))
    mark = lambda i: "" if i % 2 == 0 else "zzvile" if i in first or i % 4 == 1 else "qqgrim"
    docs = spark.createDataFrame([(i, f"{words()} {mark(i)} {words()}", "en") for i in range(3500)], "doc_id long, text string, lang string")
    read, train_round, calibrate = [], X.train_round, X.calibrate
    monkeypatch.setattr(X, "train_round", lambda rows, net: read.append(train_round(rows, net)))
    monkeypatch.setattr(X, "calibrate", lambda net, rows: (read.append(rows.count()), calibrate(net, rows)))
    net = X.fit(docs, labels)
    assert len(read) == X.ROUNDS + 1 and sum(read) == 3000 and min(read) > 500
    s = X.Scorer(net)
    clean = np.array([s.score(words()) for _ in range(100)])
    assert np.mean(clean < 0.5) > 0.95
    for mark in ("zzvile", "qqgrim"):
        assert np.mean([s.score(f"{words()} {mark} {words()}") > 0.5 for _ in range(100)]) > 0.95
    assert 0 < net.thresholds["en"] < 1


def test_thresholds_are_the_cuts_with_the_best_f1(spark):
    """by running sums over the grid, against all cuts tried one by one."""
    from quarry.llm import toxicity as X
    r = np.random.default_rng(5)
    rows = [("abc"[i % 3], int(y), round(float(r.integers(0, 60) + 30 * y) / 100, 2)) for i, y in enumerate(r.random(900) < 0.2)]
    rows += [("few", 1, 0.2), ("few", 0, 0.1)]
    got = {x["_lang"]: x["best"]["cut"] for x in X.thresholds(spark.createDataFrame(rows, "_lang string, y int, s double")).collect()}
    assert set(got) == set("abc")
    for lang in "abc":
        y, s = (np.array([x[i] for x in rows if x[0] == lang]) for i in (1, 2))
        v = np.unique(s)
        cuts = np.concatenate([[0.5], (v[1:] + v[:-1]) / 2])
        f1 = [2 * (y * (s >= c)).sum() / max(1, (s >= c).sum() + y.sum()) for c in cuts]
        assert abs(got[lang] - max(zip(f1, -np.abs(cuts - 0.5), cuts))[2]) < 1e-9


# --------------------------------------------------------------------------- byte_bpe

def test_encoding_and_decoding_share_a_worker(spark):
    """pipeline, byte_bpe: one pass through Python gives what the two operators give one after the other."""
    import public_tokenizers
    from quarry.llm import bpe
    from quarry.llm.q_bpe import RANKS
    model = bpe.load_model(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    texts = [None, "", "one", "Tie tie", "a\x00b c İΣ 漢字 😀 é.", "long text " * 3000] + [f"row {i}" for i in range(1500)]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, decoded string")
    got = bpe.encode_and_decode(docs, model)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows = lambda df: sorted(((r["doc_id"] or -1, r["token_ids"], bytes(r["decoded"])) for r in df.collect()), key=lambda r: r[0])
    assert rows(got) == rows(bpe.decode(bpe.encode(docs, model), model))
    assert sorted(d for _, _, d in rows(got)) == sorted((t or "").encode() for t in texts)


# --------------------------------------------------------------------------- encoding

def test_a_batch_encodes_a_distinct_piece_once(monkeypatch):
    """Rows are put together by arrays; null, empty and repeated rows, with and without BOS."""
    from types import SimpleNamespace

    import pyarrow as pa
    from quarry.operators import bpe
    tok = bpe.Tokenizer(merges=[(97, 98), (256, 99), (32, 256)])
    calls, one = [], bpe.encode_piece
    monkeypatch.setattr(bpe, "encode_piece", lambda data, ranks: calls.append(data) or one(data, ranks))
    rows = [["abc", " ab", "é"], None, [], ["x"], ["abc", "abc"], None, ["é", " ab", "xyz"]]
    batch = pa.array([["cut", "off"], *rows], pa.list_(pa.string())).slice(1)
    for bos in (None, tok.bos_id):
        want = [None if r is None else [*([] if bos is None else [bos]), *(i for p in r for i in one(p.encode(), tok.ranks()))] for r in rows]
        calls.clear()
        run = bpe._encoder(SimpleNamespace(value=tok.ranks()), bos)
        got = list(run(iter([batch, batch, batch.slice(0, 0)])))
        assert got[0].to_pylist() == want and got[1].to_pylist() == want and len(got[2]) == 0
        assert sorted(calls) == sorted({p.encode() for r in rows if r for p in r})
