"""Sources and sinks on temporary files (FIXTURES §3, text source edge cases)."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from quarry.sources import shards as SH
from quarry.sources import tabular as TB
from quarry.sources.manifest import flag_suspect_files

LONG = "Patient presented with ulcerative colitis and " + "x" * 80


def test_csv_quoted_newlines_and_na(spark, tmp_path):
    p = tmp_path / "cases.csv"
    p.write_text('id,case_presentation,notes\n1,"line one\nline ""two"" ' + "y" * 100 + '",NA\n2,NA,short\n')
    docs = TB.delimited_docs(spark, str(p)).collect()
    assert len(docs) == 1 and 'line "two"' in docs[0]["text"] and "\n" in docs[0]["text"]


def test_tsv_fallback_to_string_columns(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("a\tb\n" + "z" * 60 + "\t" + "w" * 60 + "\n")
    docs = TB.delimited_docs(spark, str(p)).collect()
    assert docs[0]["text"] == "z" * 60 + "\n\n" + "w" * 60


def test_json_cases_list_only(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"abstract": LONG, "body": "tiny"}, {"text": "short"}]))
    (tmp_path / "obj.json").write_text(json.dumps({"abstract": LONG}))
    docs = TB.scan_json_cases(spark, str(tmp_path / "*.json")).collect()
    assert [d["text"] for d in docs] == [LONG]


def test_zip_members_and_quarantine(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.csv", "report,other\n" + LONG + ",1\n")
        z.writestr("b.tsv", "text\n" + LONG + "\n")
        z.writestr("c.json", json.dumps([{"discussion": LONG}]))
        z.writestr("ignored.txt", LONG)
    (tmp_path / "good.zip").write_bytes(buf.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"not a zip at all")
    good, bad = TB.quarantine(TB.scan_zip_members(spark, str(tmp_path / "*.zip")))
    assert sorted(r["member"] for r in good.collect()) == ["a.csv", "b.tsv", "c.json"]
    assert bad.count() == 1


def test_write_list_scan_split_and_once(spark, tmp_path):
    from quarry.operators.corpus import shard_assignment
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    a = shard_assignment(docs, docs_per_shard=100)
    root = str(tmp_path / "shards")
    SH.write_shards(a, root)
    (tmp_path / "shards" / "junk.tmp").write_text("x")
    train = SH.scan_split(spark, root, "train")
    assert train.count() == 300 - 50
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
    files = SH.list_shards(spark, root).collect()
    assert files and all(f["file_name"].endswith(".parquet") for f in files)
    out = str(tmp_path / "once")
    SH.materialize_once(docs.limit(3), out)
    assert SH.materialize_once(docs, out).count() == 3          # second write is skipped


def test_flag_suspect(spark):
    f = spark.createDataFrame([(1, 500, "application/zip"), (2, 50_000, "text/html"), (3, 50_000, None)],
                              "id int, size_bytes long, content_type string")
    assert [r["keep"] for r in flag_suspect_files(f).orderBy("id").collect()] == [False, False, True]


def test_prepare_corpus_observes_counts(spark, tmp_path):
    from quarry.plans.prepare import prepare_corpus
    a = spark.range(150).select(F.col("id").alias("doc_key"), F.repeat(F.lit("abc "), 30).alias("text"))
    b = spark.range(150, 260).select(F.col("id").alias("doc_key"), F.repeat(F.lit("xyz "), (F.col("id") % 40).cast("int")).alias("text"))
    counts = prepare_corpus({"a": a, "b": b}, str(tmp_path / "out"), docs_per_shard=100)
    long_b = sum(1 for i in range(150, 260) if 4 * (i % 40) > 100)
    assert counts["n_docs"] == 150 + long_b and counts["n_val"] == 50
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == counts["n_docs"] and set(back.columns) >= {"text", "source", "split", "shard"}


def test_results_log_in_many_files_and_splits(spark, tmp_path):
    """One log over several files, each read in several splits, keeps its line order."""
    from pyspark.sql import functions as F
    from quarry.sources.tabular import scan_experiment_logs
    want = [f"c{i:05d}" for i in range(3000)]
    (tmp_path / "run=7").mkdir()
    for k in range(3):
        body = [f"{c}\t1.0\t2.0\tkeep\tnote" for c in want[k * 1000:(k + 1) * 1000]]
        head = ["commit\tval_bpb\tmemory_gb\tstatus\tdescription"] if k == 0 else []
        (tmp_path / "run=7" / f"part-{k:05d}.txt").write_text("\r\n".join(head + body) + "\r\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        logs = scan_experiment_logs(spark, str(tmp_path), F.regexp_extract("run", r"run=([0-9]+)/", 1).cast("long"))
        got = logs.orderBy("idx").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["run"], r["idx"], r["commit"], r["description"]) for r in got] == [(7, i, c, "note") for i, c in enumerate(want)]


def test_a_train_shard_is_one_file(spark, tmp_path):
    """Whatever the ranges and partitions; the validation shard is spread over tasks."""
    from quarry.operators.corpus import shard_assignment
    from quarry.sources.shards import list_shards, scan_split, write_shards
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(7)
    root = str(tmp_path / "corpus")
    assigned = shard_assignment(docs, fraction=0.5, docs_per_shard=100)
    write_shards(assigned, root, columns=("doc_id", "text"), docs_per_file=400)
    files = [r["file_path"].split("corpus/")[1].rsplit("/", 1)[0] for r in list_shards(spark, root).collect()]
    train = [f for f in files if "split=train" in f]
    assert sorted(train) == sorted({f"split=train/shard={i}" for i in range(15)})
    assert 1 < sum("split=val" in f for f in files) <= 4
    assert scan_split(spark, root, "train").count() == 1500 == scan_split(spark, root, "val").count()
    stored = {(r["shard"], r["doc_id"]) for r in scan_split(spark, root, "train").collect()}
    assert stored == {(r["shard"], r["doc_id"]) for r in assigned.where("split = 'train'").collect()}
