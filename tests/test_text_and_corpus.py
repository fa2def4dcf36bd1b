"""Text rules (strip, NA words, keywords, lengths), budget and split sizes (FIXTURES §3)."""

from pyspark.sql import functions as F

from quarry.functions.text import combine_texts, contains_any, py_strip
from quarry.operators import corpus as C
from quarry.operators import text_ops as TX
from quarry.constants import IBD_KEYWORDS


def test_strip_matches_python(spark):
    samples = ["\t padded ", "　x ", "\x1cy\x1f", "no-op", ""]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    assert got == [s.strip() for s in samples]


def test_combine_drops_nan_and_blank(spark):
    df = spark.createDataFrame([("nan", "  x  ", None, "\t")], "a string, b string, c string, d string")
    assert df.select(combine_texts(["a", "b", "c", "d"])).first()[0] == "x"


def test_keywords(spark):
    rows = ["patient with ibd and", "ibd at start", "ends with ibd.", "Crohn's Disease here", "none"]
    df = spark.createDataFrame([(r,) for r in rows], "text string")
    got = [r[0] for r in df.select(contains_any("text", IBD_KEYWORDS)).collect()]
    assert got == [True, False, False, True, False]


def test_lengths_and_cases(spark):
    df = spark.createDataFrame([("a" * 100,), ("a" * 101,)], "text string")
    assert TX.filter_min_length(df).count() == 1
    rep = spark.createDataFrame([(1, " " + "r" * 80 + " "), (2, "r" * 81), (3, None)], "id int, report_text string")
    assert [r["id"] for r in TX.report_texts(rep, ["id"]).collect()] == [2]
    cases = spark.createDataFrame([(1, None), (2, []), (3, [("c" * 101,), ("short",)])],
                                  "id int, cases array<struct<case_text:string>>")
    assert [r["id"] for r in TX.explode_cases(cases, ["id"]).collect()] == [3]


def test_char_budget(spark):
    df = spark.createDataFrame([(1, "aaaa"), (2, "bbbb"), (3, "cccc")], "doc_id long, text string")
    for budget, expect in ((8, [1, 2]), (7, [1, 2]), (9, [1, 2, 3])):
        got = sorted(r["doc_id"] for r in C.char_budget(df, "doc_id", F.length("text"), budget).collect())
        assert got == expect


def test_split_sizes(spark):
    for n, n_val in ((40, 40), (200, 50), (1000, 100)):
        df = spark.range(n).withColumnRenamed("id", "doc_id")
        a = C.shard_assignment(df, docs_per_shard=100)
        counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
        assert counts.get("val", 0) == n_val and counts.get("train", 0) == n - n_val
        if n == 1000:
            assert a.where("split = 'train'").agg(F.max("shard")).first()[0] == 8
