"""op13: against cutting a list of units, the tree against plain sums, odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import fim
from quarry.llm.catalog import QUERIES

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def brute(text, key, seed=1, rate=90, spm=20):
    u = UNIT.findall(text or "")
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(u), "plain", None, None, text or ""
    if h4 % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_tree_against_sums():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        counts = r.integers(0, 4, (n, 2))
        tree, ends = fim.Fenwick(counts), np.cumsum(counts[:, 0])
        for k in range(int(counts[:, 0].sum()) + 2):
            block = int(np.searchsorted(ends, k, side="right"))
            assert tree.descend(k) == (block, int(counts[:block, 0].sum()), int(counts[:block, 1].sum()))


@pytest.mark.parametrize("block", [1, 2, 3, 5, 64])
def test_cuts_against_units(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    r = random.Random(block)
    for _ in range(60):
        text = "".join(r.choice(["a", "Zq", " ", "\n", "é", "漢", "😀", "1", "[", "`", "{", "@", "words"]) for _ in range(r.randrange(40)))
        at, u = fim.Units(text.encode()), UNIT.findall(text)
        assert at.n == len(u)
        for k in range(len(u) + 1):
            head = "".join(u[:k])
            assert at.cut(k) == (len(head.encode()), len(head))


def test_odd_rows(odd, empty):
    got = fim.transform(odd.withColumn("output", F.lit("extra")).withColumn("n", F.lit("extra"))).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    want = [(r["doc_id"], *brute(r["text"], r["doc_id"]), r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    order = lambda rows: sorted(rows, key=repr)
    assert order([tuple(r) for r in got]) == order(want)
    assert fim.transform(empty).count() == 0


def test_forms_and_sentinels(spark):
    texts = ["<P>", "a<S>b", "<M", "<", "a<", "<P", "S>", "P><S", "one two three", "é" * 3000, "x" * 5000, "<<P<S<M>"]
    rows = [(100 * i + j, t) for i, t in enumerate(texts) for j in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fim.transform(docs).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    by = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert by == {i: (*brute(t, i), t) for i, t in rows}
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError):
        fim.Sentinels("<A", "<AB", "<C")
    with pytest.raises(ValueError):
        fim.Sentinels("[[p", "<s", "~m")
    marks = fim.Sentinels("[pre]", "\\suf", "~mid.*")
    out = fim.transform(docs, fim_rate=100, spm_rate=50, marks=marks)
    assert out.where(fim.restore(F.col("output"), F.col("form"), marks) == F.col("output")).count() == 0
    back = {r["doc_id"]: r["b"] for r in out.select("doc_id", fim.restore(F.col("output"), F.col("form"), marks).alias("b")).collect()}
    assert back == dict(rows)


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, p, m, out = brute(docs[r["doc_id"]], r["doc_id"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, p, m)
        assert r["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
