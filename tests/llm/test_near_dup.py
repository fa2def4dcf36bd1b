"""op9: classes against all pairs by brute force, registers against probabilities, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import near_dup as N
from quarry.llm import probminhash as pm
from quarry.llm.common import WORD
from quarry.llm.components import components
from quarry.llm.q_near_dup import op9_probminhash
from quarry.session import read_table

from .conftest import by_id


def brute_classes(texts):
    """Smallest id of each class, by the similarity of every pair that shares a shingle."""
    sets = {i: pm.shingles(t or "") for i, t in texts.items()}
    where, shared = {}, {}
    for i, (k, _) in sets.items():
        for h in k.tolist():
            for j in where.setdefault(h, []):
                shared[j, i] = shared.get((j, i), 0) + 1
            where[h].append(i)
    up = {i: i for i in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if n >= 0.3 * max(len(sets[a][0]), len(sets[b][0])) and max(pm.similarity(sets[a], sets[b])) >= 0.8:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: top(i) for i in texts}


def test_query_against_brute_force(spark, sf):
    got = {i: r["class_id"] for i, r in by_id(op9_probminhash(spark, sf).collect()).items()}
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents", "doc_id", "text").collect()}
    assert got == brute_classes(texts)
    assert len(set(got.values())) < len(got)


def words(r, n):
    return ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def test_hot_groups_and_chains(spark):
    """A large group of near copies, one of exact copies, chains whose ends are far apart, and
    strangers that share a long passage."""
    r = random.Random(3)
    base, passage = words(r, 200), words(r, 60)
    texts = {}
    for i in range(150):                                   # near copies: some pairs above, some below 0.8
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(200)] = "edit" + str(r.random())
        texts[i] = " ".join(w)
    for i in range(200, 260):
        texts[i] = "the same text in every copy of it, word for word"
    chain = words(r, 300)
    for i in range(300, 320):                              # each step changes six words
        chain = list(chain)
        for j in range(6):
            chain[(i * 13 + j) % 300] = f"c{i}x{j}"
        texts[i] = " ".join(chain)
    for i in range(400, 480):
        texts[i] = " ".join(passage + words(r, r.randint(15, 60)))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {i: x["class_id"] for i, x in by_id(N.near_duplicates(df).collect()).items()}
    assert got == brute_classes(texts)


def test_heavily_repeated_passages(spark):
    """Jaccard above 0.8, probability Jaccard about 0.5: alone with their plain text, and in groups
    of which neither side is a bucket's centre."""
    r = random.Random(11)
    texts = {}
    for i in range(0, 80, 2):
        w, passage = words(r, 204), words(r, 36)
        texts[i], texts[i + 1] = " ".join(w), " ".join(w + passage * 30)
    base, passage = words(r, 300), words(r, 40)
    for i in range(100, 160):
        w = list(base)
        for _ in range(r.randint(0, 8)):
            w[r.randrange(300)] = "edit" + str(r.random())
        texts[i] = " ".join(w + passage * r.choice((0, 0, 1, 3, 30)))
    sets = [pm.shingles(texts[i]) for i in (0, 1)]
    assert pm.similarity(*sets)[0] > 0.8 and pm.similarity(*sets)[1] < 0.6
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {i: x["class_id"] for i, x in by_id(N.near_duplicates(df).collect()).items()}
    assert got == brute_classes(texts)


def test_open_buckets_compare_unit_signatures(spark):
    """A plain text and one with a passage said thirty times, neither of them its bucket's centre."""
    r = random.Random(12)
    w, passage = words(r, 204), words(r, 36)
    texts = [(0, "a text of the largest component"), (1, " ".join(w)), (2, " ".join(w + passage * 30))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    sk = N.sketches(docs, "text", "doc_id").collect()
    shared = set(sk[1]["bands"]) & set(sk[2]["bands"])
    band = min(sk[1]["bands"].index(h) % pm.BANDS for h in shared)
    members = [(7, band, 0, 0), (7, band, 1, 1), (7, band, 2, 2), (7, band, 3, 0)]
    got = N.open_links(spark.createDataFrame(members, "bucket bigint, band int, id bigint, comp bigint"),
                       spark.createDataFrame([(x["id"], x["sig"]) for x in sk], "id bigint, sig binary"),
                       N.shingle_rows(docs, spark.range(4).select("id"), "text", "doc_id"), 0.8).collect()
    assert [(x["a"], x["b"]) for x in got] == [(2, 1)]


def test_open_buckets_unite_what_no_centre_links(spark, monkeypatch):
    """Links between members of which neither is their bucket's centre are found, block by block,
    and only as many as unite components."""
    monkeypatch.setattr(N, "BLOCK", 3)
    r = random.Random(9)
    base = words(r, 300)
    members, sigs, sets, texts = [], [], {}, []
    for i in range(12):
        w = list(base)
        for j in range(2 * i):                             # similarity falls along the row
            w[(j * 7) % 300] = f"e{i // 2}x{j}"
        texts.append((i, " ".join(w)))
        sets[i] = pm.shingles(texts[i][1])
        sig = pm.signatures([sets[i]])
        sigs.append((i, sig[0].tobytes()))
        members += [(int(h), band, i, 0 if i < 7 else i) for band, h in enumerate(pm.band_hashes(sig)[0])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = N.shingle_rows(docs, spark.range(12).select("id"), "text", "doc_id")
    got = N.open_links(spark.createDataFrame(members, "bucket bigint, band int, id bigint, comp bigint"),
                       spark.createDataFrame(sigs, "id bigint, sig binary"), rows, 0.8).collect()
    links = {(x["b"], x["a"]) for x in got}
    real = {(a, b) for a in range(12) for b in range(a + 1, 12) if max(pm.similarity(sets[a], sets[b])) >= 0.8}
    assert links <= real and all(b >= 7 for _, b in links)
    up = {i: 0 if i < 7 else i for i in range(12)}

    def united(pairs):
        label = dict(up)
        for a, b in pairs:
            x, y = label[a], label[b]
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
        return label

    assert united(links) == united(real) != up


def test_registers_agree_as_often_as_the_probability_jaccard():
    r = np.random.default_rng(0)
    keys = r.integers(0, 2**63, 60).astype(np.uint64)
    a = (np.sort(keys[:45]), r.integers(1, 9, 45))
    b = (np.sort(keys[10:]), r.integers(1, 9, 50))
    jp = pm.similarity(a, b)[1]
    m = 20_000
    sig = pm.signatures([a, b], m)
    assert abs((sig[0] == sig[1]).mean() - jp) < 4 * (jp * (1 - jp) / m) ** 0.5


def test_similarities_by_definition():
    r = np.random.default_rng(1)
    keys = np.arange(30, dtype=np.uint64)
    a, b = (keys[:20], r.integers(1, 5, 20)), (keys[8:], r.integers(1, 5, 22))
    x, y = np.zeros(30), np.zeros(30)
    x[:20], y[8:] = pm.weights(a[1]), pm.weights(b[1])
    want = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(30)) for i in range(8, 20))
    j, jp = pm.similarity(a, b)
    assert j == 12 / 30 and abs(jp - want) < 1e-12
    assert pm.similarity(a, a) == (1.0, pytest.approx(1.0))


def test_a_signature_does_not_depend_on_its_batch():
    sets = [pm.shingles(" ".join(words(random.Random(i), n))) for i, n in enumerate((1, 3, 5, 40, 700))]
    together = pm.signatures(sets)
    for s, row in zip(sets, together):
        assert (pm.signatures([s])[0] == row).all()


def test_words_are_told_apart():
    texts = ["a b", "b a", "ab", "a  b", " a\tb\n", "", " \n", "é e", "x" * 9000 + " x", "x" * 9001, "a\x85b", "a b"]
    for t in texts:
        assert len(pm.word_hashes(t)) == len(WORD.findall(t))
    assert (pm.word_hashes("a b") == pm.word_hashes(" a\tb\n")).all()
    words = {w for i in range(3000) for w in (f"w{i}", f"{i}w", "x" * i)} - {""}
    assert len(set(pm.word_hashes(" ".join(sorted(words))).tolist())) == len(words)


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3), (5, 4)]
    edges += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(70)]
    r.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {x["node"]: x["label"] for x in components(df, "a", "b").collect()}
    up = {n: n for e in edges for n in e if n is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    assert got == {n: top(n) for n in up if n != 200}
    assert components(df.where("false"), "a", "b").count() == 0


def test_edges(spark, odd, empty):
    rows = N.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = by_id(rows)
    assert got[4]["class_id"] == got[5]["class_id"] == 4          # equal texts, one of them twice
    assert [got[i]["class_id"] for i in (0, 1, 2, 3)] == [0, 1, 2, 3] and got[0]["n_shingles"] == 0
    assert sum(r["doc_id"] is None and r["class_id"] is None for r in rows) == 2
    assert N.near_duplicates(empty).count() == 0
    both = spark.createDataFrame([(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "a b c d e f")], "doc_id bigint, text string")
    assert {r["class_id"] for r in N.near_duplicates(both).collect()} == {1}


def test_rows_of_one_id_with_different_texts(spark):
    r = random.Random(12)
    a, b, c = (" ".join(words(r, 60)) for _ in range(3))
    near = lambda t: f"{t} tail"
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, c), (4, c), (None, a), (5, None), (5, c), (6, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("digest", F.lit("extra"))
    got = sorted(((x["doc_id"], x["class_id"]) for x in N.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, None), (5, 4), (5, 4), (6, 6)], key=str)
    kept = sorted(((x["doc_id"], x["text"]) for x in N.one_of_each_class(df).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (4, c), (None, a), (5, None), (6, "")], key=str)
    assert N.one_of_each_class(df).columns == df.columns


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """Pipeline, memory of the driver: rounds end when all components are stars, and none confirms it."""
    from quarry.llm import components as C
    tables = []
    monkeypatch.setattr(C, "written", lambda df, name: tables.append(name) or df.localCheckpoint())
    stars = spark.createDataFrame([(1, 5), (1, 6), (7, 1), (20, 10), (3, 3), (None, 1)], "a bigint, b bigint")
    got = {x["node"]: x["label"] for x in components(stars, "a", "b").collect()}
    assert got == {1: 1, 5: 1, 6: 1, 7: 1, 10: 10, 20: 10} and len(tables) == 1
    tables.clear()
    centre_last = spark.createDataFrame([(9, i) for i in range(9)], "a bigint, b bigint")
    assert {x["label"] for x in components(centre_last, "a", "b").collect()} == {0} and len(tables) == 2
    tables.clear()
    assert components(stars.where("false"), "a", "b").count() == 0 and len(tables) == 1
