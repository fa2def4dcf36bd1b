"""op5: held-out accuracy, folds, edge cases."""

import zlib

import numpy as np
import pytest

from quarry.llm import toxicity as X
from quarry.llm.q_toxicity import op5_toxicity
from quarry.session import read_table

from .conftest import by_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op5_toxicity(spark, sf).join(read_table(spark, sf, "labels", "doc_id", "toxic"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["rejected"] == (r["score"] >= r["threshold"])
    held = [r for r in rows if r["held_out"]]
    tox, clean = ([r["score"] for r in held if r["toxic"] == y] for y in (1, 0))
    auc = np.mean(np.array(tox)[:, None] > np.array(clean)[None])
    assert auc > 0.95
    assert np.mean(np.array(tox) >= 0.5) > 0.75 and np.mean(np.array(clean) >= 0.5) < 0.01


@pytest.fixture(scope="module")
def net():
    r = np.random.default_rng(1)
    word = lambda: "".join(r.choice(list("abcdeo"), 5))
    docs = [" ".join(["zzvile" if i % 2 and j == 3 else word() for j in range(12)]) for i in range(400)]
    return X.train(docs, np.arange(400, dtype="f4") % 2)


def test_learns_and_reads_whole_texts(net):
    s = X.Scorer(net)
    clean = "abode decode " * 60_000
    assert s.score(clean + "zzvile") > s.score(clean) + 0.2          # the word stands after 120,000 others
    assert s.score("zzvile") == X.Scorer(net).score("zzvile")


def test_blocks_and_cache_do_not_change_a_score(net, monkeypatch):
    r = np.random.default_rng(2)
    text = " ".join("".join(r.choice(list("abcdeo"), 4)) for _ in range(500))
    want = X.Scorer(net).logit(text)
    monkeypatch.setattr(X, "BLOCK", 7)
    monkeypatch.setattr(X, "CACHED_WORDS", 11)
    assert abs(X.Scorer(net).logit(text) - want) < 1e-4


def test_edges(spark, odd, empty, net):
    rows = X.score(odd, net, keep=("doc_id", "lang", "score")).collect()      # the clashing column is replaced
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    one = by_id(rows)
    assert one[0]["score"] == one[1]["score"] == one[2]["score"]
    assert one[4]["score"] == one[5]["score"]
    assert X.score(empty, net).count() == 0


def test_labels_that_teach_nothing(spark, odd, empty):
    none = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id bigint, toxic int")
    for docs, labels in ((odd, none), (odd, one), (empty, one)):
        net = X.fit(docs, labels)
        assert len({r["score"] for r in X.score(odd, net).collect()}) == 1


def test_a_repeated_labelled_id_is_one_row(spark):
    """What goes to the driver to train is a row an id, the same however the rows are dealt."""
    from quarry.llm.toxicity import one_row_an_id
    rows = [(1, f"text {i % 7}", "en", 1, "train") for i in range(500)] + [(2, None, None, 0, "train"), (3, "c", "de", 0, "calibrate")]
    df = spark.createDataFrame(rows, "doc_id bigint, _text string, _lang string, y int, use string")
    got = [sorted(map(tuple, one_row_an_id(df.repartition(n), "doc_id").collect())) for n in (1, 5)]
    assert got[0] == got[1] and [r[0] for r in got[0]] == [1, 2, 3] and got[0][1][1] is None


def plain_logit(net, text):
    """The network word by word, as its formula says."""
    words = X.WORD.findall(text)
    vecs = []
    for w in words:
        flat, sizes = X.features([w])
        vecs.append(sum(net.emb[f].astype(float) for f in flat) / np.sqrt(sizes[0]))
    vecs += [np.zeros(X.DIM)] * (2 * X.PAD)
    pooled = []
    for k, f in enumerate(net.filters):
        best = [max(sum(float(vecs[i + j] @ f[j, :, c]) for j in range(len(f))) for i in range(len(words) + X.PAD)) for c in range(X.FILTERS)]
        pooled += [max(0.0, b + float(net.bias[k, c])) for c, b in enumerate(best)]
    return float(np.array(pooled) @ net.out + net.out_bias)


@pytest.mark.parametrize("text", ["", "one", "zzvile abode", "abode decode code bead zzvile bad cab dab", "a bc def ghij klmno"])
def test_scores_against_a_plain_forward_pass(net, text):
    assert abs(X.Scorer(net).logit(text) - plain_logit(net, text)) < 1e-3


def test_winners_are_first_largest_positions():
    r = np.random.default_rng(4)
    h = r.integers(0, 4, (50, X.FILTERS)).astype("f4")
    starts, size = np.array([0, 3, 20]), np.array([3, 17, 30])
    top, wins = X._winners(h, starts, size)
    for t, (a, n) in enumerate(zip(starts, size)):
        assert (top[t] == h[a:a + n].max(0)).all() and (wins[t] == a + h[a:a + n].argmax(0)).all()


def test_a_round_averages_the_tasks_changes(spark):
    """The sum by parts is that of the tasks' whole changes, and none of them goes through the RDD interface's workers."""
    words = ["zzvile", "abode", "decode", "code", "bead"]
    docs = [(" ".join(words[(i + j) % 5] for j in range(6 + i % 3)), i % 2) for i in range(300)]
    learner = X.start([t for t, _ in docs[:100]], np.array([y for _, y in docs[:100]], np.float32))
    before, net = learner.state(), learner.net
    rows = spark.createDataFrame(docs, "_text string, y int").repartition(3).cache()
    want, n = 0.0, 0
    for part in rows.rdd.glom().collect():
        own = X.Learner(X.copy.deepcopy(net), X.copy.deepcopy(learner.squares))
        vocab = X.Vocabulary()
        parts = [X._tokens(r["_text"], vocab) for r in part]
        flat, ends = X._vocabulary_features(vocab.new)
        order, y = np.random.default_rng(7).permutation(len(parts)), np.array([r["y"] for r in part], "f4")
        for at in range(0, len(order), X.BATCH):
            own.learn([parts[i] for i in order[at:at + X.BATCH]], y[order[at:at + X.BATCH]], flat, ends)
        want, n = want + (own.state() - before) * len(part), n + len(part)
    assert X.train_round(rows, learner) == n == 300
    assert np.allclose(learner.state(), before + want / n, rtol=1e-5, atol=1e-7) and np.any(learner.state() != before)
    assert X.train_round(rows.where("false"), learner) == 0


def test_a_round_never_holds_two_python_workers_a_core(spark, monkeypatch):
    """The changes are summed behind a shuffle: an RDD of Python's own would read them beside the training worker."""
    from pyspark import RDD
    learner = X.start(["zzvile abode"] * 8, np.arange(8, dtype="f4") % 2)
    rows = spark.createDataFrame([("zzvile code", i % 2) for i in range(20)], "_text string, y int")
    monkeypatch.setattr(RDD, "treeAggregate", lambda *a, **b: pytest.fail("an RDD's workers sum the changes"))
    assert X.train_round(rows, learner) == 20
