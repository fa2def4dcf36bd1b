"""op1: counts against a plain count, votes against an own EM, edge cases."""

import re
from collections import Counter

import numpy as np

from quarry.llm import quality as Q
from quarry.llm.q_quality import op1_quality_rules
from quarry.session import read_table

from .conftest import LONG, by_id


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_query_against_plain_counts(spark, sf):
    got = by_id(op1_quality_rules(spark, sf).collect())
    docs = read_table(spark, sf, "documents", "doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        r, w = got[d["doc_id"]], plain(d["text"])
        assert tuple(r)[1:6] == w
        failed = w[0] < 50 or 100 * w[4] > 50 * w[0]
        assert r["base_failed"] == failed and (not r["kept"] or not failed)
        assert r["kept"] == (not failed and r["posterior"] >= 0.5)


def test_verdicts_agree_with_labels(spark):
    """The labels are not used by the method; its verdict must still find junk and spare the rest."""
    sf = "/root/testdata/sf0.01"
    rows = op1_quality_rules(spark, sf).where("not base_failed").join(read_table(spark, sf, "labels", "doc_id", "quality"), "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert n.get((1, True), 0) >= 0.98 * (n.get((1, True), 0) + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.1 * sum(v for (q, _), v in n.items() if q == 0)


def test_em_recovers_planted_rates():
    r = np.random.default_rng(0)
    good = r.random(20_000) < 0.8
    counts = Counter()
    for g in good:
        v = "".join("0" if r.random() < 0.1 else ("+" if (r.random() < (0.9 if g else 0.2)) else "-") for _ in range(5))
        counts[v] += 1
    m = Q.fit_votes(dict(counts), 5)
    assert abs(m.prior - 0.8) < 0.02
    assert np.allclose(m.rates[:, 1, 0], 0.81, atol=0.02) and np.allclose(m.rates[:, 0, 2], 0.72, atol=0.03)
    assert m.posterior(["+++++"])[0] > 0.99 and m.posterior(["-----"])[0] < 0.01


def test_repeated_words_recodes_large_vocabularies():
    ids = np.array([0, 1, 2, 9, 0, 1, 2])
    assert Q.repeated_words(ids, 10) == Q.repeated_words(ids, 2**40) == 6


def test_edges(spark, odd, empty):
    rows, _ = Q.judge(odd)
    got = rows.collect()
    assert len(got) == odd.count()
    one = by_id(got)
    assert one[0]["n_words"] == one[1]["n_words"] == one[2]["n_words"] == 0
    assert tuple(one[7][c] for c in Q.STATS[:5]) == plain(LONG)
    assert sum(r["doc_id"] == 5 for r in got) == 2
    assert Q.judge(empty)[0].count() == 0
