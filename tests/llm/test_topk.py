"""op6: against brute force, ties, the stopping rule, edge cases."""

import numpy as np
import pytest

from quarry.llm import topk
from quarry.llm.common import written


def brute(ids, x, own, q, k):
    s = [(-int(v @ q), i) for i, v in zip(ids.tolist(), x) if i != own]
    return [(i, -n) for n, i in sorted(s)[:k]]


@pytest.mark.parametrize("span", [2, 40])               # few values: many ties
def test_lists_against_brute_force(span):
    r = np.random.default_rng(span)
    for n, d, k in ((1, 3, 5), (30, 4, 20), (700, 6, 10)):
        ids = r.permutation(10 * n)[:n]
        x = r.integers(-span, span, (n, d)).astype(float)
        lists = topk.Lists(ids, x)
        for q, own in [(np.zeros(d), -1), *((x[i], ids[i]) for i in range(min(n, 25)))]:
            got = lists.top(own, q, k)
            assert list(zip(got[0].tolist(), got[1].astype(int).tolist())) == brute(ids, x, own, q, k)


def test_stops_early():
    """One vector beats all others by far: the walk ends before the lists do."""
    n = 20_000
    x = np.random.default_rng(0).integers(-3, 4, (n, 4)).astype(float)
    x[7] = 1000
    lists = topk.Lists(np.arange(n), x)
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                seen.append(len(key))
            return super().__getitem__(key)

    lists.x = lists.x.view(Watched)
    assert lists.top(-1, np.ones(4), 1)[0].tolist() == [7]
    assert sum(seen) < 200


def test_search_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    r = np.random.default_rng(4)
    x = r.normal(0, 0.2, (300, 8))
    x[100:140] = x[0]                                    # equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [float("nan")] * 8), (1002, [float("inf")] + [0.0] * 7), (1003, [None] + [0.0] * 7),
             (None, [1.0] * 8), (1004, []), (1005, [0.5] * 3), (1006, [0.25] * 3), (5, x[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    v = written(topk.valid(df.selectExpr("*", "'x' AS id", "1 AS v", "'x' AS row"), "vec_id", "embedding"), "v")
    assert v.count() == 303                              # 300, a copy and the two of three dimensions
    got = {}
    for w in topk.search(v, v.where("id % 20 = 0 OR id = 1005"), 10).collect():
        got.setdefault(w["query_id"], []).append((w["rank"], w["vec_id"], w["score"]))
    ints = np.floor(64 * x).astype(int)
    ids, all_ints = np.append(np.arange(300), 5), np.vstack([ints, ints[5]])
    for q in range(0, 300, 20):
        want = brute(ids, all_ints, q, ints[q], 10)
        assert sorted(got[q]) == [(i + 1, *w) for i, w in enumerate(want)]
    assert got[1005] == [(1, 1006, 3 * 32 * 16)]
    assert topk.search(v.where("false"), v.where("false"), 10).count() == 0
    assert topk.search(v, v.where("false"), 10).count() == 0


def test_many_queries_walk_together():
    r = np.random.default_rng(9)
    for n, d, k in ((0, 3, 2), (1, 3, 5), (40, 4, 20), (900, 6, 10)):
        ids, rows = r.integers(0, max(1, n // 2), n), r.permutation(n)          # repeated ids
        x = r.integers(-3, 4, (n, d)).astype(float)
        q = np.vstack([r.integers(-3, 4, (30, d)), np.zeros((1, d)), 2 * np.eye(d)]).astype(float)
        own = r.integers(-1, n + 1, len(q))
        for one, mine, got in zip(q, own, topk.Lists(ids, x, rows).top_many(own, q, k)):
            want = sorted((-int(v @ one), i) for i, v, w in zip(ids.tolist(), x, rows.tolist()) if w != mine)[:k]
            assert [(-int(s), i) for i, s in zip(*map(np.ndarray.tolist, got))] == want


def test_rows_of_one_id_with_different_vectors_all_count(spark):
    rows = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [3.0, 0.0]), (5, [3.0, 0.0]), (20, [2.0, 0.0]), (20, [0.0, 1.0])]
    v = written(topk.valid(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding"), "v")
    got = sorted(tuple(r) for r in topk.search(v, v.where("id % 20 = 0"), 3).collect())
    s = 64 * 64
    assert got == sorted([(0, 1, 5, 3 * s), (0, 2, 5, 3 * s), (0, 3, 20, 2 * s), (20, 1, 5, 6 * s), (20, 2, 5, 6 * s), (20, 3, 0, 2 * s),
                          (20, 1, 0, 0), (20, 2, 5, 0), (20, 3, 5, 0)])
