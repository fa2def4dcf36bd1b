"""op2: rates against a plain projected gradient, targets, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing as M
from quarry.llm.q_mixing import WEIGHTS, labelled, op2_mixing
from quarry.session import read_table

from .conftest import by_id


def plain_rates(p, t, w, budget, limit, rounds=20_000):
    """Projected gradient in r·sqrt(t) with a small step, to convergence."""
    base = t @ p
    target = budget * np.array(w)
    r = np.ones(len(t))
    for _ in range(rounds):
        r = np.clip(r - 0.5 * (p @ (((r * t) @ p - target) / base)), 0, limit)
    return r


def test_query_meets_the_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = op2_mixing(spark, sf)
    assert rows.columns[:7] == ["doc_id", "tokens", "p_de", "p_en", "p_es", "p_fr", "rate"]
    assert rows.columns[7:] == [f"{x}_{d}" for x in ("target", "reached") for d in ("de", "en", "es", "fr")]
    r = rows.toPandas()
    total = r["tokens"].sum()
    for d, w in WEIGHTS.items():
        assert np.allclose(r[f"target_{d}"], w * total)
        assert np.allclose(r[f"reached_{d}"], (r["tokens"] * r["rate"] * r[f"p_{d}"]).sum())
    for d, w in WEIGHTS.items():
        assert abs((r["tokens"] * r["rate"] * r[f"p_{d}"]).sum() - w * total) < 1e-4 * total
    assert (r["rate"] >= 0).all() and np.allclose(r[[f"p_{d}" for d in WEIGHTS]].sum(1), 1)
    lang = read_table(spark, sf, "documents", "doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    best = r.set_index("doc_id")[[f"p_{d}" for d in WEIGHTS]].idxmax(axis=1).str[2:]
    assert (best == lang[best.index]).mean() > 0.95


@pytest.mark.parametrize("limit", [M.MAX_RATE, 2.0])
@pytest.mark.parametrize("weights", [(0.5, 0.3, 0.2), (0.98, 0.02, 0.0), (0.0, 0.0, 1.0)])
def test_rates_against_plain_gradient(spark, weights, limit):
    r = np.random.default_rng(0)
    t = r.integers(1, 200, 60).astype(float)
    p = r.dirichlet([0.4, 0.4, 0.4], 60)
    rows = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(t, p))], "doc_id bigint, tokens bigint, p array<double>").coalesce(1).cache()
    w = dict(zip("abc", weights))
    steps, target, got = M.fit_rates(rows, list("abc"), w, limit=limit)
    mine = np.array([x["r"] for x in rows.withColumn("r", M.fold_rates(F.col("p"), steps, limit)["r"]).orderBy("doc_id").collect()])
    want = plain_rates(p, t, weights, t.sum(), limit)
    loss = lambda x: (((x * t) @ p - t.sum() * np.array(weights)) ** 2 / (t @ p)).sum()
    assert (mine >= 0).all() and (mine <= limit).all() and loss(mine) <= loss(want) + 2e-3 * loss(np.ones(60))
    assert np.allclose(list(got.values()), (mine * t) @ p)


def test_keep_budget_shrinks_no_domain(spark):
    p = [[1.0, 0.0]] * 30 + [[0.0, 1.0]] * 10
    rows = spark.createDataFrame([(i, 10, x) for i, x in enumerate(p)], "doc_id bigint, tokens bigint, p array<double>")
    steps, target, got = M.fit_rates(rows, ["a", "b"], {"a": 0.5, "b": 0.5}, "keep")
    assert target == {"a": 300.0, "b": 300.0}
    rates = [x["r"] for x in rows.select(M.fold_rates(F.col("p"), steps)["r"].alias("r")).collect()]
    assert np.allclose(sorted(rates), [1.0] * 30 + [3.0] * 10)


def test_unreachable_targets_stay_within_the_limit(spark):
    """A domain of which there is nearly nothing cannot be conjured up."""
    rows = spark.createDataFrame([(i, 100, [1 - 1e-9, 1e-9]) for i in range(20)], "doc_id bigint, tokens bigint, p array<double>")
    steps, _, got = M.fit_rates(rows, ["a", "b"], {"a": 0.5, "b": 0.5}, "keep", limit=4)
    rates = [x["r"] for x in rows.select(M.fold_rates(F.col("p"), steps, 4)["r"].alias("r")).collect()]
    assert all(0 <= r <= 4 for r in rates) and M.repeat_by_rate(rows.withColumn("rate", F.lit(max(rates)))).count() <= 80


def test_repeats_follow_the_rate(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1.3).alias("rate"), F.lit("x").alias("time"))
    out = M.repeat_by_rate(df)
    n = out.groupBy("doc_id").count().agg(F.min("count"), F.max("count"), F.sum("count")).first()
    assert n[0] == 1 and n[1] == 2 and abs(n[2] / 20_000 - 1.3) < 0.02 and out.columns == df.columns
    assert M.repeat_by_rate(df.withColumn("rate", F.lit(0.0))).count() == 0
    assert M.repeat_by_rate(df.withColumn("rate", F.lit(3.0))).count() == 60_000


def test_no_python_on_the_main_path(spark, sf):
    plan = op2_mixing(spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_edges(spark, odd, empty, sf):
    lab = labelled(spark, sf)
    rows, domains, _, _ = M.mix(odd, lab, WEIGHTS, keep=odd.columns)
    got = rows.collect()
    assert len(got) == odd.count() and domains == ["de", "en", "es", "fr"]
    one = by_id(got)
    assert one[0]["tokens"] == one[1]["tokens"] == 0 and one[7]["tokens"] == 80_000
    assert one[0]["p"] == one[1]["p"] and one[4]["rate"] == one[5]["rate"] and one[3]["row"] == "extra"
    assert all(r["rate"] >= 0 and abs(sum(r["p"]) - 1) < 1e-9 for r in got)
    assert one[0]["rate"] == one[1]["rate"] == one[2]["rate"] == 1.0          # no tokens
    assert M.mix(empty, lab, WEIGHTS)[0].count() == 0
    bounded, _, target, reached = M.mix(odd, lab, WEIGHTS, "keep", keep=odd.columns, floor=1.0, limit=M.MAX_RATE)
    assert bounded.agg(F.max("rate")).first()[0] <= M.MAX_RATE and reached["es"] < target["es"] / 2   # told, not hidden
    assert M.repeat_by_rate(bounded).where(F.length("text") > 10_000).count() <= 2 * M.MAX_RATE
    none = M.mix(odd, lab.where("false"), WEIGHTS)
    assert none[1] == [] and {r["rate"] for r in none[0].collect()} == {1.0}


def test_rare_domain_meets_its_target(spark, caplog):
    """One row in 200 is Spanish: its rate goes far beyond 16, with and without a floor of one."""
    words = {"en": "the house and the garden", "es": "la casa del jardin grande"}
    docs = [(i, words["es" if i % 200 == 0 else "en"]) for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, t, d) for i, (d, t) in enumerate(list(words.items()) * 50)], "doc_id bigint, text string, domain string")
    w = {"en": 0.7, "es": 0.3}
    for budget, floor in (("corpus", 0.0), ("keep", 1.0)):
        rows, domains, target, got = M.mix(df, lab, w, budget, floor=floor)
        assert all(abs(got[d] - target[d]) < 1e-3 * target[d] for d in domains)
        r = rows.agg(F.min("rate"), F.max("rate"), F.sum(F.col("rate") * F.col("tokens") * F.element_at("p", 2))).first()
        assert r[0] >= floor and r[1] > 50 and abs(r[2] - got["es"]) < 1e-6 * got["es"]
    assert not caplog.records
    M.mix(df, lab, w, limit=16.0)
    assert any("domain es" in x.getMessage() for x in caplog.records)


def test_work_of_a_round_does_not_grow(spark):
    """Whatever the round, it folds a few steps over one scan of the state; old states are deleted."""
    import os
    r = np.random.default_rng(1)
    t, p = r.integers(1, 99, 50), r.dirichlet([1, 1], 50)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens bigint, p array<double>")
    state, paths = M.State(rows, 2, M.NO_LIMIT, 0.0), set()
    steps = [[0.1 / k, -0.05, 0.5] for k in range(1, 2 * M.FOLDED + 3)]
    for s in steps:
        state.step(s[:2], s[2])
        paths.add(state.path)
        assert len(state.pending) <= M.FOLDED
    assert len(paths) == 3 and [os.path.exists(x.removeprefix("file:")) for x in sorted(paths)].count(True) == 1
    whole = rows.select(F.sum(F.col("tokens") * F.element_at("p", 1) * M.fold_rates(F.col("p"), steps)["r"])).first()[0]
    assert np.isclose(whole, state.totals[0])


def test_floor_is_part_of_the_fit(spark):
    """Rates of at least one whose totals meet the targets, though memberships are soft."""
    r = np.random.default_rng(5)
    t, p = r.integers(1, 200, 80).astype(float), r.dirichlet([0.6, 0.6, 0.6], 80)
    rows = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(t, p))], "doc_id bigint, tokens bigint, p array<double>").coalesce(1).cache()
    w = {"a": 0.6, "b": 0.3, "c": 0.1}
    top = M.MAX_RATE
    steps, target, got = M.fit_rates(rows, list("abc"), w, "keep", top, 1.0)
    mine = np.array([x["r"] for x in rows.withColumn("r", M.fold_rates(F.col("p"), steps, top, 1.0)["r"]).orderBy("doc_id").collect()])
    assert (mine >= 1).all() and np.allclose(list(got.values()), (mine * t) @ p)
    want = np.ones(80)
    goal = np.array([target[d] for d in "abc"])
    for _ in range(20_000):
        want = np.clip(want - 0.5 * (p @ (((want * t) @ p - goal) / (t @ p))), 1, top)
    loss = lambda x: (((x * t) @ p - goal) ** 2 / (t @ p)).sum()
    assert loss(mine) <= loss(want) + 2e-3 * loss(np.ones(80))
