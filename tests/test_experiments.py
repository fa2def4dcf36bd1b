"""Golden answers for the sample results log (FIXTURES §3) and its edge cases."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import experiments as X
from quarry.sources.tabular import scan_experiment_log

SAMPLE = """commit\tval_bpb\tmemory_gb\tstatus\tdescription
a1b2c3d\t0.997900\t44.0\tkeep\tbaseline
b2c3d4e\t0.993200\t44.2\tkeep\tincrease LR to 0.04
c3d4e5f\t1.005000\t44.0\tdiscard\tswitch to GeLU activation
d4e5f6g\t0.000000\t0.0\tcrash\tdouble model width (OOM)
"""


@pytest.fixture
def log(spark, tmp_path):
    p = tmp_path / "results.tsv"
    p.write_text(SAMPLE)
    return X.normalize_log(scan_experiment_log(spark, str(p)).withColumn("run", F.lit(1)))


def test_counts_rate_best(log):
    counts = {r["status"]: r["n"] for r in X.status_counts(log).collect()}
    assert counts == {"KEEP": 2, "DISCARD": 1, "CRASH": 1}
    kr = X.keep_rate(log).first()
    assert kr["keep_rate"] == pytest.approx(2 / 3)
    s = X.improvement_summary(log).first()
    assert s["baseline_raw"] == pytest.approx(0.9979) and s["best_bpb"] == pytest.approx(0.9932)
    assert s["best_idx"] == 1 and s["improvement"] == pytest.approx(0.0047)
    assert round(s["improvement_pct"], 4) == pytest.approx(0.4710, abs=1e-4)


def test_windows(log):
    rb = [r["running_best"] for r in X.running_best(log, chunk=1).orderBy("idx").collect()]
    assert rb == pytest.approx([0.9979, 0.9932])
    d = X.kept_deltas(log, chunk=1).collect()
    assert [round(r["delta"], 6) for r in d] == [0.0047]
    near = sorted(r["idx"] for r in X.filter_near_baseline(log, chunk=1).collect())
    assert near == [0, 1]
    dec = [r["decision"] for r in X.keep_decision(log, chunk=1).orderBy("idx").collect()]
    assert dec == ["keep", "keep", "discard", "crash"]


def test_edge_cases(spark, tmp_path):
    text = ("commit\tval_bpb\tmemory_gb\tstatus\tdescription\n"
            "x0\t0.0\t0.0\t CRASH\tfirst row crashed\n"
            "x1\t1.2\t1.0\t Keep \t" + "a" * 45 + "\n"
            "x2\tabc\t1.0\tdiscard\tbad number\n"
            "x3\t1.1\t1.0\tKEEP\t" + "b" * 46 + "\n"
            "x4\t1.1\t1.0\tkeep\ttie\n")
    p = tmp_path / "r.tsv"
    p.write_text(text)
    log = X.normalize_log(scan_experiment_log(spark, str(p)).withColumn("run", F.lit(7)))
    rows = log.orderBy("idx").collect()
    assert rows[1]["status"] == "KEEP" and rows[2]["val_bpb"] is None
    best = X.best_run(log).first()
    assert best["best_idx"] == 3                      # first of two equal minima
    s = X.improvement_summary(log).first()
    assert s["baseline_raw"] == 0.0 and s["baseline_valid"] == pytest.approx(1.2)
    labels = {r["idx"]: r["label"] for r in X.kept_labels(log).collect()}
    assert labels[1] == "a" * 45 and labels[3] == "b" * 42 + "..."
