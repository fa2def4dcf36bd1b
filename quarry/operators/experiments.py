"""Experiment-log analytics.

A log has one row per experiment: ``run`` (which log / branch it belongs to), ``idx`` (its
position in the log, dense from 0), ``commit``, ``val_bpb``, ``memory_gb``, ``status`` and
``description``.  The reference analyses one log; every operator here works per ``run`` for
any number of logs.  Ordered steps (running best, renumbering, deltas, ranks) use the
skew-safe scans of ``quarry.operators.scan``: a run that holds a third of all rows is still
spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.constants import (AXIS_MARGIN, NEAR_BASELINE_MARGIN, STATUS_CRASH, STATUS_DISCARD,
                              STATUS_KEEP)
from quarry.functions.text import normalize_status, shorten_label, to_double
from quarry.operators.scan import DEFAULT_CHUNK, dense_index, prefix_scan, top_k_per_group

KEYS = ("run",)


def normalize_log(raw: DataFrame) -> DataFrame:
    """B12 + B13: numbers coerced (bad → null), status stripped and upper-cased."""
    return (raw.withColumn("val_bpb", to_double("val_bpb"))
               .withColumn("memory_gb", to_double("memory_gb"))
               .withColumn("status", normalize_status("status")))


def is_status(status: str) -> Column:
    return F.col("status") == F.lit(status)


def not_crash() -> Column:
    """pandas ``status != 'CRASH'`` keeps null status: a null-safe inequality."""
    return ~F.col("status").eqNullSafe(F.lit(STATUS_CRASH))


def filter_status(log: DataFrame, status: str = STATUS_KEEP) -> DataFrame:
    """Rows with the given status."""
    return log.where(is_status(status))


def valid_rows(log: DataFrame) -> DataFrame:
    """Rows that did not crash (null status stays, as in pandas)."""
    return log.where(not_crash())


def status_counts(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """C3 ``value_counts``: per status, nulls left out."""
    return (log.where(F.col("status").isNotNull())
               .groupBy(*keys, "status").agg(F.count(F.lit(1)).alias("n")))


def keep_rate(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """C4: keep / (keep + discard), null when nothing was decided."""
    agg = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(is_status(STATUS_KEEP)).alias("n_keep"),
        F.count_if(is_status(STATUS_DISCARD)).alias("n_discard"),
        F.count_if(is_status(STATUS_CRASH)).alias("n_crash"))
    decided = F.col("n_keep") + F.col("n_discard")
    return agg.withColumn("keep_rate", F.when(decided > 0, F.col("n_keep") / decided))


def best_run(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Lowest kept ``val_bpb`` and its row; the first row wins a tie (``idxmin``)."""
    kept = filter_status(log).where(F.col("val_bpb").isNotNull())
    best = F.min(F.struct("val_bpb", "idx", "description", "commit")).alias("_b")
    return kept.groupBy(*keys).agg(best).select(
        *keys, F.col("_b.val_bpb").alias("best_bpb"), F.col("_b.idx").alias("best_idx"),
        F.col("_b.description").alias("best_description"), F.col("_b.commit").alias("best_commit"))


def baseline_valid(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The first value once crashes are dropped (``valid.loc[0]``)."""
    first = F.min(F.struct("idx", "val_bpb")).alias("_f")
    return valid_rows(log).groupBy(*keys).agg(first).select(
        *keys, F.col("_f.val_bpb").alias("baseline_valid"))


def improvement_summary(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Baseline is the first row of the log (even a crash, whose value is 0.0 or
    missing); best is C5; improvement and its percentage of the baseline.  The crash-free
    baseline of D2 is given next to it.  One conditional aggregate."""
    first, row = F.struct("idx", "val_bpb"), F.struct("val_bpb", "idx", "description", "commit")
    kept = is_status(STATUS_KEEP) & F.col("val_bpb").isNotNull()
    agg = log.groupBy(*keys).agg(F.min(first).alias("_f"), F.count(F.lit(1)).alias("n_experiments"),
                                 F.min(F.when(kept, row)).alias("_b"), F.min(F.when(not_crash(), first)).alias("_v"))
    out = agg.select(*keys, F.col("_f.val_bpb").alias("baseline_raw"), "n_experiments",
                     F.col("_b.val_bpb").alias("best_bpb"), F.col("_b.idx").alias("best_idx"),
                     F.col("_b.description").alias("best_description"), F.col("_b.commit").alias("best_commit"),
                     F.col("_v.val_bpb").alias("baseline_valid"))
    delta = F.col("baseline_raw") - F.col("best_bpb")
    return (out.withColumn("improvement", delta)
               .withColumn("improvement_pct",
                           F.when(F.col("baseline_raw") != 0, delta / F.col("baseline_raw") * 100)))


def running_best(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Cumulative minimum of kept values in log order (the frontier); a row without a value
    has none, as in pandas, and the next one goes on from before."""
    kept = prefix_scan(filter_status(log), keys, "idx", [("running_best", "min", "val_bpb", True)], chunk)
    return kept.withColumn("running_best", F.when(F.col("val_bpb").isNotNull(), F.col("running_best")))


def valid_index(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """D3: renumber the crash-free rows from 0 (``reset_index`` after the filter)."""
    v = valid_rows(log).withColumn("_one", F.lit(1))
    return prefix_scan(v, keys, "idx", [("valid_idx", "count", "_one", False)], chunk).drop("_one")


def filter_near_baseline(log: DataFrame, keys: Sequence[str] = KEYS,
                         margin: float = NEAR_BASELINE_MARGIN, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Crash-free rows at or below ``baseline_valid + margin`` (with their D3 index)."""
    v = valid_index(log, keys, chunk)
    b = baseline_valid(log, keys)
    return v.join(b, list(keys), "inner").where(
        F.col("val_bpb") <= F.col("baseline_valid") + F.lit(margin))


def kept_sequence(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Kept rows with ``k`` (their rank among kept rows) and the previous kept row's
    ``val_bpb`` and ``idx`` (``shift(1)``), in one scan."""
    kept = filter_status(log).withColumn("_one", F.lit(1))
    return prefix_scan(kept, keys, "idx", [("k", "count", "_one", False), ("prev_bpb", "last", "val_bpb", False),
                                           ("prev_idx", "last", "idx", False)], chunk).drop("_one")


def kept_deltas(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """delta = previous kept value − this one; the first kept row (no delta) is dropped."""
    s = kept_sequence(log, keys, chunk)
    return (s.where(F.col("k") > 0)
             .withColumn("delta", F.col("prev_bpb") - F.col("val_bpb")))


def hit_order() -> list[Column]:
    """Biggest improvement first, NaN/null last, then log order (a stable sort)."""
    return [F.col("delta").desc_nulls_last(), F.col("idx").asc()]


def rank_hits(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Every hit numbered by improvement (1 = largest)."""
    hits = kept_deltas(log, keys, chunk)
    ranked = dense_index(hits, keys, hit_order(), out="_r")
    return ranked.withColumn("rank", F.col("_r") + 1).drop("_r")


def top_hits(log: DataFrame, k: int, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The ``k`` largest improvements per run (a top-k report)."""
    hits = kept_deltas(log, keys, chunk)
    return top_k_per_group(hits, keys, hit_order(), k, salt_col="idx", rank_col="rank")


def total_delta(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Sum of all per-step improvements of every log with a kept run (0.0 if there is none)."""
    delta = F.col("prev_bpb") - F.col("val_bpb")
    return kept_sequence(log, keys, chunk).groupBy(*keys).agg(
        F.coalesce(F.sum(delta), F.lit(0.0)).alias("total_delta"),
        F.count_if(F.col("k") > 0).alias("n_hits"))


def effort_per_improvement(log: DataFrame, keys: Sequence[str] = KEYS,
                           chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The experiment number of each kept run and the experiments since the last one."""
    s = kept_sequence(log, keys, chunk)
    return s.withColumn("experiments_since_prev", F.col("idx") - F.col("prev_idx"))


def keep_decision(log: DataFrame, keys: Sequence[str] = KEYS, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The rule of the experiment loop.  A run with a metric is kept when it is strictly
    below the best value so far, else reverted; a run without a metric is a crash.  Reverted
    values are never below the best, so the best so far is the minimum over all earlier
    measured runs (closed form, no recursion)."""
    measured = log.withColumn("_m", F.when(not_crash(), F.col("val_bpb")))
    s = prefix_scan(measured, keys, "idx", [("best_before", "min", "_m", False)], chunk)
    decision = (F.when(F.col("_m").isNull(), F.lit("crash"))
                 .when(F.col("best_before").isNull() | (F.col("_m") < F.col("best_before")), F.lit("keep"))
                 .otherwise(F.lit("discard")))
    return s.withColumn("decision", decision).drop("_m")


def axis_bounds(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The chart's data: best kept value, baseline, margin of 15 % of the range."""
    best = filter_status(log).groupBy(*keys).agg(F.min("val_bpb").alias("best_bpb"))
    b = baseline_valid(log, keys).join(best, list(keys), "inner")
    margin = (F.col("baseline_valid") - F.col("best_bpb")) * F.lit(AXIS_MARGIN)
    return (b.withColumn("margin", margin)
             .withColumn("y_low", F.col("best_bpb") - F.col("margin"))
             .withColumn("y_high", F.col("baseline_valid") + F.col("margin")))


def head_rows(log: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of each log (``idx`` is dense, so a plain filter)."""
    return log.where(F.col("idx") < n)


def kept_labels(log: DataFrame) -> DataFrame:
    """Kept rows with their chart label."""
    return filter_status(log).withColumn("label", shorten_label("description"))


def add_log_index(raw: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``idx`` from an explicit order (never from file order)."""
    return dense_index(raw, keys, order, out="idx")
