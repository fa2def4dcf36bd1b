"""Experiment-log queries over the stand-in
log derived from ``orders`` (one log per customer)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import commit_short, memory_gb
from quarry.operators import experiments as X
from quarry.plans.registry import register
from quarry.plans.standins import EXPERIMENT_LOG_SQL, experiment_log, experiment_rows
from quarry.session import read_table

W = "WITH " + EXPERIMENT_LOG_SQL
LOG_COLS = "run, idx, commit, val_bpb, memory_gb, status, description"
TOP_K = 3


@register("experiment_log", sql=W + "SELECT * FROM log")
def q_experiment_log(spark, sf_dir):
    """A14 + B12 + B13: the log with an explicit index, numbers coerced, status normalised."""
    return experiment_log(spark, sf_dir)


@register("status_counts", sql=W + """
SELECT run, status, CAST(count(*) AS BIGINT) AS n FROM log WHERE status IS NOT NULL GROUP BY run, status""")
def q_status_counts(spark, sf_dir):
    """Outcome counts per log."""
    return X.status_counts(experiment_rows(spark, sf_dir))


@register("keep_rate", sql=W + """
SELECT run, n_total, n_keep, n_discard, n_crash,
       CASE WHEN n_keep + n_discard > 0 THEN n_keep / (n_keep + n_discard) END AS keep_rate
FROM (SELECT run, CAST(count(*) AS BIGINT) AS n_total,
             CAST(count_if(status = 'KEEP') AS BIGINT) AS n_keep,
             CAST(count_if(status = 'DISCARD') AS BIGINT) AS n_discard,
             CAST(count_if(status = 'CRASH') AS BIGINT) AS n_crash
      FROM log GROUP BY run)""")
def q_keep_rate(spark, sf_dir):
    """C4: keep / (keep + discard)."""
    return X.keep_rate(experiment_rows(spark, sf_dir))


BEST_SQL = """
best AS (SELECT run, val_bpb AS best_bpb, idx AS best_idx, description AS best_description, commit AS best_commit
         FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY val_bpb, idx) AS rn
               FROM log WHERE status = 'KEEP' AND val_bpb IS NOT NULL) WHERE rn = 1),
valid AS (SELECT * FROM log WHERE status IS DISTINCT FROM 'CRASH'),
base AS (SELECT run, val_bpb AS baseline_valid
         FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY idx) AS rn FROM valid) WHERE rn = 1)
"""


@register("best_run", sql=W + "," + BEST_SQL + "SELECT * FROM best")
def q_best_run(spark, sf_dir):
    """Lowest kept value and its row (first on a tie)."""
    return X.best_run(experiment_log(spark, sf_dir))


@register("baseline_valid", sql=W + "," + BEST_SQL + "SELECT * FROM base")
def q_baseline_valid(spark, sf_dir):
    """First value after dropping crashes."""
    return X.baseline_valid(experiment_log(spark, sf_dir))


@register("improvement_summary", sql=W + "," + BEST_SQL + """,
first_row AS (SELECT run, CAST(count(*) AS BIGINT) AS n_experiments,
                     arg_min(val_bpb, idx) AS baseline_raw FROM log GROUP BY run)
SELECT f.run, f.baseline_raw, f.n_experiments, b.best_bpb, b.best_idx, b.best_description, b.best_commit,
       v.baseline_valid, f.baseline_raw - b.best_bpb AS improvement,
       CASE WHEN f.baseline_raw <> 0 THEN (f.baseline_raw - b.best_bpb) / f.baseline_raw * 100 END AS improvement_pct
FROM first_row f LEFT JOIN best b ON f.run = b.run LEFT JOIN base v ON f.run = v.run""")
def q_improvement_summary(spark, sf_dir):
    """Baseline (first row), best, improvement and percent."""
    return X.improvement_summary(experiment_log(spark, sf_dir))


@register("running_best", sql=W + f"""
SELECT {LOG_COLS}, CASE WHEN val_bpb IS NOT NULL THEN min(val_bpb) OVER (PARTITION BY run ORDER BY idx
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS running_best
FROM log WHERE status = 'KEEP'""")
def q_running_best(spark, sf_dir):
    """Cumulative minimum over kept runs."""
    return X.running_best(experiment_log(spark, sf_dir))


@register("valid_index", sql=W + f"""
SELECT {LOG_COLS}, CAST(row_number() OVER (PARTITION BY run ORDER BY idx) - 1 AS BIGINT) AS valid_idx
FROM log WHERE status IS DISTINCT FROM 'CRASH'""")
def q_valid_index(spark, sf_dir):
    """D3: crash-free rows renumbered from 0."""
    return X.valid_index(experiment_log(spark, sf_dir))


@register("filter_near_baseline", sql=W + "," + BEST_SQL + f""",
vi AS (SELECT {LOG_COLS}, CAST(row_number() OVER (PARTITION BY run ORDER BY idx) - 1 AS BIGINT) AS valid_idx FROM valid)
SELECT vi.*, base.baseline_valid FROM vi JOIN base USING (run)
WHERE vi.val_bpb <= base.baseline_valid + 0.0005""")
def q_filter_near_baseline(spark, sf_dir):
    """B15 (+ G7): crash-free rows within 0.0005 of the baseline."""
    return X.filter_near_baseline(experiment_log(spark, sf_dir))


KEPT_SQL = f"""
kept AS (SELECT {LOG_COLS}, CAST(row_number() OVER (PARTITION BY run ORDER BY idx) - 1 AS BIGINT) AS k
         FROM log WHERE status = 'KEEP'),
seq AS (SELECT *, lag(val_bpb) OVER (PARTITION BY run ORDER BY idx) AS prev_bpb,
               lag(idx) OVER (PARTITION BY run ORDER BY idx) AS prev_idx FROM kept),
hits AS (SELECT *, prev_bpb - val_bpb AS delta FROM seq WHERE k > 0)
"""


@register("kept_deltas", sql=W + "," + KEPT_SQL + "SELECT * FROM hits")
def q_kept_deltas(spark, sf_dir):
    """Improvement of each kept run over the previous kept run."""
    return X.kept_deltas(experiment_log(spark, sf_dir))


@register("rank_hits", sql=W + "," + KEPT_SQL + """
SELECT *, CAST(row_number() OVER (PARTITION BY run ORDER BY delta DESC NULLS LAST, idx) AS BIGINT) AS rank
FROM hits""")
def q_rank_hits(spark, sf_dir):
    """Hits numbered by improvement."""
    return X.rank_hits(experiment_log(spark, sf_dir))


@register("top_hits", sql=W + "," + KEPT_SQL + f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY run ORDER BY delta DESC NULLS LAST, idx) AS BIGINT) AS rank
               FROM hits) WHERE rank <= {TOP_K}""")
def q_top_hits(spark, sf_dir):
    """The largest improvements of each log (top-k report)."""
    return X.top_hits(experiment_log(spark, sf_dir), TOP_K)


@register("total_delta", sql=W + "," + KEPT_SQL + """
SELECT run, coalesce(sum(prev_bpb - val_bpb), 0.0) AS total_delta, CAST(count_if(k > 0) AS BIGINT) AS n_hits
FROM seq GROUP BY run""")
def q_total_delta(spark, sf_dir):
    """Sum of per-step improvements."""
    return X.total_delta(experiment_log(spark, sf_dir))


@register("effort_per_improvement", sql=W + "," + KEPT_SQL + """
SELECT *, idx - prev_idx AS experiments_since_prev FROM seq""")
def q_effort(spark, sf_dir):
    """Experiment number of each kept run and the gap since the previous one."""
    return X.effort_per_improvement(experiment_log(spark, sf_dir))


@register("keep_decision", sql=W + f"""
SELECT {LOG_COLS}, best_before,
       CASE WHEN m IS NULL THEN 'crash' WHEN best_before IS NULL OR m < best_before THEN 'keep' ELSE 'discard' END AS decision
FROM (SELECT *, min(m) OVER (PARTITION BY run ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
      FROM (SELECT *, CASE WHEN status IS DISTINCT FROM 'CRASH' THEN val_bpb END AS m FROM log))""")
def q_keep_decision(spark, sf_dir):
    """Keep when strictly below the best so far, else revert; no metric = crash."""
    return X.keep_decision(experiment_log(spark, sf_dir))


@register("axis_bounds", sql=W + "," + BEST_SQL + """
SELECT run, baseline_valid, best_bpb, (baseline_valid - best_bpb) * 0.15 AS margin,
       best_bpb - (baseline_valid - best_bpb) * 0.15 AS y_low, baseline_valid + (baseline_valid - best_bpb) * 0.15 AS y_high
FROM base JOIN (SELECT run, min(val_bpb) AS best_bpb FROM log WHERE status = 'KEEP' GROUP BY run) USING (run)""")
def q_axis_bounds(spark, sf_dir):
    """Best, baseline and a 15 % margin."""
    return X.axis_bounds(experiment_log(spark, sf_dir))


@register("head_rows", sql=W + "SELECT * FROM log WHERE idx < 10")
def q_head_rows(spark, sf_dir):
    """The first ten rows of each log."""
    return X.head_rows(experiment_log(spark, sf_dir), 10)


@register("filter_status", sql=W + "SELECT * FROM log WHERE status = 'KEEP'")
def q_filter_status(spark, sf_dir):
    """Kept experiments."""
    return X.filter_status(experiment_log(spark, sf_dir))


@register("shorten_label", sql=W + f"""
SELECT * EXCLUDE (d), CASE WHEN length(d) > 45 THEN substr(d, 1, 42) || '...' ELSE d END AS label
FROM (SELECT *, {'{STRIP}'} AS d FROM log WHERE status = 'KEEP')""".replace(
    "{STRIP}", __import__("quarry.plans.sqltext", fromlist=["strip"]).strip("description")))
def q_shorten_label(spark, sf_dir):
    """Chart labels of kept runs (> 45 characters → 42 + '...')."""
    return X.kept_labels(experiment_log(spark, sf_dir))


@register("commit_short", sql="""
SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS commit_full,
       substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7) AS commit FROM orders""")
def q_commit_short(spark, sf_dir):
    """Seven-character commit ids (commit = md5 of the order key)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey")
    full = F.md5(F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", full.alias("commit_full"), commit_short(full).alias("commit"))


@register("memory_gb", sql="""
SELECT o_orderkey, peak_vram_mb, round(coalesce(peak_vram_mb, 0) / 1024, 1) AS memory_gb
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 10 END AS peak_vram_mb FROM orders)""")
def q_memory_gb(spark, sf_dir):
    """Peak MB → GB with one decimal; a crash (no value) is 0.0."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    mb = F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double")).otherwise(F.col("o_totalprice") / 10)
    return o.select("o_orderkey", mb.alias("peak_vram_mb"), memory_gb(mb).alias("memory_gb"))
