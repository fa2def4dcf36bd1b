"""Run-log and telemetry queries over the step table
derived from ``events`` (one training run per user)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.constants import H100_BF16_PEAK_FLOPS, STEP_LINE, SUMMARY_LINES, TOTAL_BATCH_SIZE
from quarry.operators import runlogs as R
from quarry.plans.registry import register
from quarry.plans.standins import FLOPS_PER_TOKEN, GAP_SCALE, STEP_SQL, step_table

W = "WITH " + STEP_SQL
STEP_COLS = "run, step, event_id, event_type, loss, dt"
TIMED_SQL = W + """,
timed AS (
  SELECT *, least(time_before / 300.0, 1.0) AS progress, least(time_before / 300.0, 1.0) * 100 AS pct_done,
         greatest(0.0, 300.0 - time_after) AS remaining
  FROM (SELECT run, step, event_id, event_type, loss, dt, props,
               coalesce(sum(CASE WHEN step > 10 THEN dt ELSE 0.0 END) OVER (PARTITION BY run ORDER BY step
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS time_before,
               coalesce(sum(CASE WHEN step > 10 THEN dt ELSE 0.0 END) OVER (PARTITION BY run ORDER BY step
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS time_after
        FROM steps))
"""
TIMED_COLS = STEP_COLS + ", time_before, time_after, progress, pct_done, remaining"


def steps(spark, sf_dir):
    return step_table(spark, sf_dir)


def timed(spark, sf_dir):
    return R.cumulative_train_time(steps(spark, sf_dir))


def run_totals(spark, sf_dir):
    """C11 with a step's memory from the event's ``props.k`` (stand-in: k · 512 MB)."""
    memory = F.get_json_object("props", "$.k").try_cast("double") * 512
    return R.run_totals(timed(spark, sf_dir), flops_per_token=FLOPS_PER_TOKEN, memory_mb=memory)


@register("step_table", sql=W + f"SELECT {STEP_COLS} FROM steps")
def q_step_table(spark, sf_dir):
    """The stand-in telemetry: dense steps per run and seconds per step."""
    return steps(spark, sf_dir).select(*STEP_COLS.split(", "))


@register("cumulative_train_time", sql=TIMED_SQL + f"SELECT {TIMED_COLS} FROM timed")
def q_cumulative_train_time(spark, sf_dir):
    """D10 + J8: training clock (steps after 10), progress, percent and time remaining."""
    return timed(spark, sf_dir).select(*TIMED_COLS.split(", "))


@register("schedule_audit", sql=TIMED_SQL + f"""
SELECT {TIMED_COLS}, lrm_expected, momentum, weight_decay, lrm_logged,
       abs(lrm_logged - lrm_expected) > 0.005 AS lrm_off
FROM (SELECT *, CASE WHEN progress < 0.0 THEN 1.0 WHEN progress < 0.7 THEN 1.0
                     ELSE (1.0 - progress) / 0.3 * 1.0 + (1.0 - (1.0 - progress) / 0.3) * 0.0 END AS lrm_expected,
             (1.0 - least(step / 300.0, 1.0)) * 0.85 + least(step / 300.0, 1.0) * 0.95 AS momentum,
             0.2 * (1.0 - progress) AS weight_decay,
             CAST(json_extract(props, '$.k') AS DOUBLE) / 100 AS lrm_logged
      FROM timed)""")
def q_schedule_audit(spark, sf_dir):
    """Expected LR factor, momentum and weight decay per step against a logged factor
    (stand-in: the event's ``props.k`` / 100)."""
    t = timed(spark, sf_dir).withColumn(
        "lrm_logged", F.get_json_object("props", "$.k").try_cast("double") / 100)
    return R.schedule_audit(t, "lrm_logged").drop("props", "ts")


@register("throughput", sql=W + f"""
SELECT {STEP_COLS},
       CASE WHEN dt > 0 THEN CAST(floor({TOTAL_BATCH_SIZE}.0 / dt) AS BIGINT) END AS tok_sec,
       CASE WHEN dt > 0 THEN CAST(100.0 AS DOUBLE) * CAST({FLOPS_PER_TOKEN!r} AS DOUBLE) * CAST({TOTAL_BATCH_SIZE} AS DOUBLE) / dt / CAST({H100_BF16_PEAK_FLOPS!r} AS DOUBLE) END AS mfu
FROM steps""")
def q_throughput(spark, sf_dir):
    """J5 + J6: tokens per second and MFU per step."""
    s = steps(spark, sf_dir).select(*STEP_COLS.split(", "))
    return R.throughput(s, flops_per_token=F.lit(FLOPS_PER_TOKEN))


@register("detect_divergence", sql=W + """
SELECT run, min(step) AS first_bad_step, CAST(count(*) AS BIGINT) AS n_bad
FROM steps WHERE isnan(loss) OR loss > 100 GROUP BY run""")
def q_detect_divergence(spark, sf_dir):
    """First step with a NaN or exploding (> 100) loss."""
    return R.detect_divergence(steps(spark, sf_dir))


@register("stop_step", sql=TIMED_SQL + """
SELECT run, min(step) AS stop_step FROM timed WHERE step + 1 > 10 AND time_after >= 300 GROUP BY run""")
def q_stop_step(spark, sf_dir):
    """The step at which the 300-second budget is used up."""
    return R.stop_step(timed(spark, sf_dir))


@register("run_totals", sql=TIMED_SQL + f""",
agg AS (SELECT run, max(step) + 1 AS num_steps, sum(CASE WHEN step > 10 THEN dt ELSE 0.0 END) AS training_seconds,
               sum(dt) AS total_seconds, max(CAST(json_extract(props, '$.k') AS DOUBLE) * 512) AS peak_vram_mb,
               CAST(count(*) AS BIGINT) AS n_lines FROM timed GROUP BY run)
SELECT *, CAST(num_steps * {TOTAL_BATCH_SIZE} AS BIGINT) AS total_tokens,
       CASE WHEN training_seconds > 0 THEN CAST({100.0 * FLOPS_PER_TOKEN * TOTAL_BATCH_SIZE / H100_BF16_PEAK_FLOPS!r} AS DOUBLE) * (num_steps - 10) / training_seconds ELSE 0.0 END AS steady_mfu,
       CASE WHEN training_seconds > 0 THEN CAST({100.0 * FLOPS_PER_TOKEN * TOTAL_BATCH_SIZE / H100_BF16_PEAK_FLOPS!r} AS DOUBLE) * greatest(num_steps - 11, 0) / training_seconds ELSE 0.0 END AS steady_mfu_exact
FROM agg""")
def q_run_totals(spark, sf_dir):
    """C11 + J7: steps, tokens, training seconds, steady MFU (as written and exact)."""
    return run_totals(spark, sf_dir)


@register("ema_loss", sql=W + f"""
SELECT {STEP_COLS},
       0.1 * pow(0.9, step) * sum(pow(0.9, -step) * loss) OVER (PARTITION BY run ORDER BY step
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (1 - pow(0.9, step + 1)) AS ema_loss
FROM steps""")
def q_ema_loss(spark, sf_dir):
    """Debiased EMA of the loss (β = 0.9) as printed in every step line."""
    return R.ema_loss(steps(spark, sf_dir).select(*STEP_COLS.split(", ")))


@register("tail_lines", sql=W + f"""
SELECT {STEP_COLS} FROM (SELECT *, max(step) OVER (PARTITION BY run) AS last FROM steps) WHERE step > last - 50""")
def q_tail_lines(spark, sf_dir):
    """The last 50 lines of each run."""
    return R.tail_lines(steps(spark, sf_dir).select(*STEP_COLS.split(", ")))


SUMMARY_SQL = W + """,
summ AS (SELECT run, min(CASE WHEN event_type = 'purchase' THEN loss END) AS val_bpb,
                CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1e6 / 4000 AS total_seconds
         FROM steps GROUP BY run)
"""


def summaries(spark, sf_dir):
    s = steps(spark, sf_dir)
    return s.groupBy("run").agg(
        F.min(F.when(F.col("event_type") == "purchase", F.col("loss"))).alias("val_bpb"),
        (F.expr("timestampdiff(MICROSECOND, min(ts), max(ts))") / F.lit(1e6) / F.lit(GAP_SCALE)).alias("total_seconds"))


@register("detect_crash", sql=SUMMARY_SQL + """
SELECT run, val_bpb IS NULL AS crashed, total_seconds, coalesce(total_seconds > 600, false) AS timed_out FROM summ""")
def q_detect_crash(spark, sf_dir):
    """Runs without a ``val_bpb`` line (stand-in: no purchase event) crashed; runs
    longer than 10 minutes timed out."""
    return R.detect_crash(steps(spark, sf_dir), summaries(spark, sf_dir), total_col="total_seconds")


def step_lines(spark, sf_dir):
    """The step lines a run would print (the reference's format), one per step."""
    t = R.schedule_audit(R.throughput(timed(spark, sf_dir), flops_per_token=F.lit(FLOPS_PER_TOKEN)))
    t = R.ema_loss(t.drop("ts"))
    line = F.format_string(STEP_LINE, F.col("step"), F.col("pct_done"), F.col("ema_loss"),
                           F.col("lrm_expected"), F.col("dt") * 1000, F.coalesce("tok_sec", F.lit(0)),
                           F.coalesce("mfu", F.lit(0.0)), F.lit(1), F.col("remaining"))
    return t.select("run", "step", line.alias("line"))


# What the printed digits of a step say.  SQL rounds a tie away from zero in decimal, as the
# printer does; a value one bit off a tie may differ, so the oracle gives numbers in units of the
# last digit, within which the query's must lie.
@register("parse_step_lines", sql=TIMED_SQL + f""",
ema AS (SELECT run, step, 0.1 * pow(0.9, step) * sum(pow(0.9, -step) * loss) OVER (PARTITION BY run ORDER BY step
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (1 - pow(0.9, step + 1)) AS ema FROM steps)
SELECT t.run, t.step, true AS pct_ok, true AS loss_ok, true AS lrm_ok, true AS dt_ok, true AS mfu_ok, true AS remaining_ok,
       CASE WHEN dt > 0 THEN CAST(floor({TOTAL_BATCH_SIZE}.0 / dt) AS BIGINT) ELSE 0 END AS tok_sec, CAST(1 AS BIGINT) AS epoch
FROM timed t JOIN ema e ON t.run = e.run AND t.step = e.step""")
def q_parse_step_lines(spark, sf_dir):
    """Step lines written in the reference's format, then parsed back: integers as they are,
    every decimal within half a unit of its last printed digit of what was printed."""
    t = R.ema_loss(R.schedule_audit(R.throughput(timed(spark, sf_dir), flops_per_token=F.lit(FLOPS_PER_TOKEN))).drop("ts"))
    true = t.select("run", "step", "pct_done", "ema_loss", "lrm_expected", (F.col("dt") * 1000).alias("dt_true"),
                    F.coalesce("mfu", F.lit(0.0)).alias("mfu_true"), F.col("remaining").alias("remaining_true"))
    got = R.parse_step_lines(step_lines(spark, sf_dir)).join(true, ["run", "step"])
    near = lambda c, d, digits, out: (F.abs(F.col(c) - F.col(d)) <= 0.5 * 10.0 ** -digits * (1 + 1e-6)).alias(out)
    return got.select("run", "step", near("pct", "pct_done", 1, "pct_ok"), near("loss", "ema_loss", 6, "loss_ok"),
                      near("lrm", "lrm_expected", 2, "lrm_ok"), near("dt_ms", "dt_true", 0, "dt_ok"),
                      near("mfu", "mfu_true", 1, "mfu_ok"), near("remaining", "remaining_true", 0, "remaining_ok"),
                      "tok_sec", "epoch")


@register("parse_summary", sql=TIMED_SQL.replace("SELECT run, step, event_id", "SELECT run, step, ts, event_id") + """,
tot AS (SELECT run, min(CASE WHEN event_type = 'purchase' THEN loss END) AS val_bpb,
               max(CAST(json_extract(props, '$.k') AS DOUBLE) * 512) AS mb, min(ts) AS started FROM timed GROUP BY run),
shown AS (SELECT run, round(val_bpb, 6) AS val_bpb, round(mb, 1) AS mb FROM tot),
m AS (SELECT *, min(val_bpb) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM shown)
SELECT run, substr(md5(CAST(run AS VARCHAR)), 1, 7) AS commit, coalesce(val_bpb, 0.0) AS val_bpb,
       CASE WHEN val_bpb IS NULL THEN 0.0 ELSE round(mb / 1024, 1) END AS memory_gb,
       CASE WHEN val_bpb IS NULL THEN 'crash' WHEN best IS NULL OR val_bpb < best THEN 'keep' ELSE 'discard' END AS status,
       'run ' || CAST(run AS VARCHAR) AS description
FROM m""")
def q_parse_summary(spark, sf_dir):
    """J2 + J10 + D7: a summary block per run written as ``key: value`` lines and parsed back
    with a pivot; then the results-log row with the keep rule's status (crash → 0.000000 / 0.0);
    the runs are one log in order of their number."""
    s = summaries(spark, sf_dir).drop("total_seconds").join(run_totals(spark, sf_dir), "run")
    values = {"val_bpb": F.col("val_bpb"), "training_seconds": F.col("training_seconds"),
              "total_seconds": F.col("total_seconds"), "peak_vram_mb": F.col("peak_vram_mb"),
              "mfu_percent": F.col("steady_mfu"), "total_tokens_M": F.col("total_tokens") / 1e6,
              "num_steps": F.col("num_steps"), "num_params_M": F.lit(50.3), "depth": F.lit(8)}
    kv = [F.format_string(SUMMARY_LINES[k], v) for k, v in values.items()]
    lines = s.select("run", F.posexplode(F.array(F.lit("---"), *kv)).alias("at", "line"))
    lines = lines.where(~F.col("line").contains("null"))
    parsed = R.parse_summary(lines, order="at")
    crashed = R.detect_crash(s, parsed)
    meta = s.select("run", F.md5(F.col("run").cast("string")).alias("commit"),
                    F.concat(F.lit("run "), F.col("run").cast("string")).alias("description"))
    return R.build_results_log(parsed.join(meta, "run", "right"), crashed)
