"""Streaming jobs: shard ingestion (L1, L2), step monitor (L3), running best (L4).

All three read a file source, run the same column functions as the batch operators and
write with a checkpoint in the shared checkpoint folder, so a restarted query resumes
exactly.  ``trigger(availableNow=True)`` drains what is there and stops (used by tests and
the registered queries); a long-running deployment passes a processing-time trigger."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.constants import EMA_BETA, IBD_KEYWORDS, LOSS_LIMIT, MIN_DOC_CHARS, WARMUP_STEPS
from quarry.functions.text import cap_text, combine_texts, contains_any
from quarry.operators.corpus import stream_split
from quarry.session import shared_folder

STATE_VERSION = 2


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's sink and checkpoint under ``spark.checkpoint.dir``."""
    return shared_folder(spark, f"stream-{name}")


def _run(stream_writer, trigger_once: bool = True):
    q = (stream_writer.trigger(availableNow=True) if trigger_once else stream_writer).start()
    if trigger_once:
        q.awaitTermination()
    return q


# --------------------------------------------------------------------------- L1 + L2

def ingest_transform(stream: DataFrame, min_chars: int = MIN_DOC_CHARS, keywords=None,
                     key: str = "doc_id", text_columns: Sequence[str] = ("text",),
                     cap: int | None = None) -> DataFrame:
    """B5 (``text_columns`` combined into ``text``), B8, B9 when ``keywords``, B11 when ``cap``, and
    the stateless split L2: the batch functions, applied to a stream."""
    s = stream if tuple(text_columns) == ("text",) else stream.withColumn("text", combine_texts(text_columns))
    s = s.where(F.length("text") > min_chars)
    if keywords:
        s = s.where(contains_any("text", keywords))
    if cap:
        s = s.withColumn("text", cap_text("text", cap))
    return stream_split(s, key)


def stream_ingest(spark: SparkSession, source: str, schema, out: str, checkpoint: str,
                  min_chars: int = MIN_DOC_CHARS, keywords=None, max_files: int | None = None,
                  trigger_once: bool = True, glob: str | None = None,
                  text_columns: Sequence[str] = ("text",), cap: int | None = None):
    """L1: new shard files → filtered, split documents appended as parquet (exactly once via
    the file sink's log and the checkpoint).  ``source`` is a folder; ``glob`` picks files."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    docs = ingest_transform(r.parquet(source), min_chars, keywords, text_columns=text_columns, cap=cap)
    w = (docs.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append"))
    return _run(w, trigger_once)


# --------------------------------------------------------------------------- L3

# What a set of steps adds to its run, whatever the order it comes in: with S the sum of
# β^(last - step) · loss, two sets combine by scaling the older S to the later last step.
PARTIAL = ("run long, last_step long, first_step long, s double, train_seconds double, first_bad_step long, "
           "n_rows long")
MONITOR_OUT = ("run long, last_step long, ema_loss double, train_seconds double, failed boolean, "
               "first_bad_step long, late_rows long, closed boolean")
MONITOR_STATE = ("version int, last_step long, s double, train_seconds double, first_bad_step long, late_rows long")


def _partials(beta: float, limit: float, warmup: int):
    """One row per run and Arrow batch: a hot run is summed where its rows are read."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for run, g in b.groupby("run", sort=False):
                step, loss, dt = g["step"].to_numpy(np.int64), g["loss"].to_numpy(float), g["dt"].to_numpy(float)
                last, bad = int(step.max()), step[np.isnan(loss) | (loss > limit)]
                out.append((run, last, int(step.min()), float((beta ** (last - step).astype(float) * loss).sum()),
                            float(dt[step > warmup].sum()), int(bad.min()) if len(bad) else None, len(g)))
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in PARTIAL.split(", ")])
    return fn


def _monitor(beta: float, close_idle: bool):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = int(key[0])
        if state.hasTimedOut:
            v = state.get
            state.remove()
            yield _row(run, v[1:], beta, True)
            return
        last, s, seconds, bad, late = state.get[1:] if state.exists else (-1, 0.0, 0.0, None, 0)
        known = last
        for part in pdfs:
            for p in part.itertuples(index=False):
                top = max(last, p.last_step)
                s = (s * beta ** (top - last) if last >= 0 else 0.0) + p.s * beta ** (top - p.last_step)
                seconds += p.train_seconds
                if not pd.isna(p.first_bad_step):
                    bad = int(p.first_bad_step) if bad is None else min(bad, int(p.first_bad_step))
                late += int(p.n_rows) if p.first_step <= known else 0
                last = int(top)
        state.update((STATE_VERSION, last, float(s), float(seconds), bad, int(late)))
        if close_idle:
            state.setTimeoutDuration(10 * 60 * 1000)
        yield _row(run, (last, s, seconds, bad, late), beta, False)
    return fn


def _row(run: int, v, beta: float, closed: bool) -> pd.DataFrame:
    last, s, seconds, bad, late = v
    ema = (1 - beta) * s / (1 - beta ** (last + 1)) if last >= 0 else float("nan")
    return pd.DataFrame([{"run": run, "last_step": last, "ema_loss": ema, "train_seconds": seconds, "failed": bad is not None,
                          "first_bad_step": bad, "late_rows": late, "closed": closed}])


def monitor_transform(steps: DataFrame, beta: float = EMA_BETA, limit: float = LOSS_LIMIT,
                      warmup: int = WARMUP_STEPS, close_idle: bool = True) -> DataFrame:
    """L3: per run, the running EMA (debiased), training clock and divergence flag, emitted
    on every update.  Every row counts, late ones too: clock, first bad step and EMA do not
    depend on the order in which rows come; ``late_rows`` tells how many rows came in summaries
    that reach back before what was known.  Rows are summed per run where they are read,
    so a hot run reaches its state as a few rows.  With ``close_idle`` a processing-time timeout
    closes runs idle for ten minutes; a drain-and-stop (``availableNow``) run must not use it,
    because pending processing-time timeouts keep scheduling empty batches."""
    timeout = GroupStateTimeout.ProcessingTimeTimeout if close_idle else GroupStateTimeout.NoTimeout
    parts = steps.select("run", "step", "loss", "dt").mapInPandas(_partials(beta, limit, warmup), PARTIAL)
    return parts.groupBy("run").applyInPandasWithState(
        _monitor(beta, close_idle), MONITOR_OUT, MONITOR_STATE, "update", timeout)


def _batch_sink(out: str):
    """Each batch has a folder ``batch_id=…`` of its own, which a repeated batch replaces: rows of a
    batch that is tried again after a failure are not doubled."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def latest_per_key(updates: DataFrame, key: str = "run") -> DataFrame:
    """The last update of every key from an update-mode sink (max batch id wins)."""
    cols = [c for c in updates.columns if c not in (key, "batch_id")]
    best = updates.groupBy(key).agg(F.max(F.struct("batch_id", *cols)).alias("_b"))
    return best.select(key, *[F.col(f"_b.{c}").alias(c) for c in cols])


def stream_step_monitor(spark: SparkSession, source: str, schema, out: str, checkpoint: str,
                        max_files: int | None = None, trigger_once: bool = True):
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    upd = monitor_transform(r.parquet(source), close_idle=not trigger_once)
    w = upd.writeStream.foreachBatch(_batch_sink(out)).option("checkpointLocation", checkpoint).outputMode("update")
    return _run(w, trigger_once)


# --------------------------------------------------------------------------- L4

def running_best_transform(log: DataFrame) -> DataFrame:
    """L4: best kept value per run so far (a native streaming aggregate)."""
    return (log.where(F.col("status") == "KEEP").groupBy("run")
               .agg(F.min("val_bpb").alias("best_bpb"), F.count(F.lit(1)).alias("n_kept")))


def stream_running_best(spark: SparkSession, source: str, schema, out: str, checkpoint: str,
                        max_files: int | None = None, trigger_once: bool = True):
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    agg = running_best_transform(r.parquet(source))
    w = agg.writeStream.foreachBatch(_batch_sink(out)).option("checkpointLocation", checkpoint).outputMode("update")
    return _run(w, trigger_once)
