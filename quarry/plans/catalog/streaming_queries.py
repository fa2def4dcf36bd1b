"""Streaming queries: each drains a file stream with ``availableNow`` into a
sink under the shared checkpoint folder and returns what the sink holds."""

from __future__ import annotations

import os

from pyspark.sql.types import StringType, StructField, StructType

from quarry.plans.catalog.experiment_queries import W as LOG_W
from quarry.plans.catalog.runlog_queries import W as STEP_W
from quarry.plans.registry import register
from quarry.plans.standins import experiment_log, step_table
from quarry.session import is_folder, read_table, table_path
from quarry.streaming import jobs


@register("stream_ingest", sql="""
SELECT doc_id, text, lang, source, n_chars,
       CASE WHEN ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT < 429496729
            THEN 'val' ELSE 'train' END AS split
FROM documents WHERE length(text) > 100""")
def q_stream_ingest(spark, sf_dir):
    """L1 + L2: the documents file streamed through the length filter and hash split."""
    path, schema = table_path(sf_dir, "documents"), read_table(spark, sf_dir, "documents").schema
    base = jobs.scratch_dir(spark, "ingest")
    # A table is a file of ``sf_dir`` or a folder of files, whose names the glob would have to match.
    source, glob = (path, None) if is_folder(spark, path) else (sf_dir, os.path.basename(path))
    jobs.stream_ingest(spark, source, schema, os.path.join(base, "out"), os.path.join(base, "ckpt"), glob=glob)
    split = StructType([*schema.fields, StructField("split", StringType())])
    return spark.read.schema(split).parquet(os.path.join(base, "out"))      # a sink may hold no row


def _materialize(df, spark, name):
    base = jobs.scratch_dir(spark, name)
    path = os.path.join(base, "input")
    df.write.parquet(path)
    return base, path, spark.read.parquet(path).schema


@register("stream_step_monitor", sql=STEP_W + """
SELECT run, max(step) AS last_step,
       arg_max(ema, step) AS ema_loss,
       sum(CASE WHEN step > 10 THEN dt ELSE 0.0 END) AS train_seconds,
       bool_or(isnan(loss) OR loss > 100) AS failed,
       min(CASE WHEN isnan(loss) OR loss > 100 THEN step END) AS first_bad_step,
       CAST(0 AS BIGINT) AS late_rows, false AS closed
FROM (SELECT *, 0.1 * pow(0.9, step) * sum(pow(0.9, -step) * loss) OVER (PARTITION BY run ORDER BY step
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (1 - pow(0.9, step + 1)) AS ema FROM steps)
GROUP BY run""")
def q_stream_step_monitor(spark, sf_dir):
    """L3: keyed state per run over the step stream; the last update of every run."""
    steps = step_table(spark, sf_dir).select("run", "step", "loss", "dt")
    base, path, schema = _materialize(steps, spark, "monitor")
    jobs.stream_step_monitor(spark, path, schema, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return jobs.latest_per_key(spark.read.parquet(os.path.join(base, "out")))


@register("stream_running_best", sql=LOG_W + """
SELECT run, min(val_bpb) AS best_bpb, CAST(count(*) AS BIGINT) AS n_kept FROM log WHERE status = 'KEEP' GROUP BY run""")
def q_stream_running_best(spark, sf_dir):
    """L4: best kept value per run as results arrive (streaming aggregate, update mode)."""
    log = experiment_log(spark, sf_dir)
    base, path, schema = _materialize(log, spark, "best")
    jobs.stream_running_best(spark, path, schema, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return jobs.latest_per_key(spark.read.parquet(os.path.join(base, "out")))
