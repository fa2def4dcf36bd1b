"""Reference-shaped inputs derived from the driver tables (FIXTURES.md, "Stand-ins").

The reference's own inputs (case files, experiment logs, training logs, audit logs) are not
in the test data, so each is derived from a driver table by a fixed rule.  Both the Spark
queries and their oracle SQL apply the same rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.experiments import add_log_index, normalize_log
from quarry.session import read_table


def _raw_experiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment log without an index: run = customer; order = (order date, order key); value = total price;
    status F → keep, O → discard, P → crash (crash rows log 0.0 / 0.0 as the loop does);
    every fifth status padded with a tab and upper-cased to exercise the normalisation."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice", "o_orderdate", "o_orderpriority")
    crash = F.col("o_orderstatus") == "P"
    status = (F.when(F.col("o_orderstatus") == "F", "keep")
               .when(F.col("o_orderstatus") == "O", "discard")
               .when(crash, "crash"))
    status = F.when(F.col("o_orderkey") % 5 == 0,
                    F.concat(F.lit("\t"), F.upper(status), F.lit(" "))).otherwise(status)
    raw = o.select(
        F.col("o_custkey").alias("run"),
        F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 7).alias("commit"),
        F.when(crash, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("val_bpb"),
        F.when(crash, F.lit(0.0)).otherwise(
            F.round(F.col("o_totalprice") / 10 / 1024, 1)).alias("memory_gb"),
        status.alias("status"),
        F.concat(F.col("o_orderpriority"), F.lit(" tweak of order "),
                 F.col("o_orderkey").cast("string"), F.lit(" for customer "),
                 F.col("o_custkey").cast("string")).alias("description"),
        "o_orderdate", "o_orderkey")
    return raw


def raw_experiment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_experiment_rows(spark, sf_dir)
    return add_log_index(raw, ["run"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate", "o_orderkey")


def experiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows for reports that need no order: no index is built."""
    return normalize_log(_raw_experiment_rows(spark, sf_dir).drop("o_orderdate", "o_orderkey"))


def experiment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_log(raw_experiment_log(spark, sf_dir))


# The same rule in SQL, for the oracles.
EXPERIMENT_LOG_SQL = r"""
raw_log AS (
  SELECT o_custkey AS run,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS idx,
         substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7) AS commit,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE o_totalprice END AS val_bpb,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE round(o_totalprice / 10 / 1024, 1) END AS memory_gb,
         CASE WHEN o_orderkey % 5 = 0
              THEN chr(9) || upper(CASE o_orderstatus WHEN 'F' THEN 'keep' WHEN 'O' THEN 'discard' WHEN 'P' THEN 'crash' END) || ' '
              ELSE CASE o_orderstatus WHEN 'F' THEN 'keep' WHEN 'O' THEN 'discard' WHEN 'P' THEN 'crash' END END AS status,
         o_orderpriority || ' tweak of order ' || CAST(o_orderkey AS VARCHAR) || ' for customer ' || CAST(o_custkey AS VARCHAR) AS description
  FROM orders),
log AS (
  SELECT run, idx, commit, val_bpb, memory_gb, upper(STRIP(status)) AS status, description FROM raw_log)
"""


def _finish_sql() -> None:
    from quarry.plans import sqltext
    global EXPERIMENT_LOG_SQL
    EXPERIMENT_LOG_SQL = EXPERIMENT_LOG_SQL.replace("STRIP(status)", sqltext.strip("status"))


_finish_sql()


def conversation_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested cases (M4): each conversation turn carries ``cases`` = its lines as
    ``struct(case_text)``; a null text gives a null array.  Built per row, so bounded."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    cases = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("case_text")))
    return c.select("conv_id", "turn", cases.alias("cases"))


def conversation_case_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON case lists (M3/M4): each turn written as a one-element JSON list of a case object
    with ``text``, ``body`` (= ``role: text``) and ``conclusion`` (= role), then read back
    through the JSON case reader's schema."""
    from quarry.sources.tabular import CASE_ITEM
    from pyspark.sql import types as T
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    item = F.struct(F.col("text").alias("text"),
                    F.concat(F.col("role"), F.lit(": "), F.col("text")).alias("body"),
                    F.col("role").alias("conclusion"))
    js = c.select("conv_id", "turn", F.to_json(F.array(item)).alias("json"))
    return js.select("conv_id", "turn", F.explode(F.from_json("json", T.ArrayType(CASE_ITEM))).alias("item"))


def deposit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposit records (M5) from ``pages``: one file per record; name by ``page_id % 3``
    (cases.parquet, abstracts.parquet, an image zip), size = bytes of the html, link = url.
    Even ids use the ``files``/``filename``/``filesize`` naming, odd ids ``entries``/``key``/
    ``size``; every fourth record hides its link in a fallback field."""
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    pid = F.col("page_id")
    name = (F.when(pid % 3 == 0, "cases.parquet").when(pid % 3 == 1, "abstracts.parquet")
             .otherwise(F.concat(F.lit("images_"), pid.cast("string"), F.lit(".zip"))))
    size = F.octet_length("html").cast("long")
    v1 = F.struct(name.alias("filename"), size.alias("filesize"),
                  F.struct(F.when(pid % 4 == 0, F.lit("")).otherwise(F.col("url")).alias("download")).alias("links"),
                  F.when(pid % 4 == 0, F.col("url")).alias("download_url"))
    v2 = F.struct(name.alias("key"), size.alias("size"),
                  F.struct(F.when(pid % 4 != 3, F.col("url")).alias("content"),
                           F.when(pid % 4 == 3, F.col("url")).alias("self")).alias("links"))
    rec = F.when(pid % 2 == 0, F.to_json(F.struct(F.array(v1).alias("files")))) \
           .otherwise(F.to_json(F.struct(F.array(v2).alias("entries"))))
    return p.select(pid.alias("record_id"), rec.alias("record"))


def cached_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached downloads from ``pages``: size = html bytes, content type by ``page_id % 4``."""
    p = read_table(spark, sf_dir, "pages", "page_id", "html")
    pid = F.col("page_id")
    ctype = (F.when(pid % 4 == 0, "application/zip").when(pid % 4 == 1, "application/octet-stream")
              .when(pid % 4 == 2, "application/json").otherwise("text/html; charset=utf-8"))
    return p.select("page_id", F.octet_length("html").cast("long").alias("size_bytes"),
                    ctype.alias("content_type"))


FLOPS_PER_TOKEN = 6 * 50.3e6   # stand-in FLOPs per token: 6 × the sample model's 50.3 M parameters


GAP_SCALE = 4000.0             # event gaps are hours; steps take seconds


def step_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training telemetry from ``events``: run = user; steps ordered by (ts, event_id);
    loss = value; dt = seconds since the run's previous event (0 for its first) over GAP_SCALE,
    which brings hours down to seconds, so that a run's clock passes its budget on the way."""
    from quarry.operators.scan import dense_index, prefix_scan
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    e = e.withColumnRenamed("user_id", "run").withColumnRenamed("value", "loss")
    e = dense_index(e, ["run"], ["ts", "event_id"], out="step")
    e = prefix_scan(e, ["run"], "step", [("prev_ts", "last", "ts", False)])
    dt = F.expr("timestampdiff(MICROSECOND, prev_ts, ts)") / F.lit(1e6 * GAP_SCALE)
    return e.withColumn("dt", F.coalesce(dt, F.lit(0.0))).drop("prev_ts")


STEP_SQL = rf"""
steps AS (
  SELECT user_id AS run,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS step,
         event_id, ts, event_type, value AS loss, props,
         coalesce(CAST(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS DOUBLE) / {1e6 * GAP_SCALE!r}, 0.0) AS dt
  FROM events)
"""


HOME = "/home/researcher"

AUDIT_PATH_SQL = f"""
CASE event_type
  WHEN 'view' THEN '{HOME}/.cache/research/cases/data/shard_' || k || '.parquet'
  WHEN 'click' THEN '/tmp/run' || k || '.log'
  WHEN 'purchase' THEN '{HOME}/research-loop/file' || k
  WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN '/proc/meminfo' ELSE '/proc/' || k || '/status' END
  ELSE CASE WHEN k % 2 = 0 THEN '/proc/' || k ELSE '{HOME}/.ssh/id_' || k END END"""

AUDIT_SQL = f"""
audit AS (
  SELECT event_id AS op_id, user_id AS session, ts, event_type AS op, {AUDIT_PATH_SQL} AS path,
         event_type = 'error' AS denied
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))
"""


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit log from ``events``: session = user; op = event type; path by type under the
    sandbox layout (cache, /tmp, repo, /proc, ~/.ssh); denied = error events."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").try_cast("long")
    ks = k.cast("string")
    et = F.col("event_type")
    path = (F.when(et == "view", F.concat(F.lit(f"{HOME}/.cache/research/cases/data/shard_"), ks, F.lit(".parquet")))
             .when(et == "click", F.concat(F.lit("/tmp/run"), ks, F.lit(".log")))
             .when(et == "purchase", F.concat(F.lit(f"{HOME}/research-loop/file"), ks))
             .when(et == "signup", F.when(k % 2 == 0, F.lit("/proc/meminfo"))
                   .otherwise(F.concat(F.lit("/proc/"), ks, F.lit("/status"))))
             .otherwise(F.when(k % 2 == 0, F.concat(F.lit("/proc/"), ks))
                        .otherwise(F.concat(F.lit(f"{HOME}/.ssh/id_"), ks))))
    return e.select(F.col("event_id").alias("op_id"), F.col("user_id").alias("session"), "ts",
                    et.alias("op"), path.alias("path"), (et == "error").alias("denied"))


def signed_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Files and bundles from ``documents``: file ``doc_<id>.md`` holds the text; its bundle
    (a DSSE envelope with a base64 in-toto payload) signs the text's SHA-256, except that
    every tenth document was changed after signing (its bundle signs the text + '!') and
    every seventeenth has no bundle."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".md"))
    files = d.select(name.alias("name"), F.encode("text", "UTF-8").alias("content"))
    signed_text = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    stmt = F.to_json(F.struct(F.lit("https://in-toto.io/Statement/v1").alias("_type"),
                              F.array(F.struct(name.alias("name"),
                                               F.struct(F.sha2(F.encode(signed_text, "UTF-8"), 256).alias("sha256"))
                                                .alias("digest"))).alias("subject")))
    env = F.to_json(F.struct(F.struct(F.lit("application/vnd.in-toto+json").alias("payloadType"),
                                      F.base64(F.encode(stmt, "UTF-8")).alias("payload")).alias("dsseEnvelope")))
    bundles = d.where(F.col("doc_id") % 17 != 0).select(env.alias("bundle"))
    return files, bundles
