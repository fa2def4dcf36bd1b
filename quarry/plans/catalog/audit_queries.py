"""Audit, policy and integrity queries over stand-ins from
``events`` (audit log) and ``documents`` (signed files)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.constants import POLICY_ALLOW, POLICY_READ
from quarry.operators import audit as A
from quarry.plans import sqltext as S
from quarry.plans.registry import register
from quarry.plans.standins import AUDIT_SQL, HOME, audit_log, signed_documents

W = "WITH " + AUDIT_SQL


def _rules_sql() -> str:
    rows = [("allow", p) for p in POLICY_ALLOW] + [("read", p) for p in POLICY_READ]
    vals = ", ".join(f"({S.lit(k)}, {S.lit(p.replace('$HOME', HOME).rstrip('/'))})" for k, p in rows)
    return f"rules(kind, prefix) AS (VALUES {vals})"


@register("policy_match", sql=W + ", " + _rules_sql() + """,
m AS (SELECT a.op_id, r.kind, r.prefix, length(r.prefix) AS len FROM audit a JOIN rules r
      ON a.path = r.prefix OR starts_with(a.path, r.prefix || '/')),
best AS (SELECT op_id, arg_max(prefix, len * 2 + CASE WHEN kind = 'allow' THEN 1 ELSE 0 END) AS matched_prefix,
                arg_max(kind, len * 2 + CASE WHEN kind = 'allow' THEN 1 ELSE 0 END) AS access FROM m GROUP BY op_id)
SELECT a.op_id, a.session, a.op, a.path, a.denied, b.matched_prefix, coalesce(b.access, 'denied') AS access
FROM audit a LEFT JOIN best b USING (op_id)""")
def q_policy_match(spark, sf_dir):
    """Each operation's path against the sandbox profile (longest whole-component
    prefix; deny by default)."""
    ops = audit_log(spark, sf_dir).drop("ts")
    return A.policy_match(ops, A.policy_rules(spark, HOME))


@register("audit_denials", sql=W + """,
den AS (SELECT session, path, CAST(count(*) AS BIGINT) AS n FROM audit WHERE denied GROUP BY session, path)
SELECT * FROM den
UNION ALL
SELECT DISTINCT session, 'no denials recorded', CAST(0 AS BIGINT) FROM audit WHERE session NOT IN (SELECT session FROM den)""")
def q_audit_denials(spark, sf_dir):
    """K2: denials per session and path, or 'no denials recorded'."""
    return A.audit_denials(audit_log(spark, sf_dir))


@register("record_denials", sql=W + """,
d AS (SELECT session, path FROM audit WHERE denied
      UNION ALL SELECT session, path || '.lock' FROM audit WHERE denied AND op_id % 3 = 0),
den AS (SELECT session, path, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY session, path)
SELECT * FROM den
UNION ALL
SELECT DISTINCT session, 'no denials recorded', CAST(0 AS BIGINT) FROM audit WHERE session NOT IN (SELECT session FROM den)""")
def q_record_denials(spark, sf_dir):
    """K2 on session records as JSON: the records hold an array of one or two denials, an empty
    one, or no such field."""
    lock = F.struct(F.concat("path", F.lit(".lock")).alias("path"), F.lit("lock").alias("op"))
    one = F.struct("path", "op")
    denials = (F.when(F.col("denied") & (F.col("op_id") % 3 == 0), F.array(one, lock)).when(F.col("denied"), F.array(one))
               .when(F.col("op_id") % 2 == 0, F.array().cast("array<struct<path:string,op:string>>")))
    records = audit_log(spark, sf_dir).select(F.to_json(F.struct("session", denials.alias("denials"))).alias("record"))
    return A.record_denials(records)


@register("expected_denials", sql=W + """
SELECT session, path, CAST(count(*) AS BIGINT) AS n, coalesce(regexp_matches(path, '^/proc/[0-9]+(/.*)?$'), false) AS expected
FROM audit WHERE denied GROUP BY session, path""")
def q_expected_denials(spark, sf_dir):
    """K6: denials flagged as expected when they are ephemeral /proc/<pid> paths."""
    den = A.audit_denials(audit_log(spark, sf_dir)).where(F.col("n") > 0)
    return A.expected_denials(den)


@register("recent_sessions", sql=W + """
SELECT session, CAST(epoch_us(started) AS BIGINT) AS started_us, CAST(epoch_us(ended) AS BIGINT) AS ended_us, n_ops, n_denied
FROM (SELECT session, min(ts) AS started, max(ts) AS ended, CAST(count(*) AS BIGINT) AS n_ops,
             CAST(count_if(denied) AS BIGINT) AS n_denied FROM audit GROUP BY session)
ORDER BY started DESC, session LIMIT 5""")
def q_recent_sessions(spark, sf_dir):
    """The five most recent sessions (a top-k report)."""
    r = A.recent_sessions(audit_log(spark, sf_dir))
    us = lambda c: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {c})")
    return r.select("session", us("started").alias("started_us"), us("ended").alias("ended_us"), "n_ops", "n_denied")


@register("untracked_access", sql=W + """,
tracked AS (SELECT DISTINCT session, path FROM audit WHERE op = 'purchase')
SELECT session, path, CAST(count(*) AS BIGINT) AS n_ops FROM audit
WHERE (session, path) NOT IN (SELECT (session, path) FROM tracked)
GROUP BY session, path""")
def q_untracked_access(spark, sf_dir):
    """Paths a session touched that left no trace in git (stand-in: git holds the
    paths of purchase events)."""
    log = audit_log(spark, sf_dir)
    return A.untracked_access(log, log.where(F.col("op") == "purchase"))


@register("integrity_check", sql="""
SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.md' AS name, sha256(text) AS sha256,
       CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN sha256(text || '!') ELSE sha256(text) END AS signed_sha256,
       CASE WHEN doc_id % 17 = 0 THEN 'missing' WHEN doc_id % 10 = 0 THEN 'changed' ELSE 'ok' END AS state
FROM documents""")
def q_integrity_check(spark, sf_dir):
    """K1 (+ G6): every file's SHA-256 against its signed bundle: ok / changed / missing."""
    files, bundles = signed_documents(spark, sf_dir)
    return A.integrity_check(files, A.bundle_subjects(bundles))
