"""Audit, policy and integrity analytics.

An audit log has one row per operation: ``session``, ``ts``, ``op``, ``path``, ``denied``.  Session records
are JSON objects with ``session`` and, if there were any, an array ``denials`` of objects with ``path``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import EPHEMERAL_PROC, NO_DENIALS, POLICY_ALLOW, POLICY_READ


def policy_rules(spark: SparkSession, home: str, allow: Sequence[str] = POLICY_ALLOW,
                 read: Sequence[str] = POLICY_READ) -> DataFrame:
    """``kind, prefix`` with ``$HOME`` expanded and trailing slashes removed."""
    rows = [("allow", p) for p in allow] + [("read", p) for p in read]
    df = spark.createDataFrame(rows, "kind string, prefix string")
    return df.withColumn("prefix", F.regexp_replace(F.replace("prefix", F.lit("$HOME"), F.lit(home)), "/+$", ""))


def path_prefixes(path_col: str = "path"):
    """Every whole-component prefix of a path, the root as the empty one: "", /a, /a/b."""
    parts = F.split(F.regexp_replace(F.col(path_col), "/+$", ""), "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def policy_match(ops: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule prefix covering each path (whole components), ``allow`` over
    ``read`` on the same prefix; no rule → denied.

    Each distinct path is expanded to its component prefixes, which are equi-joined with the
    rules; the best rule of a path joins the operations back by path, so neither ids nor the
    number of rules matter.  A null path is denied; a null prefix covers nothing; the rule ``/``
    covers every absolute path."""
    paths = ops.select(F.col("path").alias("_path")).where(F.col("_path").isNotNull()).distinct()
    ex = paths.select("_path", F.explode(path_prefixes("_path")).alias("prefix"))
    best = (ex.join(rules.select("prefix", "kind"), "prefix").groupBy("_path")
              .agg(F.max(F.struct(F.length("prefix"), F.col("kind") == "allow", "prefix", "kind")).alias("_b")))
    name = F.when(F.col("_b.prefix") == "", F.lit("/")).otherwise(F.col("_b.prefix"))
    return (ops.join(best, ops["path"] == best["_path"], "left").withColumn("matched_prefix", name)
               .withColumn("access", F.coalesce(F.col("_b.kind"), F.lit("denied"))).drop("_b", "_path"))


def expected_denials(denials: DataFrame, path: str = "path") -> DataFrame:
    """K6: ephemeral ``/proc/<pid>`` paths are expected; flag them."""
    return denials.withColumn("expected", F.coalesce(F.col(path).rlike(EPHEMERAL_PROC), F.lit(False)))


def audit_denials(log: DataFrame, keys: Sequence[str] = ("session",)) -> DataFrame:
    """K2: denials per session and path; a session without any gets one row with the text
    ``no denials recorded`` (``jq '.denials // "no denials recorded"'``)."""
    sessions = log.select(*keys).distinct()
    den = log.where(F.col("denied")).groupBy(*keys, "path").agg(F.count(F.lit(1)).alias("n"))
    none = sessions.join(den.select(*keys).distinct(), list(keys), "left_anti").select(
        *keys, F.lit(NO_DENIALS).alias("path"), F.lit(0).cast("long").alias("n"))
    return den.unionByName(none)


RECORD = "session BIGINT, denials ARRAY<STRUCT<path: STRING, op: STRING>>"


def record_denials(records: DataFrame, record: str = "record", schema: str = RECORD, key: str = "session") -> DataFrame:
    """K2 on nested records: denials per session and path, of all records of a session; a session
    whose records have none (field absent, null or empty) gets one row with the text ``no denials
    recorded``.  A record that is no JSON object, or has no session, counts for no session."""
    parsed = records.select(F.from_json(record, schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    each = parsed.where(F.col(key).isNotNull()).select(key, F.explode_outer("denials").alias("d"))
    count = each.groupBy(key, F.col("d.path").alias("path")).agg(F.count("d").alias("n"))
    found = count.where("n > 0")
    none = (count.where("n = 0").select(key).join(found.select(key).distinct(), key, "left_anti")
            .select(key, F.lit(NO_DENIALS).alias("path"), F.lit(0).cast("long").alias("n")))
    return found.unionByName(none)


def recent_sessions(log: DataFrame, k: int = 5, keys: Sequence[str] = ("session",)) -> DataFrame:
    """The ``k`` most recent sessions by start time (a top-k report: the session table
    is aggregated first, one row per session)."""
    s = log.groupBy(*keys).agg(F.min("ts").alias("started"), F.max("ts").alias("ended"),
                               F.count(F.lit(1)).alias("n_ops"), F.count_if("denied").alias("n_denied"))
    return s.orderBy(F.col("started").desc(), *[F.col(c).asc() for c in keys]).limit(k)


def untracked_access(log: DataFrame, tracked: DataFrame, keys: Sequence[str] = ("session", "path")) -> DataFrame:
    """(session, path) touched according to the audit log but absent from git."""
    touched = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_ops"))
    return touched.join(tracked.select(*keys).distinct(), list(keys), "left_anti")


SUBJECT = T.StructType([T.StructField("subject", T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("digest", T.StructType([T.StructField("sha256", T.StringType())]))])))])


def bundle_subjects(bundles: DataFrame, json_col: str = "bundle") -> DataFrame:
    """``name, sha256`` of DSSE envelopes: base64 payload → in-toto statement."""
    env = F.get_json_object(F.col(json_col), "$.dsseEnvelope.payload")
    stmt = F.from_json(F.decode(F.unbase64(env), "UTF-8"), SUBJECT)
    return bundles.select(F.explode(stmt["subject"]).alias("s")).select(
        F.col("s.name").alias("name"), F.lower(F.col("s.digest.sha256")).alias("signed_sha256"))


def integrity_check(files: DataFrame, subjects: DataFrame, name: str = "name",
                    content: str = "content") -> DataFrame:
    """K1 (+ G6): each file's SHA-256 against its signed digest: ``ok``, ``changed`` or
    ``missing`` (no signed digest — the launcher refuses to start)."""
    f = files.select(F.col(name).alias("name"), F.sha2(F.col(content), 256).alias("sha256"))
    j = f.join(subjects, "name", "left")
    state = (F.when(F.col("signed_sha256").isNull(), F.lit("missing"))
              .when(F.col("signed_sha256") == F.col("sha256"), F.lit("ok")).otherwise(F.lit("changed")))
    return j.withColumn("state", state)


def read_files(spark: SparkSession, paths) -> DataFrame:
    """Files as ``name, content`` (``binaryFile``)."""
    raw = spark.read.format("binaryFile").load(paths)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
