"""op7: secret spans of ``documents``."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.registry import register
from quarry.llm.secrets import BASE_RULES, scan
from quarry.session import read_table


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


@register("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base kinds, and all spans, per document."""
    rows = scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = [r.kind for r in BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    n = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return rows.select("doc_id", *n, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
