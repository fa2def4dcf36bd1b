"""op2: rates that mix ``documents`` to target weights of languages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing
from quarry.llm.registry import register
from quarry.session import read_table

# Target shares of the expected tokens.
WEIGHTS = {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.14}


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled rows: documents listed in ``labels``, with their language as the domain, at
    most ``mixing.MAX_LABELLED`` of them by the hash of their id."""
    ids = mixing.sample_ids(read_table(spark, sf_dir, "labels", "doc_id"), "doc_id")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", F.col("lang").alias("domain"))
    return docs.join(F.broadcast(ids), "doc_id", "left_semi")


@register("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, posteriors and rate of every document; target and reached total of each domain, the same
    in every row, so that a miss can be seen."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    rows, domains, target, got = mixing.mix(docs, labelled(spark, sf_dir), WEIGHTS)
    p = [F.element_at("p", i + 1).alias(f"p_{d}") for i, d in enumerate(domains)]
    fit = [F.lit(float(x[d])).alias(f"{name}_{d}") for name, x in (("target", target), ("reached", got)) for d in domains]
    return rows.select("doc_id", "tokens", *p, "rate", *fit)
