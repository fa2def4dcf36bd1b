"""op5: toxicity of ``documents``."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import toxicity
from quarry.llm.registry import register
from quarry.session import read_table


def fold(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def learned(spark: SparkSession, sf_dir: str) -> toxicity.TextCnn:
    """The network from the labels outside fold 0."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").where(fold() != 0)
    return toxicity.fit(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"), labels)


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, prediction at one half and verdict by the language's threshold per document."""
    net = learned(spark, sf_dir)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    rows = toxicity.score(docs, net, keep=("doc_id", "lang"))
    return rows.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        toxicity.threshold(net).alias("threshold"), (F.col("score") >= toxicity.threshold(net)).alias("rejected"))
