"""op1: quality verdict on ``documents`` by weak supervision."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.quality import judge
from quarry.llm.registry import register
from quarry.session import read_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@register("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rule and the verdict of the votes per document."""
    rows, _ = judge(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "votes", "posterior")
