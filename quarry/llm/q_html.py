"""op8: main text of ``pages``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.html_text import extract
from quarry.llm.registry import register
from quarry.session import read_table


@register("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page and its length in code points."""
    rows = extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
