"""op12: licences stated in ``documents``."""

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import licenses
from quarry.llm.registry import register
from quarry.session import read_table


@register("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the base phrases, labels, certainty and burden of every document's licences."""
    return licenses.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))
