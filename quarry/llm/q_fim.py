"""op13: fill-in-middle forms of ``documents``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import fim
from quarry.llm.registry import register
from quarry.session import read_table

SQL = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS y,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM u),
c AS (
  SELECT doc_id, text, n, array_to_string(units[1:least(x, y)], '') AS p, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(units[greatest(x, y) + 1:], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""


@register("op13_fill_in_middle", SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's output and of the text rebuilt from it."""
    rows = fim.transform(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
