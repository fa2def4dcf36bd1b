"""op10: boilerplate lines of ``documents``."""

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.line_spread import MIN_SITES, MIN_WORDS, remove_boilerplate
from quarry.llm.registry import register
from quarry.session import read_table

SQL = f"""
WITH l AS (
  SELECT doc_id, source, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)),
t AS (
  SELECT doc_id, source, pos, line, trim(line, ' ') AS k,
         length(trim(line, ' ')) - length(replace(trim(line, ' '), ' ', '')) >= {MIN_WORDS - 1} AS ok FROM l),
b AS (
  SELECT k, min(doc_id) AS keeper FROM t WHERE ok GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}),
r AS (
  SELECT t.*, b.k IS NOT NULL AND t.ok AND t.doc_id <> b.keeper AS gone FROM t LEFT JOIN b ON t.k = b.k)
SELECT d.doc_id, coalesce(x.n_lines, 0) AS n_lines, coalesce(x.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_removed,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text
  FROM r GROUP BY doc_id) x ON d.doc_id = x.doc_id
"""


@register("op10_line_spread", SQL)
def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many sources share."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")
