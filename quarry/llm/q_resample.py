"""op11: a tenth of ``documents`` drawn towards the distribution of ``benchmark``."""

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import resample
from quarry.llm.registry import register
from quarry.session import read_table

# The crc32 of a word is folded over its bytes, with the table of the reflected polynomial EDB88320.
SQL = """
WITH RECURSIVE
bits(b, v, i) AS (
  SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE i = 8),
src AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
dst AS (SELECT unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS f FROM benchmark),
one AS (SELECT r, f, count(*) AS n FROM (SELECT r, unnest(w) AS f FROM src) GROUP BY r, f),
seen AS (SELECT DISTINCT f FROM (SELECT f FROM one UNION ALL SELECT f FROM dst)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen(f) + 1),
           lambda i: CAST('0x' || substr(hex(f), 2 * i - 1, 2) AS BIGINT))),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM seen CROSS JOIN crc),
s AS (SELECT bucket, sum(n) AS s FROM one JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM dst JOIN hashed USING (f) GROUP BY bucket),
alls AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS ss, coalesce((SELECT sum(t) FROM t), 0) AS tt),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE
                      / ((coalesce(s, 0) + 1)::DOUBLE * (tt + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket) CROSS JOIN alls),
weight AS (SELECT r, CAST(sum(n * g) AS BIGINT) AS weight FROM one JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY r),
score AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
           AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM src LEFT JOIN weight USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS k, 10 * count(*) OVER () // 100 AS most
  FROM score WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= most THEN k END AS rank FROM score LEFT JOIN ranked USING (r)
"""


@register("op11_resample", SQL)
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document."""
    return resample.resample(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                             read_table(spark, sf_dir, "benchmark", "text"))
