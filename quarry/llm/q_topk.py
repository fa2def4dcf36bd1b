"""op6: exact top-20 of ``embeddings``."""

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import topk
from quarry.llm.common import written
from quarry.llm.registry import register
from quarry.session import read_table

SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r AS r, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.r <> q.r AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@register("op6_topk", SQL)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of every 20th vector with all others."""
    v = written(topk.valid(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding"),
                "topk-vectors")
    return topk.search(v, v.where("id % 20 = 0"), 20)
