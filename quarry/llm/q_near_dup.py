"""op9: near-duplicate classes of ``documents``."""

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.near_dup import near_duplicates
from quarry.llm.registry import register
from quarry.session import read_table

# All pairs that share a shingle, compared in full; the classes by following the links.
SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
c AS (SELECT doc_id, sh, 1 + ln(count(*)) AS wt FROM s GROUP BY doc_id, sh),
n AS (SELECT doc_id, count(*) AS n, sum(wt) AS total FROM c GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.wt AS x, b.wt AS y FROM c a JOIN c b ON a.sh = b.sh AND a.doc_id < b.doc_id),
p AS (SELECT a, b, count(*) AS k, sum(x) AS sx, sum(y) AS sy FROM common GROUP BY a, b),
cand AS (SELECT p.*, k / (na.n + nb.n - k) AS j, na.total - sx AS ox, nb.total - sy AS oy
         FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE k >= 0.3 * greatest(na.n, nb.n)),
r AS (SELECT a, b, x, y, ox + sum(x) OVER up AS xs, oy + sy - sum(y) OVER up AS ys
      FROM common JOIN cand USING (a, b) WINDOW up AS (PARTITION BY a, b ORDER BY x / y DESC RANGE UNBOUNDED PRECEDING)),
jp AS (SELECT a, b, sum(1 / (xs / x + ys / y)) AS jp FROM r GROUP BY a, b),
link AS (SELECT a, b FROM cand JOIN jp USING (a, b) WHERE j >= 0.8 OR jp >= 0.8),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON reach.b = l.a),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(class.class_id, d.doc_id) AS class_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles
FROM documents d LEFT JOIN class ON class.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@register("op9_probminhash", SQL)
def op9_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: five-word shingles, similarity 0.8 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))
