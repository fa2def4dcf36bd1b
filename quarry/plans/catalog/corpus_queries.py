"""Corpus-preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.constants import DOC_CAP, IBD_KEYWORDS, MIN_DOC_CHARS, VAL_SHARD
from quarry.operators import corpus as C
from quarry.operators import text_ops as TX
from quarry.plans import sqltext as S
from quarry.plans.registry import register
from quarry.plans.standins import (conversation_cases, conversation_case_items, deposit_records,
                                   cached_files)
from quarry.sources.manifest import flag_suspect_files, parse_deposit_manifest
from quarry.sources.tabular import union_sources
from quarry.session import read_table, spread

NUM_SHARDS = 10         # the reference downloads 10 training shards by default
SHARD_DOCS = 100        # documents per shard here, so that the tables fill several shards
BUDGET = 500_000        # characters of the budget query, so that it is crossed
# phrases that occur in the tables, beside the reference's
PHRASES = [*IBD_KEYWORDS, "apache license", "mit license", "cc by-nc"]


def corpus_docs(spark, sf_dir):
    """The corpus: documents longer than 100 characters."""
    return TX.filter_min_length(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def assigned_docs(spark, sf_dir):
    return C.shard_assignment(corpus_docs(spark, sf_dir), docs_per_shard=SHARD_DOCS)


def _combine_sql(cols: list[str], min_len: int | None = None) -> str:
    parts = ", ".join(S.strip(f"CAST({c} AS VARCHAR)") for c in cols)
    cond = "x IS NOT NULL AND x NOT IN ('nan', '')" + (f" AND length(x) > {min_len}" if min_len else "")
    return f"array_to_string(list_filter([{parts}], lambda x: {cond}), chr(10) || chr(10))"


SHARD_SQL = f"""
WITH docs AS (SELECT doc_id, text FROM documents WHERE length(text) > {MIN_DOC_CHARS}),
ord AS (SELECT doc_id, text,
               CAST(row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS BIGINT) AS idx,
               greatest(50, CAST(floor(count(*) OVER () * 0.1) AS BIGINT)) AS n_val FROM docs),
asg AS (SELECT doc_id, text, idx, CASE WHEN idx < n_val THEN 'val' ELSE 'train' END AS split,
               CAST(CASE WHEN idx < n_val THEN {VAL_SHARD} ELSE (idx - n_val) // {SHARD_DOCS} END AS BIGINT) AS shard
        FROM ord)
"""


@register("scan_text_parquet", sql="SELECT doc_id, text FROM documents")
def q_scan_text_parquet(spark, sf_dir):
    """A1: only the key and ``text`` columns are read from the parquet scan."""
    return read_table(spark, sf_dir, "documents", "doc_id", "text")


UNION_SQL = f"""
SELECT 'documents' AS source, doc_id AS doc_key, {_combine_sql(['text'])} AS text FROM documents
WHERE length({_combine_sql(['text'])}) > 100
UNION ALL
SELECT 'conversations', conv_id * 100 + turn, {_combine_sql(['text'])} FROM conversations
WHERE length({_combine_sql(['text'])}) > 100
UNION ALL
SELECT 'pages', page_id, {_combine_sql(['url', 'html'])} FROM pages
WHERE length({_combine_sql(['url', 'html'])}) > 100
"""


def _generic(df, key_expr):
    """A generic source: text columns by keyword, else all string columns."""
    keyed = df.withColumn("doc_key", key_expr)
    return TX.combine_text_columns(keyed.drop(*[c for c in df.columns if c.endswith("_id") or c == "turn"]),
                                   ["doc_key"])


def source_frames(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    pages = read_table(spark, sf_dir, "pages")
    return {
        "documents": _generic(spread(docs), F.col("doc_id")),
        "conversations": _generic(spread(conv), F.col("conv_id") * 100 + F.col("turn")),
        "pages": _generic(spread(pages), F.col("page_id")),
    }


def _union(spark, sf_dir):
    return union_sources(source_frames(spark, sf_dir))


@register("union_sources", sql=UNION_SQL)
def q_union_sources(spark, sf_dir):
    """A5 (= F1): documents of three sources of different shape, each combined by its own
    column choice, in one frame with a ``source`` tag."""
    return _union(spark, sf_dir)


@register("pick_columns_by_keyword", sql=f"""
SELECT conv_id * 100 + turn AS doc_key, {_combine_sql(['text'])} AS text FROM conversations
WHERE length({_combine_sql(['text'])}) > 100""")
def q_pick_columns_by_keyword(spark, sf_dir):
    """B1 + B5: conversations — the ``text`` column is chosen by name."""
    conv = read_table(spark, sf_dir, "conversations")
    return _generic(conv, F.col("conv_id") * 100 + F.col("turn"))


@register("combine_text_columns", sql=f"""
SELECT page_id AS doc_key, {_combine_sql(['url', 'html'])} AS text FROM pages
WHERE length({_combine_sql(['url', 'html'])}) > 100""")
def q_combine_text_columns(spark, sf_dir):
    """B2 + B5: pages — no column name matches, so all string columns are combined."""
    return _generic(read_table(spark, sf_dir, "pages"), F.col("page_id"))


@register("explode_cases", sql="""
SELECT conv_id, turn, case_text AS text
FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS case_text FROM conversations WHERE text IS NOT NULL)
WHERE length(case_text) > 100""")
def q_explode_cases(spark, sf_dir):
    """One document per element of a nested ``cases`` array (stand-in: the lines of a
    conversation turn); null arrays give nothing; no strip before the length test."""
    return TX.explode_cases(conversation_cases(spark, sf_dir), ["conv_id", "turn"])


@register("combine_case_fields", sql=f"""
SELECT conv_id, turn, {_combine_sql(['text', "role || ': ' || text", 'role'], 20)} AS text FROM conversations
WHERE length({_combine_sql(['text', "role || ': ' || text", 'role'], 20)}) > 100""")
def q_combine_case_fields(spark, sf_dir):
    """A3 + B6: JSON case lists (one per conversation turn, written with ``to_json`` and parsed
    back): keys in fixed order, values stripped and longer than 20 characters."""
    items = conversation_case_items(spark, sf_dir)
    return (items.select("conv_id", "turn", TX.combine_case_fields("item").alias("text"))
                 .where(F.length("text") > MIN_DOC_CHARS))


@register("filter_min_length", sql="SELECT doc_id, text FROM documents WHERE length(text) > 100")
def q_filter_min_length(spark, sf_dir):
    """Documents longer than 100 characters."""
    return corpus_docs(spark, sf_dir)


KW_SQL = " OR ".join(f"contains(lower(text), {S.lit(k)})" for k in
                     __import__("quarry.functions.text", fromlist=["x"]).minimal_phrases(
                         PHRASES))


@register("filter_keywords_any", sql=f"SELECT doc_id, text FROM documents WHERE length(text) > 100 AND ({KW_SQL})")
def q_filter_keywords_any(spark, sf_dir):
    """Long documents that mention any of the phrases (lower-cased substring)."""
    return TX.filter_keywords_any(TX.filter_min_length(spread(read_table(spark, sf_dir, "documents", "doc_id", "text"))), PHRASES)


@register("pick_first_candidate", sql=f"""
SELECT doc_id, {S.strip('text')} AS text FROM documents WHERE text IS NOT NULL AND length({S.strip('text')}) > 80""")
def q_pick_first_candidate(spark, sf_dir):
    """B3 + B10 + B8: a report table with a candidate column (``text``): non-null, stripped,
    longer than 80 characters."""
    return TX.report_texts(read_table(spark, sf_dir, "documents"), ["doc_id"])


@register("pick_longest_text_column", sql=f"""
SELECT page_id, {S.strip('html')} AS text FROM pages WHERE html IS NOT NULL AND length({S.strip('html')}) > 80""")
def q_pick_longest_text_column(spark, sf_dir):
    """B4 + B10: no candidate column in ``pages``, so the string column with the greatest
    mean length (``html``) is taken."""
    return TX.report_texts(read_table(spark, sf_dir, "pages"), ["page_id"])


@register("cap_text", sql=f"""
SELECT doc_id, substr(text, 1, {DOC_CAP}) AS text, CAST(length(substr(text, 1, {DOC_CAP})) AS BIGINT) AS n_chars
FROM documents""")
def q_cap_text(spark, sf_dir):
    """The first 10,000 characters of each document (the tokenizer's per-document cap)."""
    d = TX.cap_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"), DOC_CAP)
    return d.withColumn("n_chars", F.length("text").cast("long"))


@register("corpus_counts", sql=f"""
SELECT n_loaded, n_long, n_relevant, n_val, n_long - n_val AS n_train
FROM (SELECT n_loaded, n_long, n_relevant, least(n_long, greatest(50, CAST(floor(n_long * 0.1) AS BIGINT))) AS n_val
      FROM (SELECT CAST(count(*) AS BIGINT) AS n_loaded,
                   CAST(count_if(length(text) > 100) AS BIGINT) AS n_long,
                   CAST(count_if(length(text) > 100 AND ({KW_SQL})) AS BIGINT) AS n_relevant FROM documents))""")
def q_corpus_counts(spark, sf_dir):
    """Loaded, long enough, relevant, train and validation counts in one pass."""
    return C.corpus_counts(read_table(spark, sf_dir, "documents", "text"), phrases=PHRASES)


@register("shard_assignment", sql=SHARD_SQL + "SELECT doc_id, idx, split, shard FROM asg")
def q_shard_assignment(spark, sf_dir):
    """D9 + E5: seeded shuffle (md5 order), first max(50, 10 %) to validation shard 6542,
    the rest to train shards of 5,000."""
    return assigned_docs(spark, sf_dir).select("doc_id", "idx", "split", "shard")


@register("shard_stats", sql=SHARD_SQL + """
SELECT split, shard, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes
FROM asg GROUP BY split, shard""")
def q_shard_stats(spark, sf_dir):
    """Documents and bytes per shard of the prepared corpus (the flagship)."""
    return C.shard_stats(assigned_docs(spark, sf_dir))


@register("scan_split", sql=SHARD_SQL + "SELECT doc_id, text, shard FROM asg WHERE split = 'train'")
def q_scan_split(spark, sf_dir):
    """The training split (all shards but the pinned validation shard)."""
    return assigned_docs(spark, sf_dir).where(F.col("split") == "train").select("doc_id", "text", "shard")


@register("char_budget", sql=SHARD_SQL + f"""
SELECT doc_id, idx, n_chars FROM (
  SELECT doc_id, idx, CAST(least(length(text), {DOC_CAP}) AS BIGINT) AS n_chars,
         coalesce(sum(least(length(text), {DOC_CAP})) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM asg WHERE split = 'train') WHERE before < {BUDGET}""")
def q_char_budget(spark, sf_dir):
    """D8 (+ B11): the tokenizer's training input — train documents in shuffled order, each
    counted up to 10,000 characters, until the budget (the crossing one included)."""
    train = assigned_docs(spark, sf_dir).where(F.col("split") == "train")
    n_chars = F.least(F.length("text"), F.lit(DOC_CAP)).cast("long")
    kept = C.char_budget(train, "idx", n_chars, BUDGET)
    return kept.select("doc_id", "idx", n_chars.alias("n_chars"))


@register("plan_missing_shards", sql=SHARD_SQL + f""",
wanted AS (SELECT range AS shard FROM range({NUM_SHARDS}) UNION SELECT {VAL_SHARD}),
have AS (SELECT DISTINCT shard FROM asg)
SELECT w.shard, h.shard IS NOT NULL AS present FROM wanted w LEFT JOIN have h ON w.shard = h.shard""")
def q_plan_missing_shards(spark, sf_dir):
    """A9 (+ F2, G3): which of the wanted shards (10 train + validation) exist."""
    return C.plan_missing_shards(spark, assigned_docs(spark, sf_dir), NUM_SHARDS)


@register("stream_split", sql="""
SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT < 429496729
                    THEN 'val' ELSE 'train' END AS split FROM documents""")
def q_stream_split(spark, sf_dir):
    """L2 (batch form): the stateless hash split used by streaming ingestion."""
    return C.stream_split(read_table(spark, sf_dir, "documents", "doc_id"))


@register("parse_deposit_manifest", sql="""
SELECT page_id AS record_id,
       CASE page_id % 3 WHEN 0 THEN 'cases.parquet' ELSE 'abstracts.parquet' END AS file_name,
       CAST(strlen(html) AS BIGINT) AS size_bytes, url
FROM pages WHERE page_id % 3 IN (0, 1) AND coalesce(url, '') <> ''""")
def q_parse_deposit_manifest(spark, sf_dir):
    """A10 (+ G2): deposit records in two namings, parsed; wanted files and their links."""
    return parse_deposit_manifest(deposit_records(spark, sf_dir), "record", ["record_id"])


@register("flag_suspect_files", sql="""
SELECT page_id, size_bytes, content_type, size_bytes < 10000 AS too_small,
       contains(lower(content_type), 'json') OR contains(lower(content_type), 'html') AS bad_type,
       NOT (size_bytes < 10000) AND NOT (contains(lower(content_type), 'json') OR contains(lower(content_type), 'html')) AS keep
FROM (SELECT page_id, CAST(strlen(html) AS BIGINT) AS size_bytes,
             CASE page_id % 4 WHEN 0 THEN 'application/zip' WHEN 1 THEN 'application/octet-stream'
                              WHEN 2 THEN 'application/json' ELSE 'text/html; charset=utf-8' END AS content_type
      FROM pages)""")
def q_flag_suspect_files(spark, sf_dir):
    """Cached downloads that are too small or an error page."""
    return flag_suspect_files(cached_files(spark, sf_dir))
