"""Importing this module registers every query of the package."""

import corpus_pipeline
from quarry.llm import (  # noqa: F401
    q_bpe,
    q_fim,
    q_html,
    q_licenses,
    q_lines,
    q_mixing,
    q_near_dup,
    q_quality,
    q_resample,
    q_secrets,
    q_tokens,
    q_topk,
    q_toxicity,
)
from quarry.llm.registry import QUERIES, SQL  # noqa: F401

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
