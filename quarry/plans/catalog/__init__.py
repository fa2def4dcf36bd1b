"""Importing this package registers every query (see ``quarry.plans.registry``)."""

from quarry.plans.catalog import (  # noqa: F401
    audit_queries,
    corpus_queries,
    experiment_queries,
    file_queries,
    runlog_queries,
    streaming_queries,
    tokenizer_queries,
)
