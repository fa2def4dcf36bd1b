"""quarry — corpus preparation, tokenizer and experiment analytics as Spark DataFrame jobs.

Every public operator is a plain function from DataFrame(s) to a DataFrame built on the
public PySpark API; Catalyst plans it, Spark executes it.  Sub-packages:

* ``sources``    — readers and writers (parquet shards, CSV/TSV, JSON, zip, logs, vocab)
* ``functions``  — column expressions (strip, NA words, labels, the pre-tokenizer pattern)
* ``operators``  — relational operators (text filters, shard assignment, BPE, packing,
                   metrics, experiment and run-log analytics, audit checks, skew-safe scans)
* ``plans``      — stand-in inputs derived from the driver tables and the query catalog
* ``streaming``  — Structured Streaming versions of ingestion and run monitoring
"""

__version__ = "0.1.0"
