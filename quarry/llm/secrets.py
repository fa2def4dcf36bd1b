"""Secret scans through a trigram index.

Each rule's regular expression gives a Boolean trigram query; the posting lists of its trigrams
are intersected, and only the texts left are searched with that expression.  A rule without
mandatory trigrams searches every text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import trigrams
from quarry.llm.common import map_arrow, slices, texts


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` is searched leftmost and without overlap; a match whose ``group`` is shorter
    than ``least`` is dropped after it was found, so it still covers its characters."""
    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found = re.compile(self.pattern, self.flags).finditer(text)
        return [(self.kind, m.start(), m.end()) for m in found
                if m.end(self.group) - m.start(self.group) >= self.least]


# The three base kinds, in their order.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               re.ASCII | re.IGNORECASE, 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=20),
    SecretRule("hex", r"[0-9a-f]{24,}"),      # the maximal runs of 24 or more
)
# Well-known formats besides.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----"),
    SecretRule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, rules: Sequence[SecretRule] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, spans`` per row: spans by start, then by the order of the rules; offsets count code
    points and the end is exclusive.

    Null and empty texts have no span; repeated rows and null keys each give their row; very long
    texts are indexed and searched whole; other columns are left behind; no rows give none."""
    rules = list(rules)
    kind = docs.schema[key].dataType.simpleString()
    src = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    # The index knows a text by a hash: equal hashes of different texts only add candidates.
    src = src.withColumn("_hash", F.xxhash64("_key", "_text"))
    queries = {r.kind: trigrams.trigram_query(r.pattern) for r in rules}
    wanted = {g for q in queries.values() if q is not None for s in q for g in s}
    full = [r.kind for r in rules if queries[r.kind] is None]
    found = trigrams.candidates(trigrams.postings(src, "_hash", "_text", wanted), queries, "_hash")

    def verify(batches):
        order = {r.kind: i for i, r in enumerate(rules)}
        for b in slices(batches, "_text"):
            out = []
            for t, some in zip(texts(b.column("_text")), b.column("rules").to_pylist()):
                check = set(full).union(some or ())
                spans = [s for r in rules if r.kind in check for s in r.spans(t)]
                spans.sort(key=lambda s: (s[1], order[s[0]], s[2]))
                out.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
            span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            yield pa.RecordBatch.from_arrays([b.column("_key"), pa.array(out, pa.list_(span))], [key, "spans"])

    return map_arrow(src.join(found, "_hash", "left").select("_key", "_text", "rules"),
        verify, f"`{key}` {kind}, spans {SPAN}")
