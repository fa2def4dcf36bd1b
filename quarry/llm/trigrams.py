"""Boolean trigram queries from regular expressions, and an inverted trigram index.

A query is in disjunctive form: any of several sets of trigrams that must all occur.  It is
derived from the parsed expression: runs of literals and small classes are expanded to the
strings they can match, each string demands its trigrams, alternatives are joined by *or*,
parts in a row by *and*.  ``None`` means that nothing is mandatory.  Everything is in lower
case, and lower-casing a text keeps the trigrams of what an expression can match, so a query
never misses a match."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices, texts

_parser = re._parser
MAX_CLASS, MAX_STRINGS = 8, 256

Query = frozenset | None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > MAX_STRINGS:
        return a if len(a) <= len(b) else b      # weaker, still mandatory
    return _least(x | y for x in a for y in b)


def _least(sets: Iterable[frozenset]) -> Query:
    """Drop a set that asks for more than another: the other one already lets it in."""
    kept: list[frozenset] = []
    for s in sorted(set(sets), key=len):
        if not any(k <= s for k in kept):
            kept.append(s)
    return frozenset(kept)


def _any(parts: Iterable[Query]) -> Query:
    parts = list(parts)
    return None if any(p is None for p in parts) else _least(s for p in parts for s in p)


def _of_strings(strings: set[str]) -> Query:
    if any(len(s) < 3 for s in strings):
        return None
    return _least(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _strings(node) -> set[str] | None:
    """Every string that a node can match, lower-case, or None if there are too many."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, v in arg:
            if str(kind) == "LITERAL":
                out.add(chr(v).lower())
            elif str(kind) == "RANGE" and v[1] - v[0] < MAX_CLASS:
                out |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return out if len(out) <= MAX_CLASS else None
    if op == "SUBPATTERN":
        return _sequence_strings(arg[-1])
    if op == "BRANCH":
        parts = [_sequence_strings(p) for p in arg[1]]
        return None if any(p is None for p in parts) else _bounded(set().union(*parts))
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] is not None and int(arg[1]) <= 4:
        one = _sequence_strings(arg[2])
        if one is None:
            return None
        out, now = set(), {""}
        for k in range(int(arg[1]) + 1):
            if k >= int(arg[0]):
                out |= now
            now = {a + b for a in now for b in one}
            if len(now) > MAX_STRINGS:
                return None
        return _bounded(out)
    return {""} if op == "AT" else None


def _bounded(s: set[str]) -> set[str] | None:
    return s if len(s) <= MAX_STRINGS else None


def _sequence_strings(seq) -> set[str] | None:
    out = {""}
    for node in seq:
        s = _strings(node)
        if s is None or len(out) * len(s) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _query(node) -> Query:
    op, arg = str(node[0]), node[1]
    if op == "SUBPATTERN":
        return _sequence_query(arg[-1])
    if op == "BRANCH":
        return _any(_sequence_query(p) for p in arg[1])
    if op in ("MAX_REPEAT", "MIN_REPEAT") and int(arg[0]) >= 1:
        return _sequence_query(arg[2])
    return None


def _sequence_query(seq) -> Query:
    found, run = None, {""}
    for node in seq:
        s = _strings(node)
        if s is not None and len(run) * len(s) <= MAX_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        found = _both(found, _of_strings(run))
        run = {""} if s is None else s
        if s is None:
            found = _both(found, _query(node))
    return _both(found, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The mandatory trigrams of an expression: any of the sets, or None."""
    return _sequence_query(_parser.parse(pattern))


def postings(docs: DataFrame, key: str, text: str, wanted: Iterable[str] | None = None) -> DataFrame:
    """The inverted index: distinct ``trigram, key`` over whole texts, in lower case; ``wanted``
    keeps the posting lists that some query reads.  Null and empty texts have no trigram."""
    kind = docs.schema[key].dataType.simpleString()
    only = None if wanted is None else sorted(set(wanted))

    def run(batches):
        for b in slices(batches, "_text"):
            grams, at = [], []
            for i, t in enumerate(texts(b.column("_text"))):
                t = t.lower()
                found = [g for g in only if g in t] if only is not None else {t[j:j + 3] for j in range(len(t) - 2)}
                grams += found
                at += [i] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), b.column("_key").take(pa.array(at, pa.int64()))],
                                             ["trigram", key])

    return map_arrow(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), run, f"trigram string, `{key}` {kind}").distinct()


def candidates(index: DataFrame, queries: dict[str, Query], key: str) -> DataFrame:
    """``key, rules``: the keys whose posting lists meet a rule's query.  For each set of a
    query the lists of its trigrams are intersected: a key must be in all of them."""
    rows = [(g, rule, i, len(s)) for rule, q in queries.items() if q is not None
            for i, s in enumerate(sorted(q, key=sorted)) for g in sorted(s)]
    need = index.sparkSession.createDataFrame(rows, "trigram string, rule string, part int, size int")
    met = (index.join(F.broadcast(need), "trigram")          # as many rows as the rules have trigrams
           .groupBy(key, "rule", "part").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
           .where("n = size"))
    return met.groupBy(key).agg(F.array_sort(F.collect_set("rule")).alias("rules"))
