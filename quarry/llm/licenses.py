"""License scans: notice phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

A text's words (A-Z in lower case, runs of digits, a-z and what is not ASCII) are joined by one
space, and one automaton over them finds every place of every phrase, whatever stands between the
words in the text.  Identifier tags are phrases too; behind such a place the raw line holds a
licence expression, which a shunting-yard parser turns into postfix and evaluates:

* ``A or B``: the reader's choice, so its burden is the smaller one and either may be allowed;
* ``A and B``: both hold, so the larger burden counts and both must be allowed;
* ``A with E``: an exception to A; it lightens the burden to at most ``EXCEPTED``.

``with`` binds tighter than ``and``, ``and`` tighter than ``or``; a word that is no operator where
one must stand ends the expression, and so does the end of the line.  An expression that cannot be
parsed (no operand, an open parenthesis) gives its tag place but no label."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# More notices, by their usual wording.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier", "license expression")
# Words that make the phrase behind them a grant rather than a mention.
GRANTS = ("licensed under", "released under", "distributed under", "available under", "under the terms of")
# Beginnings of identifiers, longest first, and their labels.
FAMILIES = (("apache", "apache"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("gfdl", "gfdl"), ("mpl", "mpl"),
            ("epl", "epl"), ("cc-by", "cc-by"), ("cc0", "cc0"), ("bsd", "bsd"), ("mit", "mit"), ("isc", "isc"),
            ("bsl", "boost"), ("unlicense", "unlicense"))
# What a licence asks of its reader, from nothing to everything.
BURDEN = {"public-domain": 0.0, "unlicense": 0.0, "cc0": 0.0, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "boost": 0.1, "apache": 0.2,
          "cc-by": 0.3, "epl": 0.5, "mpl": 0.5, "lgpl": 0.6, "gfdl": 0.8, "gpl": 0.8, "agpl": 0.9, "all-rights-reserved": 1.0}
OTHER, EXCEPTED = 0.7, 0.4       # of an identifier of no known family, and under an exception
ALLOWED = 0.5                    # burdens up to this are allowed
# How sure a single finding makes us that the text states its licence.
SURE = {"tag": 0.95, "grant": 0.9, "notice": 0.6}
NEAR = 4                         # words between a grant's words and its phrase, at most

WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")     # a word before it is lower-cased
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
LEAD = re.compile("[ \t:=\"']*")
BINDS = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Terms:
    """What an expression, or a part of it, comes to."""
    labels: frozenset[str]
    burden: float
    allowed: bool


def family(name: str) -> str | None:
    low = name.lower()
    return next((label for head, label in FAMILIES if low.startswith(head)), None)


def postfix(line: str, at: int = 0) -> list[str]:
    """The expression that starts at ``at`` in postfix order (shunting-yard); empty if there is none."""
    out, ops, depth, operand_next = [], [], 0, True
    while m := TOKEN.match(line, at):
        t = m[1]
        low = t.lower()
        if operand_next:
            if t == "(":
                ops.append(t)
                depth += 1
            elif t == ")" or low in BINDS:
                return []
            else:
                out.append(t)
                operand_next = False
        elif t == ")":
            if not depth:
                break
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
            depth -= 1
        elif low in BINDS:
            while ops and ops[-1] != "(" and BINDS[ops[-1]] >= BINDS[low]:
                out.append(ops.pop())
            ops.append(low)
            operand_next = True
        else:
            break
        at = m.end()
    if depth or operand_next:
        return []
    return out + ops[::-1]


def evaluate(items: list[str], allowed: float = ALLOWED) -> Terms | None:
    """The terms of a postfix expression; None if it is empty or an exception is no name."""
    stack: list[tuple[Terms, str | None]] = []          # with the name while it is a single one
    for t in items:
        if t not in BINDS:
            label = family(t)
            burden = BURDEN[label] if label else OTHER
            stack.append((Terms(frozenset([label] if label else []), burden, burden <= allowed), t))
            continue
        (b, name), (a, _) = stack.pop(), stack.pop()
        if t == "with":
            if name is None:
                return None
            burden = min(a.burden, EXCEPTED)
            got = Terms(a.labels, burden, burden <= allowed)
        elif t == "and":
            got = Terms(a.labels | b.labels, max(a.burden, b.burden), a.allowed and b.allowed)
        else:
            got = Terms(a.labels | b.labels, min(a.burden, b.burden), a.allowed or b.allowed)
        stack.append((got, None))
    return stack[0][0] if len(stack) == 1 else None


class Scanner:
    """The automaton; ``scan`` gives a text's findings."""

    def __init__(self):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        kinds = {p: ("base", label) for p, label in BASE_PHRASES.items()} | {p: ("more", label) for p, label in MORE_PHRASES.items()}
        kinds |= {p: ("tag", "") for p in TAGS} | {p: ("grant", "") for p in GRANTS}
        for phrase, (kind, label) in kinds.items():
            self.automaton.add_word(f" {phrase} ", (phrase.count(" ") + 1, len(phrase) + 1, kind, label))
        self.automaton.make_automaton()

    def scan(self, raw: bytes) -> tuple:
        """Number of words, base places (first word, label), other notices (label, granted), and the
        terms of the tags' expressions with the expressions (None for one that cannot be parsed)."""
        words = raw.translate(FOLD).split()
        # One character a byte: the phrases are ASCII, so places agree.
        joined = f" {b' '.join(words).decode('latin-1')} " if words else " "
        base, notices, grants, tags = [], [], [], []
        at, seen = 0, 0                                   # words before character ``at``
        for end, (n, size, kind, label) in self.automaton.iter(joined):
            # The place is counted at the space behind it, which only moves on.
            seen += joined.count(" ", at, end)
            at = end
            first = seen - n
            if kind == "tag":
                tags.append(first + n)
            elif kind == "grant":
                grants.append(first + n)
            else:
                notices.append((first, label))
                if kind == "base":
                    base.append((first, label))
        return len(words), base, notices, grants, self._expressions(raw, tags) if tags else []

    def _expressions(self, raw: bytes, tags: list[int]) -> list[tuple[str, Terms | None]]:
        """The expression behind each tag, ``tags`` being the numbers of the words after them."""
        wanted, out = {n - 1 for n in tags}, []
        text = raw.decode("latin-1")                      # expressions are ASCII
        for i, m in enumerate(WORD_BYTES.finditer(raw)):
            if i in wanted:
                items = postfix(text, LEAD.match(text, m.end()).end())
                out.append((" ".join(items), evaluate(items)))
        return out


def summary(found: tuple) -> tuple:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score, burden, allowed, expressions``."""
    n, base, notices, grants, expressions = found
    places = [p for p, _ in base]
    terms = [t for _, t in expressions if t is not None]
    ends = sorted(grants)
    kinds = ["tag"] * len(terms)
    for first, _ in notices:
        i = bisect_right(ends, first)                     # grants that end before the notice
        kinds.append("grant" if i and first - ends[i - 1] <= NEAR else "notice")
    doubt = 1.0
    for kind in sorted(set(kinds)):                       # a kind counts once, however often it stands
        doubt *= 1 - SURE[kind]
    burdens = [BURDEN[label] for _, label in notices] + [t.burden for t in terms]
    labels = {label for _, label in notices}.union(*(t.labels for t in terms))
    allowed = all(BURDEN[label] <= ALLOWED for _, label in notices) and all(t.allowed for t in terms)
    return (n, len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})),
            ",".join(sorted(labels)), 1 - doubt, max(burdens, default=None), allowed if burdens else None,
            [e for e, t in expressions if t is not None])


FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
          "score double, burden double, allowed boolean, expressions array<string>")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Findings of every row of ``docs``: ``key`` and ``FIELDS``.

    ``n_base``, ``first_word`` and ``last_word`` tell of the base phrases' places; ``labels`` are those of
    all phrases and expressions, distinct and sorted; ``score`` is how sure it is that the text states a
    licence (0 without a finding); ``burden`` the heaviest finding's, ``allowed`` whether all findings are,
    both null without one; ``expressions`` in postfix.

    A null text is an empty one and has no finding; repeated rows and null keys each give their row; very
    long texts are scanned whole; other columns are left behind; an empty table gives no rows."""
    kind = docs.schema[key].dataType.simpleString()
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] * 2 + [pa.bool_(), pa.list_(pa.string())]
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches):
        scanner = Scanner()
        for b in slices(batches, "_text"):
            rows = [summary(scanner.scan(t or b"")) for t in b.column("_text").to_pylist()]
            cols = zip(*rows) if rows else ((),) * len(names)
            yield pa.RecordBatch.from_arrays([b.column("_key"), *(pa.array(c, t) for c, t in zip(cols, types))], [key, *names])

    src = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    return map_arrow(src, run, f"`{key}` {kind}, {FIELDS}")
