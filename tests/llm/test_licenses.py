"""op12: base places against a list of words, expressions against Python's own evaluation, odd inputs."""

import itertools
import random
import re

import pytest

from quarry.llm import licenses as L
from quarry.llm.catalog import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    hits = [(i, x) for p, x in BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def result(text):
    return L.summary(L.Scanner().scan(text.encode()))


def test_base_places_on_random_words():
    r, s = random.Random(5), L.Scanner()
    pool = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "x", "É", "MIT", "License", "1"]
    for _ in range(300):
        text = "".join(r.choice(pool) + r.choice([" ", "-", "\n", ", ", "_", "\t"]) for _ in range(r.randrange(30)))
        assert L.summary(s.scan(text.encode()))[:5] == brute(text)


def test_labels_keep_the_base():
    got = result("Licensed under the Apache License, Version 2.0, or the GNU Lesser General Public License; CC-BY 4.0")
    assert got[4:6] == ("apache,cc-by", "apache,cc-by,lgpl") and got[6] > 0.9
    assert result("no word of it")[4:9] == ("", "", 0.0, None, None)
    assert 0 < result("the MIT License")[6] < result("released under the MIT License")[6] < 1


@pytest.mark.parametrize("line, order, labels, burden, allowed", [
    ("MIT", "MIT", {"mit"}, 0.1, True),
    ("MIT OR GPL-2.0-only AND Apache-2.0", "MIT GPL-2.0-only Apache-2.0 and or", {"mit", "gpl", "apache"}, 0.1, True),
    ("(MIT OR GPL-2.0-only) AND Apache-2.0", "MIT GPL-2.0-only or Apache-2.0 and", {"mit", "gpl", "apache"}, 0.2, True),
    ("(MIT OR Apache-2.0) AND GPL-3.0+", "MIT Apache-2.0 or GPL-3.0+ and", {"mit", "gpl", "apache"}, 0.8, False),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR Own", "GPL-2.0 Classpath-exception-2.0 with Own or", {"gpl"}, 0.4, True),
    ("mit and bsd-3-clause rest of the line", "mit bsd-3-clause and", {"mit", "bsd"}, 0.1, True),
    ("Unknown-1.0", "Unknown-1.0", set(), 0.7, False),
])
def test_expressions(line, order, labels, burden, allowed):
    items = L.postfix(line)
    got = L.evaluate(items)
    assert (" ".join(items), set(got.labels), got.burden, got.allowed) == (order, labels, burden, allowed)


@pytest.mark.parametrize("line", ["", "OR MIT", "MIT OR", "(MIT", "(MIT OR", "()", "MIT AND OR GPL", ")", "(" * 5000])
def test_no_expression(line):
    assert L.postfix(line) == [] and L.evaluate([]) is None


def test_parenthesis_too_many_ends_the_expression():
    assert L.postfix("MIT) OR GPL") == ["MIT"]


def test_expressions_against_python():
    """Random expressions without exceptions: ``allowed`` as Python evaluates the same formula."""
    r = random.Random(11)
    names = {"MIT": True, "GPL-3.0": False, "Apache-2.0": True, "AGPL-3.0": False, "X": False}

    def formula(depth):
        if depth == 0 or r.random() < 0.3:
            return r.choice(list(names))
        text = f"{formula(depth - 1)} {r.choice(['AND', 'OR', 'and', 'Or'])} {formula(depth - 1)}"
        return f"({text})" if r.random() < 0.5 else text

    for text in (formula(4) for _ in range(200)):
        python = re.sub(r"[A-Za-z0-9.-]+", lambda m: str(names[m[0]]) if m[0] in names else m[0].lower(), text)
        assert L.evaluate(L.postfix(text)).allowed == eval(python)


def test_tags_in_texts():
    text = "/* SPDX-License-Identifier: (MIT OR GPL-2.0) */\n# spdx license identifier = 'Apache-2.0'\nSPDX-License-Identifier:\nISC"
    got = result(text)
    assert got[5] == "apache,gpl,mit" and got[9] == ["MIT GPL-2.0 or", "Apache-2.0"]
    assert got[8] is True and got[6] == pytest.approx(0.95)


def test_many_tags_on_one_line_take_linear_time():
    import time
    s, one = L.Scanner(), "SPDX-License-Identifier: (MIT OR x) licensed under mit license "
    took = []
    for n in (2_000, 16_000):
        at = time.process_time()
        s_got = L.summary(s.scan((one * n).encode()))
        took.append(time.process_time() - at)
        assert s_got[1] == n and len(s_got[9]) == n
    assert took[1] < 24 * max(took[0], 0.05)


def test_odd_and_empty(odd, empty):
    got = sorted((tuple(r)[:6] for r in L.scan(odd).collect()), key=repr)
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in odd.select("doc_id", "text").collect()), key=repr)
    assert got == want
    assert L.scan(empty).count() == 0


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op12_license_scan"](spark, sf).collect()
    assert len(rows) == len(docs) and any(r["n_base"] for r in rows)
    for r in rows:
        assert tuple(r)[1:6] == brute(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert list(itertools.islice(rows[0].asDict(), 8)) == [
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
