"""op7: against plain searches, trigram queries against matches, edge cases."""

import hashlib
import random
import re

import pytest

from quarry.llm import secrets as S
from quarry.llm import trigrams as T
from quarry.llm.q_secrets import op7_secret_scan
from quarry.session import read_table

from .conftest import by_id

KEYS = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
KEYS = KEYS.replace("[__]", "_")
ASSIGN = re.compile(rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def test_query_against_plain_search(spark, sf):
    got = by_id(op7_secret_scan(spark, sf).collect())
    docs = read_table(spark, sf, "documents", "doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        w = plain(d["text"])
        r = got[d["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in w) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in w).encode()).hexdigest()


TRICKY = ["password: token: abcdef1", "PassWord = 'hunter2hunter'", "apikey:abcdef API_KEY=zzzzzzz", "token=secret=abcdef",
          "AKIA" + "A" * 16, "AKIA" + "B" * 15, "xAKIAKIA" + "Z9" * 10, "f" * 24, "f" * 23 + " " + "0" * 30, "secret:ſecret",
          "toKen=abcdefg", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "passwd\x20\x20:\x20\x20\"abc.def\"", "İpassword=abcdef"]


def test_tricky_texts(spark, odd):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id bigint, text string")
    base = {r.kind for r in S.BASE_RULES}
    for r in S.scan(docs).collect():
        assert [tuple(s) for s in r["spans"] if s["kind"] in base] == plain(TRICKY[r["doc_id"]])
    more = {s["kind"] for r in S.scan(docs).collect() for s in r["spans"]} - base
    assert more == {"code_host", "private_key"}


@pytest.mark.parametrize("pattern", ["abc(de|fg)h?", "(?:foo|ba[rz])+qux", "x{2,3}yz", "a.c.e", "(ab)?cde", "[ab][cd][ef]g", "abc|", "a|bcd"])
def test_query_holds_for_every_match(pattern):
    q = T.trigram_query(pattern)
    r = random.Random(1)
    for _ in range(20_000):
        s = "".join(r.choice("abcdefghxyzoquABC") for _ in range(9))
        if re.search(pattern, s) and q is not None:
            assert any(all(g in s.lower() for g in part) for part in q)


def test_queries_of_the_rules():
    q = {r.kind: T.trigram_query(r.pattern) for r in S.RULES}
    assert q["hex"] is None and q["access"] == {frozenset({"aki", "kia"})} and len(q["assign"]) == 6


def test_full_index(spark, odd):
    rows = T.postings(odd, "doc_id", "text").where("doc_id = 3").collect()
    assert [r["trigram"] for r in rows] == ["one"]


def test_edges(spark, odd, empty):
    rows = S.scan(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == [] for r in rows)
    assert S.scan(empty).count() == 0
    long = spark.createDataFrame([(1, "word " * 100_000 + "password=hunter22"), (1, "word"), (None, "secret: abcdefgh")], "doc_id bigint, text string")
    assert sorted(len(r["spans"]) for r in S.scan(long).collect()) == [0, 1, 1]
