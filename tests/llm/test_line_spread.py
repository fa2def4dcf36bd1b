"""op10: against DuckDB, the exact count near the threshold, edge cases."""

import pytest

from corpus_pipeline import drop_boilerplate
from quarry.llm import line_spread as L
from quarry.llm.q_lines import SQL, op10_line_spread
from quarry.plans.oracle import canonical, duckdb_frame

from .conftest import LONG, ODD_TEXTS, by_id


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    got = op10_line_spread(spark, d).toPandas()
    assert canonical(got) == canonical(duckdb_frame(SQL, d))
    if sf == "0.01":
        assert got["n_removed"].sum() > 100


def test_spread_counts_sites_not_rows(spark):
    line = "one boilerplate line here"
    rows = [(i, f"own line number {i} of it\n  {line} \nshort", f"s{i % 9}") for i in range(60)]          # nine sites
    rows += [(100 + i, f"another shared line there\nkeep me as I am {i}", f"t{i}") for i in range(12)]  # twelve
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = by_id(L.remove_boilerplate(df).collect())
    assert all(got[i]["n_removed"] == 0 and got[i]["text"] == rows[i][1] for i in range(60))
    assert got[100]["text"] == rows[60][1]                                                             # the keeper
    assert all(got[100 + i]["text"] == f"keep me as I am {i}" for i in range(1, 12))
    got = by_id(L.remove_boilerplate(df, min_sites=9).collect())
    assert got[0]["n_removed"] == 0 and got[1]["text"] == "own line number 1 of it\nshort"


def test_near_estimates_are_counted_exactly(spark):
    """Coarse sketches miss the threshold by a few sites; the exact count decides."""
    rows = [(i, "a shared line of text", f"site-{i}") for i in range(100)]
    lines = spark.createDataFrame([(r[0], r[2], 1) for r in rows] + [(i, f"site-{i}", 2) for i in range(99)], "key bigint, site string, h bigint")
    got = {r["h"]: r["n_sites"] for r in L.boilerplate(lines, 100, lg_k=6, near=0.6).collect()}
    assert got == {1: 100}


def test_edges(spark, odd, empty):
    rows = L.remove_boilerplate(odd, min_sites=1, min_words=1).collect()          # every line but its keeper's
    assert len(rows) == odd.count()
    got = by_id(rows)
    assert got[0]["text"] is None and got[0]["n_lines"] == 0 and got[1]["text"] == ""
    assert got[4]["text"] == "Tie tie" and got[5]["text"] == "" and got[5]["n_removed"] == 1
    assert got[7]["text"] == LONG and got[8]["text"] == ODD_TEXTS[8]
    assert sum(r["doc_id"] is None and r["text"] == "no id here" for r in rows) == 1
    assert got[3]["gone"] == "extra" and got[3]["row"] == "extra"
    assert L.remove_boilerplate(empty).count() == 0


def test_pipeline_stage_drops_long_passages_on_few_sources(spark, sf):
    """Passages on two sources, most of them on a hot one, and lines of a dozen words on four."""
    passage = " ".join(f"word{i}" for i in range(60))
    tabbed = passage.replace("word", "cell").replace(" ", "\t")
    dozen = " ".join(f"term{i}" for i in range(12))
    rows = [(i, f"own text of document {i}\n{passage}\n{tabbed}", "hot" if i else "cold") for i in range(9)]
    rows += [(20 + i, f"other text of document {i}\n{dozen}", f"s{i}") for i in range(4)]
    rows += [(30 + i, f"some text of document {i}\na short line here\n{dozen} and more", f"s{i}") for i in range(3)]
    rows += [(40 + i, f"more text of document {i}\n{passage} on one source", "hot") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "'en' AS lang", "1L AS n_chars")
    got = by_id(drop_boilerplate(spark, df, sf).collect())
    text = {r[0]: r[1] for r in rows}
    for i in text:
        gone = 1 <= i < 9 or 21 <= i < 24
        assert got[i]["text"] == (text[i].split("\n")[0] if gone else text[i])
