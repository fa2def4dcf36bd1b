import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta. " * 20_000        # 480,000 characters, one row
ODD_TEXTS = [None, "", " \n\t ", "one", "Tie tie", "Tie tie", "a\x00b \x1c\x85　c İΣ 漢字 😀 é.", LONG, "x" * 50_000]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, extra columns whose names
    clash with results or helpers."""
    rows = [(i, t, "en", "s1", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", None, None, None), (None, None, None, None, None), (5, "Tie tie", "en", "s1", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = ["_text", "_key", "key", "h", "row", "score", "spans", "rules", "rate", "p", "tokens", "w", "gone",
             "n_lines", "n_tokens", "token_ids", "time", "id", "class_id"]
    return df.select("*", *[F.lit("extra").alias(c) for c in extra]).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    return "/root/testdata/sf0.001"


def by_id(rows):
    return {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
