"""Quality rules by weak supervision.

Rules vote good, vote bad or abstain on each document.  Nobody says how far a rule can be
trusted: expectation-maximisation over the counts of vote patterns of *all* documents estimates
each rule's vote rates among good and among bad documents, and a document is kept by its
posterior probability of being good, not by passing every rule.

The statistics of a text are counted once in Arrow batches and written; votes are column
expressions over them; the patterns (at most 3^rules, whatever the corpus) are counted by Spark
and only their counts reach the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, map_arrow, slices, texts, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper_words", "n_exclaims", "n_stops", "n_adjacent", "n_distinct", "n_alpha_words")
MAX_RULES = 10                      # 3^10 = 59,049 patterns at most
VOTES = GOOD, ABSTAIN, BAD = "+", "0", "-"


def repeated_words(ids: np.ndarray, n_distinct: int, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    if len(ids) <= width:
        return 0
    n = len(ids) - width + 1
    code, base = ids[:n].astype(np.int64), max(1, n_distinct)
    for j in range(1, width):
        if base > 2**62 // max(1, n_distinct):          # recode before the product overflows
            base, code = (lambda u: (len(u[0]), u[1]))(np.unique(code, return_inverse=True))
        code, base = code * n_distinct + ids[j:n + j], base * n_distinct
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    covered = np.zeros(len(ids), bool)
    for j in range(width):
        covered[j:n + j] |= again
    return int(covered.sum())


def text_stats(text: str) -> tuple[int, ...]:
    """The numbers named in STATS for a whole text."""
    words = WORD.findall(text)
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0, text.count("!"), 0, 0, 0, 0)
    of: dict[str, int] = {}
    ids = np.array([of.setdefault(w, len(of)) for w in words], np.int64)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dups,
            repeated_words(ids, len(of)), lines, sum(map(str.isupper, words)), text.count("!"),
            text.count(".") + text.count("?"), int((ids[1:] == ids[:-1]).sum()), len(of),
            sum(map(str.isalpha, words)))


def document_stats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and STATS per row.  Null and empty texts count nothing; other columns are left behind."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in slices(batches, "_text"):
            cols = zip(*map(text_stats, texts(b.column("_text"))))
            yield pa.RecordBatch.from_arrays([b.column("_key"), *(pa.array(c, pa.int64()) for c in cols)],
                                             [key, *STATS])

    return map_arrow(
        docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")), run, f"`{key}` {kind}, " + ", ".join(f"{s} bigint" for s in STATS))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""
    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        no = F.lit(False)
        return (F.when(F.coalesce(self.bad, no), BAD).when(F.coalesce(self.good, no), GOOD).otherwise(ABSTAIN))


def default_rules() -> list[Rule]:
    """Thresholds on shares of words or lines; the middle ground of a measure abstains."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c: F.col(c) / n
    dup = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    mean = share("word_chars")
    return [
        Rule("length", F.col("n_words") >= 100, F.col("n_words") < 50),
        Rule("symbols", share("n_symbols") < 0.05, share("n_symbols") > 0.2),
        Rule("alphabetic", share("n_alpha_words") > 0.7, share("n_alpha_words") < 0.6),
        Rule("repeats", share("n_repeat_words") < 0.1, share("n_repeat_words") > 0.4),
        Rule("adjacent", share("n_adjacent") < 0.05, share("n_adjacent") > 0.2),
        Rule("dup_lines", dup < 0.1, dup > 0.3),
        Rule("word_length", mean.between(3, 10), ~mean.between(2, 15)),
        Rule("upper_case", share("n_upper_words") < 0.1, share("n_upper_words") > 0.4),
        Rule("exclaims", share("n_exclaims") < 0.05, share("n_exclaims") > 0.3),
        Rule("sentences", share("n_stops").between(0.02, 0.5), (share("n_stops") < 0.005) & (n > 30)),
    ]


@dataclass(frozen=True)
class VoteModel:
    """``rates[rule, class, vote]`` with classes (bad, good) and votes (+, 0, -)."""
    prior: float
    rates: np.ndarray

    def accuracies(self) -> np.ndarray:
        """Share of right votes among the votes that a rule casts."""
        p = np.array([1 - self.prior, self.prior])
        right = self.rates[:, 1, 0] * p[1] + self.rates[:, 0, 2] * p[0]
        cast = (self.rates[:, :, 0] + self.rates[:, :, 2]) @ p
        return right / np.maximum(cast, 1e-12)

    def posterior(self, patterns: Sequence[str]) -> np.ndarray:
        at = np.array([VOTES.index(v) for p in patterns for v in p])
        votes = at.reshape(len(patterns), -1)
        log = np.log(self.rates)[np.arange(votes.shape[1]), :, votes].sum(1)
        odds = np.log(self.prior) - np.log(1 - self.prior) + log[:, 1] - log[:, 0]
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit_votes(counts: dict[str, int], n_rules: int, rounds: int = 100, smooth: float = 1.0) -> VoteModel:
    """Expectation-maximisation over pattern counts.  It starts from the share of bad votes, so
    the second class is the good one.  Without patterns every rate is uniform and the prior one half."""
    patterns = list(counts)
    if not patterns:
        return VoteModel(0.5, np.full((n_rules, 2, 3), 1 / 3))
    n = np.array([counts[p] for p in patterns], float)
    hot = np.array([[[v == k for k in (GOOD, ABSTAIN, BAD)] for v in p] for p in patterns], float)
    bad = hot[:, :, 2].sum(1)
    q = np.where(bad == 0, 0.95, 0.3 / np.maximum(bad, 1))
    for _ in range(rounds):
        w = np.stack([n * (1 - q), n * q])                              # class, pattern
        rates = np.einsum("cp,prv->rcv", w, hot) + smooth
        rates /= rates.sum(2, keepdims=True)
        prior = float((w[1].sum() + smooth) / (w.sum() + 2 * smooth))
        model = VoteModel(prior, rates)
        new = model.posterior(patterns)
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return model


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", key: str = "doc_id",
          threshold: float = 0.5) -> tuple[DataFrame, VoteModel]:
    """``key``, STATS, ``votes``, ``posterior`` and ``good`` per row, and the fitted model.

    Null and empty texts have zero counts and are judged like any other pattern; repeated rows
    each count; ties of votes are settled by the posterior (``good`` if it reaches the
    threshold); an empty table gives no rows; other columns are left behind."""
    rules = list(rules or default_rules())
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules: their patterns go to the driver")
    stats = written(document_stats(docs, text, key).withColumn("votes", F.concat(*[r.vote() for r in rules])),
                    "quality-stats")
    counts = {r["votes"]: r["n"] for r in stats.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = fit_votes(counts, len(rules))
    patterns = list(counts)
    rows = [(p, float(x)) for p, x in zip(patterns, model.posterior(patterns) if patterns else [])]
    table = docs.sparkSession.createDataFrame(rows, "votes string, posterior double")
    return (stats.join(F.broadcast(table), "votes")        # at most 3^rules rows
            .withColumn("good", F.col("posterior") >= threshold)), model
