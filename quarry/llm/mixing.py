"""Mixing sources to target weights by soft membership.

A labelled table teaches a naive Bayes classifier over hashed words; it gives every document a
posterior over the domains, capped in its evidence so that memberships stay soft.  A document of
t tokens and posterior p adds t · p_d · r expected tokens to domain d when it is used at rate r.
Projected gradient steps find rates r >= floor whose expected domain totals S_d are nearest to the
targets T_d in sum over d of (S_d - T_d)² / N_d, N_d being the totals at rate 1.  The floor is 0 and
there is no upper bound unless they are asked for.  A document without tokens adds nothing at any
rate: it keeps the rate 1.

The step of a document is the product of its posterior and the weighted residuals (the gradient in
r · sqrt(t)), so it depends on the D residuals alone.  With those weights the largest curvature is
at most 1, so steps of 1 converge; momentum with restarts makes them converge fast where
memberships are soft.  A round is one aggregate: it reads tokens, posterior and the two numbers of the
state and takes the last few steps, which are written into a new state every ``FOLDED`` rounds, so that
the work of a round does not grow with the rounds.  A document's rate at the end is the fold of the
rounds' residuals, D numbers each.  All of it is DataFrame expressions; only D numbers a round reach
the driver.  Rounds end when all targets are met, or when the projected gradient is small: then no rates
are nearer to the targets."""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import delete, fresh, packed, shared_path, written

BUCKETS = 4096                 # hashed words of the classifier
MAX_LABELLED = 20_000          # labelled rows it learns from, by hash
MAX_DOMAINS = 64
EVIDENCE = 60.0                # words whose evidence counts in full; longer texts are averaged to it
ROUNDS, FOLDED = 100, 8
TOLERANCE = 1e-6               # of the targets, as a share of the totals at rate 1
GRADIENT = 1e-4                # mean step of a token's rate
MISSED = 1e-3                  # share of a target that is missed with a warning
NO_LIMIT = math.inf
MAX_RATE = 64.0                # bound for those who make copies: a domain may have 1/64 of its target


def words(text: str) -> Column:
    """Words of a text in lower case (null: none)."""
    parts = F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), "[\\x20\\x09-\\x0D]+")
    return F.filter(parts, lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def sample_ids(rows: DataFrame, key: str) -> DataFrame:
    """At most MAX_LABELLED ids, by their hash."""
    return (rows.where(F.col(key).isNotNull()).select(key).distinct()
            .orderBy(F.xxhash64(key), key).limit(MAX_LABELLED))


def fit_domains(labelled: DataFrame, text: str, domain: str, key: str) -> tuple[list[str], dict[str, list[float]], list[float]]:
    """Domains in order, log-probabilities of the buckets in each, log-priors; from at most
    MAX_LABELLED rows with a domain and an id, chosen by the id's hash."""
    known = labelled.where(F.col(domain).isNotNull())
    rows = known.select(F.col(key).alias("_id"), F.col(domain).cast("string").alias("d"), F.col(text).alias("t"))
    rows = written(rows.join(F.broadcast(sample_ids(known, key).withColumnRenamed(key, "_id")), "_id"), "labelled")
    rows = rows.select("d", words("t").alias("w"))
    counts = (rows.select("d", F.explode("w").alias("w")).groupBy("d", bucket(F.col("w")).alias("b"))
              .agg(F.count(F.lit(1)).alias("n")))
    priors = {r["d"]: r["n"] for r in rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).limit(MAX_DOMAINS + 1).collect()}
    if len(priors) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    domains = sorted(priors)
    seen = {d: [1.0] * BUCKETS for d in domains}
    for r in counts.collect():                                   # at most BUCKETS × domains rows
        seen[r["d"]][r["b"]] += r["n"]
    logs = {d: [math.log(x / sum(v)) for x in v] for d, v in seen.items()}
    # Relative to the mean over domains: words that say nothing add nothing.
    for b in range(BUCKETS):
        mean = sum(logs[d][b] for d in domains) / max(1, len(domains))
        for d in domains:
            logs[d][b] -= mean
    total = sum(priors.values())
    return domains, logs, [math.log(priors[d] / total) for d in domains]


def posteriors(docs: DataFrame, model, text: str, keep: list[str]) -> DataFrame:
    """``keep``, ``tokens`` (words) and ``p`` (array of one double a domain, summing to 1)."""
    domains, logs, priors = model
    rows = packed(docs.select(*keep)) if text in keep else packed(docs.select(*keep, text))
    rows = rows.select("row", words(f"row.`{text}`").alias("w"))
    rows = rows.select("row", "w", F.size("w").cast("long").alias("tokens"))
    out = [F.col("row")[c].alias(c) for c in keep]
    if not domains:
        return rows.select(*out, "tokens", F.array().cast("array<double>").alias("p"))
    # A word looks up the D numbers of its bucket in one literal.
    flat = F.lit([[logs[d][b] for d in domains] for b in range(BUCKETS)])
    add = lambda acc, w: F.zip_with(acc, F.element_at(flat, bucket(w) + 1), lambda x, y: x + y)
    rows = rows.select("row", "tokens", F.aggregate("w", F.array(*[F.lit(0.0)] * len(domains)), add).alias("l"))
    scale = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.col("tokens"), F.lit(1)))
    score = F.zip_with("l", F.array(*map(F.lit, priors)), lambda x, y: x * scale + y)
    rows = rows.select("row", "tokens", score.alias("s"))
    rows = rows.select("row", "tokens", F.transform("s", lambda x: F.exp(x - F.array_max("s"))).alias("e"))
    norm = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return rows.select(*out, "tokens", F.transform("e", lambda x: x / norm).alias("p"))


def fold_rates(p: Column, steps: list[list[float]], limit: float = NO_LIMIT, floor: float = 0.0,
               start: Column | None = None) -> Column:
    """``r, y, move`` after the rounds' steps from ``start`` (default: 1).  A step, D weighted residuals and
    the momentum, takes its product with ``p`` off ``y``; the result is brought between ``floor`` and ``limit``,
    ``move`` is how far that was from ``y``, and ``y`` runs ahead of the new ``r`` (accelerated projected
    gradient)."""
    one = F.lit(1.0)
    start = F.struct(one.alias("r"), one.alias("y"), F.lit(0.0).alias("move")) if start is None else start
    if not steps:
        return start
    d = len(steps[0]) - 1

    def step(at: Column, s: Column) -> Column:
        dot = F.aggregate(F.zip_with(p, F.slice(s, 1, d), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        r = F.greatest(F.lit(float(floor)), at["y"] - dot)
        r = r if limit == NO_LIMIT else F.least(r, F.lit(float(limit)))
        return F.struct(r.alias("r"), (r + F.element_at(s, -1) * (r - at["r"])).alias("y"), (r - at["y"]).alias("move"))

    return F.aggregate(F.lit(steps), start, step)


class State:
    """Tokens, posterior, ``r`` and ``y`` of the documents that have tokens.  A round folds the steps since
    the table was written, at most ``FOLDED``; then a new table replaces it."""

    def __init__(self, rows: DataFrame, n: int, limit: float, floor: float):
        self.n, self.limit, self.floor = n, limit, floor
        self.pending: list[list[float]] = []
        self.path = None
        self._write(rows.where("tokens > 0").select("tokens", "p", fold_rates(F.col("p"), []).alias("at")))
        self._observe()

    def _write(self, rows: DataFrame) -> None:
        spark, old, self.path = rows.sparkSession, self.path, shared_path(rows.sparkSession, "rates")
        rows.write.parquet(self.path)
        self.rows = spark.read.schema(rows.schema).parquet(self.path)
        if old is not None:
            delete(spark, old)                             # nothing reads it any more

    def _now(self) -> DataFrame:
        at = fold_rates(F.col("p"), self.pending, self.limit, self.floor, F.col("at"))
        return self.rows.select("tokens", "p", at.alias("at"))

    def _observe(self) -> None:
        """Expected domain totals at ``r`` and at ``y``, and the mean step of a token's rate."""
        sums = [F.coalesce(F.sum(F.col("tokens") * F.element_at("p", i + 1) * F.col("at")[v]), F.lit(0.0)) for v in "ry" for i in range(self.n)]
        moved = F.sum(F.col("tokens") * F.col("at.move") * F.col("at.move")) / F.sum("tokens")
        got = list(self._now().agg(*sums, F.coalesce(F.sqrt(moved), F.lit(0.0))).first())
        self.totals, self.ahead, self.moved = got[:self.n], got[self.n:-1], got[-1]

    def step(self, residuals: list[float], momentum: float) -> None:
        if len(self.pending) == FOLDED:
            self._write(self._now())
            self.pending = []
        self.pending.append([*residuals, momentum])
        self._observe()


def targets(base: list[float], domains: list[str], weights: dict[str, float], budget: str | float) -> list[float]:
    """Target totals of the domains, whose totals at rate 1 are ``base``."""
    w = [max(0.0, weights.get(d, 0.0)) for d in domains]
    w = [x / sum(w) for x in w] if sum(w) > 0 else [1.0 / max(1, len(w))] * len(w)
    if budget == "keep":
        size = max([b / x for b, x in zip(base, w) if x > 0 and b > 0], default=0.0)
    else:
        size = sum(base) if budget == "corpus" else float(budget)
    return [size * x for x in w]


def fit_rates(rows: DataFrame, domains: list[str], weights: dict[str, float], budget: str | float = "corpus",
              limit: float = NO_LIMIT, floor: float = 0.0):
    """Steps of the rounds, targets and reached totals.  ``budget`` is the total of the targets:
    "corpus" (the tokens there are), "keep" (so many that no domain must shrink) or a number.
    Weights are scaled to sum to 1 over the domains known; one without a weight gets 0.  Targets
    that no rates within the bounds can reach are approached."""
    n = len(domains)
    if not n:
        return [], {}, {}
    state = State(rows, n, limit, floor)
    base = state.totals
    target = targets(base, domains, weights, budget)
    off = lambda x: [(g - t) / b if b > 0 else 0.0 for g, t, b in zip(x, target, base)]
    loss = lambda x: sum(m * m * b for m, b in zip(off(x), base))
    steps: list[list[float]] = []
    speed = 1.0
    for _ in range(ROUNDS):
        if max(map(abs, off(state.totals))) < TOLERANCE:
            break
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        steps.append([*off(state.ahead), (speed - 1) / faster])
        before = loss(state.totals)
        state.step(steps[-1][:-1], steps[-1][-1])
        speed = 1.0 if loss(state.totals) > before else faster    # momentum that overshoots starts anew
        if state.moved < GRADIENT:
            break                                                # no rates in reach are nearer
    return steps, dict(zip(domains, target)), dict(zip(domains, state.totals))


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: str | float = "corpus",
        text: str = "text", key: str = "doc_id", domain: str = "domain", keep: list[str] | None = None,
        limit: float | None = None, floor: float = 0.0):
    """Rows of ``docs`` with ``keep`` (default: the key), ``tokens``, ``p`` and ``rate``; domains,
    targets and reached totals.  ``limit`` is the largest rate allowed (None: any); a target that is
    missed is logged as a warning.

    A null or empty text has no tokens, the prior as its posterior and the rate 1; repeated rows each
    have their rate; extra columns are left behind, and one of ``keep`` that is called tokens, p or
    rate is replaced; without labelled rows there is no domain and every rate is 1; an empty table
    gives no rows.  Very long texts are read whole."""
    keep = [c for c in (keep or [key]) if c not in ("tokens", "p", "rate")]
    model = fit_domains(labelled, text, domain, key)
    rows = written(posteriors(docs, model, text, keep), "posteriors")
    limit = NO_LIMIT if limit is None else float(limit)
    steps, target, got = fit_rates(rows, model[0], weights, budget, limit, floor)
    for d in model[0]:
        if abs(got[d] - target[d]) > MISSED * max(1.0, target[d]):
            logging.getLogger(__name__).warning("domain %s: target %.1f tokens, reached %.1f", d, target[d], got[d])
    rate = F.when(F.col("tokens") > 0, fold_rates(F.col("p"), steps, limit, floor)["r"]).otherwise(F.lit(1.0))
    return rows.withColumn("rate", rate), model[0], target, got


def repeat_by_rate(rows: DataFrame, rate: str = "rate", key: str = "doc_id", salt: str = "mixing") -> DataFrame:
    """Each row as often as its rate says: the whole part for sure, one more with the probability
    of the rest, drawn from a hash of the key (null keys share a draw)."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)
    n = F.floor(rate) + (u < F.col(rate) - F.floor(rate)).cast("long")
    times = F.when(n > 0, F.sequence(F.lit(1).cast("long"), n))
    at = fresh(rows, "time")
    return rows.withColumn(at, F.explode(times)).drop(at)
