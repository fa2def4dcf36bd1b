"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of the hashed embeddings of its character 4-grams with edge marks
(a shorter word is its only gram), so unseen forms of a known stem are recognised.  Filters of several widths run over
the word vectors, each filter keeps its largest response in the text, and a logistic layer turns
the responses into a score.

Training reads every labelled row.  The network starts as one that the driver trained on a bounded
sample (``MAX_PER_CLASS`` a class).  Then come ``ROUNDS`` rounds: the labelled rows outside the
calibrating fifth are dealt to them by a hash of their id, each task of a round goes on from the network as it
is, over its own rows, and the tasks' changes are averaged by their rows.  The rows of the calibrating
fifth, all of them, then fix the score's scale and a threshold for each language, by aggregates.
Scoring is map-side over whole texts."""

from __future__ import annotations

import copy
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, give_back, map_arrow, slices, texts, written

BUCKETS, DIM, WIDTHS, FILTERS = 1 << 15, 8, (1, 2, 3), 16
GRAM = 4
PAD = max(WIDTHS) - 1                  # zero vectors after each text
MAX_PER_CLASS = 3000                   # labelled rows of each class from which the network starts
PARTS = 5                              # of the labelled rows; part 0 calibrates, the others train
ROUNDS = 2                             # over which the parts that train are dealt
LABELS_A_TASK, DOCS_A_TASK = 4000, 20_000
GRID = 1 << 14                         # scores that a threshold tells apart
MIN_PER_LANGUAGE = 20                  # toxic calibration rows below which a language keeps 0.5
EPOCHS, BATCH, RATE = 8, 64, 0.05
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CACHED_WORDS = 150_000
BLOCK = 1 << 15                        # words whose responses are held at once
FEATURED = 20_000                      # words of the sample whose grams are hashed at once
NUMBERS_A_PART = 1 << 12               # of a task's change, which is summed by parts
CHANGE = ["part", "n", "change"]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' character 4-grams, edges marked, one word after the other, and how
    many each word has (at least one)."""
    marked = [f"<{w.lower().strip(EDGES)}>".ljust(GRAM, "\0") for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(codes) - GRAM + 1
    acc = codes[:n]
    for j in range(1, GRAM):
        acc = acc * MULTIPLIER + codes[j:n + j]
    acc = (acc ^ (acc >> np.uint64(29))) * MULTIPLIER
    whole = np.ones(len(codes), bool)                      # grams that end within their word
    for j in range(1, GRAM):
        whole[np.cumsum(sizes) - j] = False
    return ((acc >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)[whole[:n]], sizes - GRAM + 1


@dataclass
class TextCnn:
    emb: np.ndarray                    # BUCKETS × DIM
    filters: list[np.ndarray]          # per width: width × DIM × FILTERS
    bias: np.ndarray                   # widths × FILTERS
    out: np.ndarray                    # widths·FILTERS
    out_bias: float = 0.0
    scale: float = 1.0                 # calibration of the logit
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def new(seed: int) -> TextCnn:
        r = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        return TextCnn(r.normal(0, 0.3, (BUCKETS, DIM)).astype("f4"),
                       [r.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS)).astype("f4") for w in WIDTHS],
                       np.zeros((len(WIDTHS), FILTERS), "f4"), r.normal(0, n**-0.5, n).astype("f4"))

    def taps(self) -> np.ndarray:
        """All filter positions side by side: DIM × (sum of widths · FILTERS)."""
        return np.concatenate([f[j] for f in self.filters for j in range(len(f))], axis=1)


class Vocabulary(dict):
    """Word → its number, from ``first`` on; ``new`` has the words not yet looked at."""

    def __init__(self, first: int = 0):
        super().__init__()
        self.first, self.new = first, []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = len(self) + self.first
        self[word] = n
        return n


def word_vectors(emb: np.ndarray, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(emb[flat], starts, axis=0) / np.sqrt(counts)[:, None].astype("f4")


def _tokens(text: str, vocab: Vocabulary) -> np.ndarray:
    """Row numbers of a text's words, then PAD times -1."""
    return np.array([*map(vocab.__getitem__, WORD.findall(text.lower())), *[-1] * PAD], np.int32)


def _vocabulary_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' grams and where each word's end, a few words at a time."""
    parts = [features(words[at:at + FEATURED]) for at in range(0, len(words), FEATURED)]
    flat = [f.astype(np.uint16) for f, _ in parts] or [np.empty(0, np.uint16)]
    ends = np.cumsum(np.concatenate([[0], *(sizes for _, sizes in parts)]))
    return np.concatenate(flat), ends.astype(np.int64)


def _winners(h: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each text and its first position, filter by filter."""
    top = np.maximum.reduceat(h, starts, axis=0)
    at, wins = np.arange(len(h), dtype=np.int32), np.empty(top.shape, np.int64)
    for f in range(h.shape[1]):
        pos = np.where(h[:, f] == np.repeat(top[:, f], size), at, np.int32(len(h)))
        wins[:, f] = np.minimum.reduceat(pos, starts)
    return top, wins


class Learner:
    """Adagrad on the log loss; gradients run through the winning positions alone."""

    def __init__(self, net: TextCnn, squares: dict[str, np.ndarray] | None = None):
        self.net, self.squares = net, squares or {name: np.full(x.shape, 1e-6, "f4") for name, x in weights(net).items()}

    def _step(self, name: str, x: np.ndarray, g: np.ndarray, rows=None) -> None:
        s = self.squares[name]
        if rows is None:
            s += g * g
            x -= RATE * g / np.sqrt(s)
        else:
            s[rows] += g * g
            x[rows] -= RATE * g / np.sqrt(s[rows])

    def learn(self, parts: list[np.ndarray], labels: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> None:
        """One step on texts as numbers of their words, whose grams are ``flat`` up to ``ends``."""
        net = self.net
        tok = np.concatenate(parts)
        size = np.array([len(p) for p in parts])
        starts = np.cumsum(size) - size
        words, inv = np.unique(tok, return_inverse=True)
        real = words >= 0
        counts = np.where(real, ends[words + 1] - ends[words], 0)[real]
        take = np.concatenate([flat[ends[w]:ends[w + 1]] for w in words[real]]) if real.any() else flat[:0]
        vec = np.zeros((len(words), DIM), "f4")
        if real.any():
            vec[real] = word_vectors(net.emb, take, np.cumsum(counts) - counts, counts)
        x = vec[inv]
        xp = np.concatenate([x, np.zeros((PAD, DIM), "f4")])
        tops, wins = [], []
        for k, f in enumerate(net.filters):
            top, win = _largest(xp, f, net.bias[k], starts, size)
            tops.append(top)
            wins.append(win)
        pooled = np.maximum(np.concatenate(tops, 1), 0)
        logit = pooled @ net.out + net.out_bias
        d = ((1 / (1 + np.exp(-logit)) - labels) / len(parts)).astype("f4")
        dpool = d[:, None] * net.out * (pooled > 0)
        gx = np.zeros_like(xp)
        grads = []
        for k, f in enumerate(net.filters):
            dp, pos = dpool[:, k * FILTERS:(k + 1) * FILTERS], wins[k]
            gf = np.empty_like(f)
            for j in range(len(f)):
                seen = xp[pos + j]                                    # text, filter, DIM
                gf[j] = np.einsum("bfd,bf->df", seen, dp)
                np.add.at(gx, (pos + j).ravel(), (dp[:, :, None] * f[j].T[None]).reshape(-1, DIM))
            grads.append((gf, dp.sum(0)))
        self._step("out", net.out, pooled.T @ d)
        net.out_bias -= RATE * float(d.sum())
        for k, (gf, gb) in enumerate(grads):
            self._step(f"f{k}", net.filters[k], gf)
            self._step(f"b{k}", net.bias[k], gb)
        if real.any():
            touched = np.flatnonzero(np.any(gx[:len(x)], axis=1))
            gw = np.zeros((len(words), DIM), "f4")
            np.add.at(gw, inv[touched], gx[touched])
            gw = gw[real] / np.sqrt(counts)[:, None].astype("f4")
            used = np.flatnonzero(np.any(gw, axis=1))
            if len(used):
                first = np.cumsum(counts) - counts
                feats = np.concatenate([take[first[u]:first[u] + counts[u]] for u in used])
                uniq, back = np.unique(feats, return_inverse=True)
                ge = np.zeros((len(uniq), DIM), "f4")
                np.add.at(ge, back, np.repeat(gw[used], counts[used], axis=0))
                self._step("emb", net.emb, ge, uniq)

    def state(self) -> np.ndarray:
        """Weights, bias of the output and squares as one row of numbers."""
        parts = [*weights(self.net).values(), np.array([self.net.out_bias]), *self.squares.values()]
        return np.concatenate([p.ravel().astype("f8") for p in parts])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for x in (*weights(self.net).values(), None, *self.squares.values()):
            if x is None:
                self.net.out_bias = float(state[at])
                at += 1
            else:
                x[...] = state[at:at + x.size].reshape(x.shape)
                at += x.size


def weights(net: TextCnn) -> dict[str, np.ndarray]:
    """The arrays that are trained, by name; changing them changes the network."""
    found = {"emb": net.emb, "out": net.out}
    for k, f in enumerate(net.filters):
        found |= {f"f{k}": f, f"b{k}": net.bias[k]}
    return found


def _largest(xp: np.ndarray, f: np.ndarray, bias: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_winners`` of one width over all texts, by blocks of words."""
    top, wins = np.full((len(size), FILTERS), -np.inf, "f4"), np.zeros((len(size), FILTERS), np.int64)
    n = len(xp) - PAD
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        h = xp[a:b] @ f[0]
        for j in range(1, len(f)):
            h += xp[a + j:b + j] @ f[j]
        own = slice(np.searchsorted(starts + size, a, "right"), np.searchsorted(starts, b))
        cut = np.maximum(starts[own], a) - a
        t, w = _winners(h + bias, cut, np.diff(cut, append=b - a))
        better = t > top[own]
        top[own], wins[own] = np.where(better, t, top[own]), np.where(better, w + a, wins[own])
    return top, wins


def constant(n: int, toxic: float) -> TextCnn:
    """Nothing to learn: the smoothed share of toxic rows for all texts."""
    net = TextCnn.new(0)
    net.out[:] = 0
    p = (toxic + 1) / (n + 2)
    net.out_bias = float(np.log(p / (1 - p)))
    return net


def start(docs: Iterable[str], labels: np.ndarray, seed: int = 7) -> Learner:
    """``EPOCHS`` passes over texts of both classes, which are read once and kept as numbers of their words."""
    learner, vocab = Learner(TextCnn.new(seed)), Vocabulary()
    parts = [_tokens(d, vocab) for d in docs]
    words = vocab.new
    vocab.clear()
    flat, ends = _vocabulary_features(words)
    del words, vocab
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(parts))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            learner.learn([parts[i] for i in pick], labels[pick], flat, ends)
    return learner


def train(docs: Iterable[str], labels: np.ndarray, seed: int = 7) -> TextCnn:
    """The network that the driver trains from the given texts alone."""
    if len(set(labels.tolist())) < 2:
        return constant(len(labels), float(np.sum(labels)))
    return start(docs, labels, seed).net


def train_round(rows: DataFrame, learner: Learner, seed: int = 7) -> int:
    """``learner`` goes on over all ``rows`` (``_text``, ``y``): every task over its own, in steps of ``BATCH``;
    the changes, each weighted by its rows, are summed and averaged.  Returns the rows read.  A change goes out in
    parts, and the tasks after a shuffle sum the parts of one place: no task holds more than its own change, no
    core two Python workers, and the driver gets one change, however many tasks there are."""
    model = rows.sparkSession.sparkContext.broadcast((learner.net, learner.squares))

    def run(batches):
        own = Learner(*copy.deepcopy(model.value))
        before, rng, n = own.state(), np.random.default_rng(seed), 0
        for b in slices(batches, "_text"):
            vocab = Vocabulary()
            parts = [_tokens(t, vocab) for t in texts(b.column("_text"))]
            flat, ends = _vocabulary_features(vocab.new)
            y = b.column("y").to_numpy(zero_copy_only=False).astype("f4")
            order = rng.permutation(len(parts))
            for at in range(0, len(order), BATCH):
                pick = order[at:at + BATCH]
                own.learn([parts[i] for i in pick], y[pick], flat, ends)
            n += len(parts)
        if n:
            change = (own.state() - before) * n
            parts = [change[at:at + NUMBERS_A_PART].tobytes() for at in range(0, len(change), NUMBERS_A_PART)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()),
                                              pa.array(parts, pa.binary())], CHANGE)

    def total(batches):
        found = {}
        for b in batches:
            for part, m, x in zip(*(c.to_pylist() for c in b.columns)):
                rows, numbers = found.get(part, (0, 0.0))
                found[part] = rows + m, numbers + np.frombuffer(x)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([m for m, _ in found.values()], pa.int64()),
                                              pa.array([x.tobytes() for _, x in found.values()], pa.binary())], CHANGE)

    kinds = "part int, n long, change binary"
    changes = map_arrow(rows.select("_text", "y"), run, kinds).repartition("part")
    sums = sorted(tuple(r) for r in map_arrow(changes, total, kinds).collect())
    if not sums:
        return 0
    n = sums[0][1]
    learner.restore(learner.state() + np.concatenate([np.frombuffer(x) for _, _, x in sums]) / n)
    return n


class Scorer(Vocabulary):
    """Scores texts; a bounded cache keeps each word's vector."""

    def __init__(self, net: TextCnn):
        super().__init__(first=1)
        self.net, self.mix = net, net.taps()
        self.vecs = np.zeros((1024, DIM), "f4")            # row 0 stays the zero vector

    def _fill(self) -> None:
        if self.new:
            n = len(self) + 1
            if n > len(self.vecs):
                self.vecs = np.concatenate([self.vecs, np.zeros((n, DIM), "f4")])
            flat, sizes = features(self.new)
            self.vecs[n - len(self.new):n] = word_vectors(self.net.emb, flat, np.cumsum(sizes) - sizes, sizes)
            self.new = []

    def pooled(self, words: list[str]) -> np.ndarray:
        """Largest response of each filter in one text, by blocks of words."""
        best = np.full((len(WIDTHS), FILTERS), -np.inf, "f4")
        for at in range(0, max(1, len(words)), BLOCK):
            part = words[at:at + BLOCK + PAD]              # filters see over the block's end
            if len(self) >= CACHED_WORDS:
                self.clear()
            ids = np.zeros(len(part) + PAD, np.int64)
            ids[:len(part)] = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            self._fill()
            got = self.vecs[ids] @ self.mix
            n = min(BLOCK, len(words) - at) + (PAD if at + BLOCK >= len(words) else 0)
            col = 0
            for k, w in enumerate(WIDTHS):
                h = got[:n, col:col + FILTERS]
                if w > 1:
                    h = h.copy()
                    for j in range(1, w):
                        nxt = got[j:n + j, col + j * FILTERS:col + (j + 1) * FILTERS]
                        h[:len(nxt)] += nxt
                col += w * FILTERS
                np.maximum(best[k], h.max(0), out=best[k])
        return best + self.net.bias

    def logit(self, text: str) -> float:
        top = np.maximum(self.pooled(WORD.findall(text.lower())), 0).ravel()
        return float(top @ self.net.out + self.net.out_bias)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.net.scale * self.logit(text) + self.net.shift, -50, 50))))


def calibrate(net: TextCnn, rows: DataFrame) -> None:
    """Fit scale and shift of the logit on all ``rows`` (``_text``, ``_lang``, ``y``), in their natural ratio, then
    for each language the threshold with the best F1, the nearest to one half of equals.  Thresholds lie
    midway between two scores that differ on a grid of ``GRID`` steps, so a language has a bounded number."""
    z = written(score(rows, net, text="_text", keep=("y", "_lang"), out="z", logits=True), "toxicity-logits")
    n, toxic, mean, std = z.agg(F.count("y"), F.sum("y"), F.avg("z"), F.stddev_pop("z")).first()
    if not n or not 0 < toxic < n:
        return
    std, a, b = max(std, 1e-6), 1.0, 0.0
    y = F.when(F.col("y") == 1, (toxic + 1) / (toxic + 2)).otherwise(1 / (n - toxic + 2))      # smoothed targets
    aims = z.select(((F.col("z") - mean) / std).alias("zs"), y.alias("t"))
    probability = lambda t: 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), t))))
    for _ in range(100):                                               # Newton on two numbers
        p, zs, r, w = map(F.col, ("p", "zs", "r", "w"))
        at = aims.select("zs", "t", probability(a * zs + b).alias("p")).select("zs", (p - F.col("t")).alias("r"), (p * (1 - p) + 1e-9).alias("w"))
        g0, g1, h00, h01, h11 = at.agg(F.sum(r * zs), F.sum(r), F.sum(w * zs * zs), F.sum(w * zs), F.sum(w)).first()
        move = np.linalg.solve(np.array([[h00 + 1e-6, h01], [h01, h11 + 1e-6]]), np.array([g0, g1]))
        move *= min(1, 2 / max(np.abs(move).max(), 1e-9))
        a, b = a - float(move[0]), b - float(move[1])
        if np.abs(move).max() < 1e-8:
            break
    if a <= 0:
        return
    net.scale, net.shift = a / std, b - a * mean / std
    s = z.where(F.col("_lang").isNotNull()).select("_lang", "y", probability(net.scale * F.col("z") + net.shift).alias("s"))
    net.thresholds = {r["_lang"]: r["best"]["cut"] for r in thresholds(s).collect()}


def thresholds(scored: DataFrame) -> DataFrame:
    """``_lang, best`` (with ``cut``) of the languages with enough toxic rows, from ``_lang, y, s``."""
    bins = (scored.groupBy("_lang", F.floor(F.col("s") * GRID).alias("bin"))
            .agg(F.count("y").alias("n"), F.sum("y").alias("t"), F.min("s").alias("low"), F.max("s").alias("high")))
    own = Window.partitionBy("_lang")
    above = own.orderBy(F.desc("bin"))
    half = F.sum(F.when(F.col("bin") >= GRID // 2, F.col("n")).otherwise(0)).over(own), F.sum(F.when(F.col("bin") >= GRID // 2, F.col("t")).otherwise(0)).over(own)
    rows = bins.select("_lang", F.sum("t").over(own).alias("toxic"), F.sum("n").over(above).alias("n"), F.sum("t").over(above).alias("t"),
                       ((F.col("low") + F.lag("high").over(own.orderBy("bin"))) / 2).alias("cut"), half[0].alias("n5"), half[1].alias("t5"))
    rows = rows.where(F.col("toxic") >= MIN_PER_LANGUAGE)

    def place(n, t, cut):
        f1 = 2 * F.col(t) / F.greatest(F.lit(1), F.col(n) + F.col("toxic"))
        return F.struct(f1.alias("f1"), (-F.abs(cut - 0.5)).alias("near"), cut.alias("cut"))

    at_half = place("n5", "t5", F.lit(0.5))
    return rows.select("_lang", F.greatest(at_half, F.when(F.col("cut").isNotNull(), place("n", "t", F.col("cut"))).otherwise(at_half)).alias("best")) \
               .groupBy("_lang").agg(F.max("best").alias("best"))


def labelled_ids(docs: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``key, y, h`` of every labelled id that has a document; repeated labels count once."""
    one = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
           .groupBy(key).agg(F.max(label).cast("int").alias("y")))
    return one.join(docs.select(key), key, "left_semi").withColumn("h", _hash(key))


def _hash(key: str):
    return F.xxhash64(F.col(key), F.lit("toxicity"))


def start_ids(ids: DataFrame, key: str) -> DataFrame:
    """A bounded sample by hash, at most MAX_PER_CLASS of each class, from which the network starts."""
    of = [ids.where(F.col("y") == y).orderBy("h", key).limit(MAX_PER_CLASS) for y in (0, 1)]
    return of[0].unionByName(of[1]).select(key, "y", F.lit("train").alias("use"))


def one_row_an_id(rows: DataFrame, key: str) -> DataFrame:
    """One row of each id, by its text's hash; reduced where the rows are, then merged."""
    order = F.struct(F.xxhash64("_text", "_lang"), F.col("_lang"))
    one = rows.groupBy(key, "y", "use").agg(F.min_by(F.struct("_text", "_lang"), order).alias("_one"))
    return one.select(key, "_one._text", "_one._lang", "y", "use")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang",
        label: str = "toxic") -> TextCnn:
    """Train and calibrate on all rows of ``labels`` that have a row in ``docs``.

    Rows whose label is null or neither 0 nor 1 teach nothing; a null text is an empty one; a
    class without rows, or no labels at all, gives every text the same score (the smoothed share
    of toxic rows); a language without enough toxic rows, or null, has the threshold 0.5."""
    src = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    ids = written(labelled_ids(src, labels.withColumnRenamed(key, "_key"), "_key", label), "toxicity-labels")
    teach = ids.where(F.pmod("h", F.lit(PARTS)) != 0)
    n, toxic = teach.agg(F.count("y"), F.sum("y")).first()
    if not n or not 0 < toxic < n:
        net, learner = constant(n, float(toxic or 0)), None
    else:
        # At most 2·MAX_PER_CLASS rows, which come one by one and stay as numbers of words.
        rows = src.join(F.broadcast(start_ids(teach, "_key")), "_key")
        rows = written(one_row_an_id(rows, "_key").orderBy("_key"), "toxicity-start")
        y = np.array([r["y"] for r in rows.orderBy("_key").select("y").collect()], np.float32)
        learner = start((r["_text"] or "" for r in rows.orderBy("_key").select("_text").toLocalIterator()), y)
        net = learner.net
        give_back()
    # Dealt by id over a number of tasks that follows from the tables alone, in the order of the ids.
    tasks = max(1, -(-ids.count() // LABELS_A_TASK), -(-src.count() // DOCS_A_TASK))

    def part(use) -> DataFrame:
        rows = src.where(use(F.pmod(_hash("_key"), F.lit(PARTS)))).repartition(tasks, "_key")
        rows = rows.join(ids.select("_key", "y", F.lit("").alias("use")).repartition(tasks, "_key"), "_key")
        return one_row_an_id(rows, "_key").sortWithinPartitions("_key")

    if learner:
        for i in range(ROUNDS):
            train_round(part(lambda p, i=i: (p != 0) & (p % ROUNDS == i)), learner)
        calibrate(net, part(lambda p: p == 0))
    return net


def score(docs: DataFrame, net: TextCnn, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          out: str = "score", logits: bool = False) -> DataFrame:
    """The columns ``keep`` and ``out`` (double, 0 to 1; it replaces a column of that name) per row,
    from the text alone; with ``logits`` what the network gives before it is calibrated.

    Null and empty texts get the score of no words; repeated rows get equal scores; a very long
    text is read in overlapping blocks, whole; an empty table gives no rows."""
    model = docs.sparkSession.sparkContext.broadcast(net)  # 1 MB, whatever the corpus
    keep = tuple(c for c in keep if c != out)
    src = docs.select(*keep) if text in keep else docs.select(*keep, text)

    def run(batches):
        scorer = Scorer(model.value)
        of = scorer.logit if logits else scorer.score
        for b in slices(batches, text):
            s = [of(t) for t in texts(b.column(text))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s, pa.float64())], [*keep, out])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(src, run, ", ".join([*fields, f"`{out}` double"]))


def threshold(net: TextCnn, lang: str = "lang"):
    """The threshold of a row's language as a column; 0.5 for others."""
    pairs = [F.lit(x) for kv in sorted(net.thresholds.items()) for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(lang)), F.lit(0.5)) if pairs else F.lit(0.5)
