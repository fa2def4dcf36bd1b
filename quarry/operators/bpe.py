"""Byte-pair-encoding tokenizer as Spark jobs.

Training
    The corpus is reduced once to distinct pieces with counts (``pretoken_counts``); the pieces
    become words of byte ids, packed by a few thousand in a row, so that a task rewrites them with
    array operations.  A round is one job of one stage: every task merges the round's batch in its
    cached words, and only the words that hold one of its pairs give changes of pair counts, which
    are summed at the task and over the tasks.  The driver keeps the ``top_k`` first pairs of the
    ranking with exact counts and the merge list; both are bounded by parameters, the words never
    come there.

Candidates
    Pairs are ranked by (count desc, left, right).  Counts of old pairs only fall, and the full
    count of a new pair is known when it arises.  So the kept pairs stay the first of the ranking
    up to the place of the last one that was ever left out; when they run out, or fall behind
    that place, one job counts all pairs again and brings the first ``top_k``.

Exact rounds
    Two pairs touch if the left symbol of one is the right symbol of the other.  Merges of pairs that do
    not touch change neither's count and give the same words in either order.  A round walks down the
    ranking and merges every pair that touches none before it, merged or skipped; a pair (a, a) is
    merged only before the first skip and ends the round.

    Up to the first skip the merges are the next ones, in this order, and their ids are final.  For a
    pair (u, v) that a merge creates occurs at most as often as the pair (last symbol of u, first symbol
    of v) did, which touches the batch, was therefore skipped or stood behind it, and with equal counts
    (u, v) has larger ids.

    A pair r merged behind a skip is made ahead of its turn: it keeps its count and its place, and gets its
    id when it comes first.  No pair p that touches r can come before that turn.  If p was there when r
    was merged, it stood behind r, and its count only falls.  If p is new, it counts at most what
    the pair (last symbol, first symbol) did, which touches r too and stood behind r; with equal counts p
    has the larger left symbol.  (Occurrences of p that another pair s made ahead has taken count
    until the turn of s.  Of all such s and r that still wait, the first merged bounds p by this
    argument.)  So the words at r's turn are the same, and until then the counts of all
    pairs that can come first are exact.  Pairs of a symbol made ahead are not there before its turn,
    wait for its id, and count as skipped.

Encoding / decoding
    The merge ranks (bounded by the vocabulary size) are broadcast; an iterator Arrow UDF
    encodes each distinct piece of a batch (cached per task) with the lowest-rank-first rule.  No shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush, nsmallest
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import BOS_TOKEN, SPECIAL_TOKENS, SPLIT_PATTERN, VOCAB_SIZE
from quarry.operators.pretokenize import pieces_expr, pretoken_counts
from quarry.session import cut_lineage, drop_folder, ensure_checkpoint_dir

ID_SHIFT = 1 << 31          # pair key = left * ID_SHIFT + right; ids are ints, so keys are unique
CHECKPOINT_EVERY = 16       # rounds between two checkpoints that cut the lineage
TOP_K = 16_384              # candidate pairs of the driver
WORDS_A_TASK = 40_000       # distinct pieces, about, below which a task is not worth its start
LONGEST_BATCH = 2048
AHEAD = 1 << 40             # order of a symbol whose id is not final
PACK_SYMBOLS = 1 << 20      # of a pack that a task rewrites at once, about
CACHED_PIECES = 200_000
PACKED_WORDS = "ends binary, symbols binary, n binary"


# --------------------------------------------------------------------------- words

def bytes_of(piece: Column) -> Column:
    """UTF-8 bytes of a string as ARRAY<INT> (native: hex digits → integers)."""
    h = F.hex(F.encode(piece, "UTF-8"))
    n = F.octet_length(piece)
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.conv(F.substring(h, i * 2 + 1, 2), 16, 10).cast("int")))


def word_table(counts: DataFrame, piece: str = "piece", n: str = "n") -> DataFrame:
    """Words as byte-id arrays with their counts; one-symbol words can never merge.  The
    filter is on ``octet_length`` (cheap): Catalyst may push it below the piece aggregation."""
    return (counts.where(F.octet_length(piece) >= 2)
                  .select(bytes_of(F.col(piece)).alias("symbols"), F.col(n).cast("long").alias("n")))


def pair_counts(words: DataFrame) -> DataFrame:
    """Weighted counts of adjacent pairs ``left, right, n``."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("symbols") - 2),
                        lambda i: F.struct(F.get("symbols", i).alias("left"),
                                           F.get("symbols", i + 1).alias("right")))
    ex = words.select("n", F.explode(pairs).alias("p"))
    return ex.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")) \
             .agg(F.sum("n").alias("n"))


def select_batch(ranked: list[tuple[int, int, int]], complete: bool = True) -> list[tuple[int, int, int]]:
    """The exact batch (see module doc) from pairs ``(left, right, count)``: the whole ranking or a
    beginning of it (``complete`` false), which serves as well."""
    batch, lefts, rights = [], set(), set()
    for left, right, c in sorted(ranked, key=lambda p: (-p[2], p[0], p[1])):
        if left in rights or right in lefts:
            break
        batch.append((left, right, c))
        if left == right:
            break
        lefts.add(left)
        rights.add(right)
    return batch


# --------------------------------------------------------------------------- packed words

class Batch:
    """A round's merges: pair keys ascending with their new ids, and which symbols are left or right
    in one.  All symbols of the words are below ``first_new``."""

    def __init__(self, plan: list[tuple[int, int, int]]):
        order = sorted((left * ID_SHIFT + right, new) for left, right, new in plan)
        self.keys, self.new = (np.array(x, np.int64) for x in zip(*order))
        self.first_new = int(self.new.min())
        self.left, self.right = np.zeros(self.first_new, bool), np.zeros(self.first_new, bool)
        self.left[self.keys // ID_SHIFT] = True
        self.right[self.keys % ID_SHIFT] = True


class Words:
    """Words of a pack: ``symbols`` one word after the other, each word's end, and its count."""

    def __init__(self, ends: np.ndarray, symbols: np.ndarray, n: np.ndarray):
        self.ends, self.symbols, self.n = ends, symbols, n

    @staticmethod
    def of(row) -> Words:
        return Words(*(np.frombuffer(x, t) for x, t in zip(row, ("<i4", "<i4", "<i8"))))

    @staticmethod
    def joined(parts: list[Words]) -> Words:
        shift = np.cumsum([0, *(len(p.symbols) for p in parts[:-1])])
        return Words(np.concatenate([p.ends + s for p, s in zip(parts, shift)]),
                     np.concatenate([p.symbols for p in parts]), np.concatenate([p.n for p in parts]))

    def pack(self) -> tuple[bytes, bytes, bytes]:
        return (self.ends.astype("<i4").tobytes(), self.symbols.astype("<i4").tobytes(), self.n.astype("<i8").tobytes())

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Key of each two symbols side by side in a word, and the word's count."""
        word = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        inside = word[:-1] == word[1:]
        key = self.symbols[:-1].astype(np.int64) * ID_SHIFT + self.symbols[1:]
        return key[inside], self.n[word[:-1][inside]]

    def merge(self, batch: Batch) -> tuple[Words, np.ndarray, np.ndarray]:
        """The words after the batch, those of one symbol left out, and the changed pairs: keys and by
        how much their counts rise, one entry a place."""
        none = np.empty(0, np.int64)
        hit = np.flatnonzero(batch.left[self.symbols[:-1]] & batch.right[self.symbols[1:]])
        key = self.symbols[hit].astype(np.int64) * ID_SHIFT + self.symbols[hit + 1]
        at = np.minimum(np.searchsorted(batch.keys, key), len(batch.keys) - 1)
        word = np.searchsorted(self.ends, hit, side="right")
        real = (batch.keys[at] == key) & (hit + 1 < self.ends[word])
        hit, at, word = hit[real], at[real], word[real]
        if not len(hit):
            return self, none, none
        # Hits side by side are a run of one symbol: every other one merges, from the left.
        first = np.concatenate([[True], np.diff(hit) > 1])
        order = np.arange(len(hit))
        merged = (order - np.maximum.accumulate(np.where(first, order, 0))) % 2 == 0
        hit, at, word = hit[merged], at[merged], word[merged]
        changed = np.zeros(len(self.ends), bool)
        changed[word] = True
        old_sizes = np.diff(self.ends, prepend=0)
        symbols, keep = self.symbols.copy(), np.ones(len(self.symbols), bool)
        symbols[hit] = batch.new[at]
        keep[hit + 1] = False
        sizes = old_sizes - np.bincount(word, minlength=len(self.ends))
        touched = np.repeat(changed, old_sizes)
        before = Words(np.cumsum(old_sizes[changed]), self.symbols[touched], self.n[changed]).pairs()
        now = Words(np.cumsum(sizes[changed]), symbols[touched & keep], self.n[changed]).pairs()
        after = Words(np.cumsum(sizes), symbols[keep], self.n)
        long_enough = sizes > 1
        if not long_enough.all():
            after = Words(np.cumsum(sizes[long_enough]), after.symbols[np.repeat(long_enough, sizes)], self.n[long_enough])
        return after, np.concatenate([before[0], now[0]]), np.concatenate([-before[1], now[1]])


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their numbers, without zeros."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.add.reduceat(n, first)
    return keys[first][total != 0], total[total != 0]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``_sums`` of several lists of keys and numbers."""
    none = np.empty(0, np.int64)
    return _sums(np.concatenate([none, *(k for k, _ in parts)]), np.concatenate([none, *(n for _, n in parts)]))


def _unpacked(keys: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(keys, "<i8"), np.frombuffer(n, "<i8")


def _in(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def pack_words(counts: DataFrame, piece: str = "piece", n: str = "n") -> DataFrame:
    """Packed rows of the pieces of two bytes or more."""
    def run(batches):
        for b in batches:
            raw = b.column("piece").to_pylist()
            if raw:
                words = Words(np.cumsum([len(r) for r in raw]), np.frombuffer(b"".join(raw), np.uint8), b.column("n").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in words.pack()], ["ends", "symbols", "n"])

    rows = counts.where(F.octet_length(piece) >= 2).select(F.encode(F.col(piece), "UTF-8").alias("piece"), F.col(n).cast("long").alias("n"))
    return rows.mapInArrow(run, PACKED_WORDS)


def larger_packs(rows: DataFrame, tasks: int) -> RDD:
    """The packed rows as an RDD of packs of about ``PACK_SYMBOLS`` symbols, with empty changes."""
    def run(it):
        held, size = [], 0
        for row in it:
            held.append(Words.of(row))
            size += len(held[-1].symbols)
            if size >= PACK_SYMBOLS:
                yield Words.joined(held).pack(), b"", b""
                held, size = [], 0
        if held:
            yield Words.joined(held).pack(), b"", b""
    return rows.coalesce(tasks).rdd.mapPartitions(run)


def first_pairs(words: RDD, n: int, ids: np.ndarray) -> list[tuple[int, int]]:
    """The ``n`` first pairs of the ranking, as key and count, ``ids`` being the symbols' ids: a task sums
    its own pairs, a shuffle by key sums those of all tasks, and each of its tasks gives its first ``n``."""
    def first(keys, counts):
        return np.lexsort((ids[keys % ID_SHIFT], ids[keys // ID_SHIFT], -counts))[:n]

    parts = words.getNumPartitions()

    def local(it):
        own = _summed([_sums(*Words.of(w).pairs()) for w, _, _ in it])
        to = own[0] * 0x9E3779B1 % 0x7FFFFFFF % parts
        for p in range(parts):
            mine = to == p
            if mine.any():
                yield p, (own[0][mine].tobytes(), own[1][mine].tobytes())

    def total(it):
        keys, counts = _summed([_unpacked(*v) for _, v in it])
        top = first(keys, counts)
        yield keys[top], counts[top]

    found = words.mapPartitions(local).partitionBy(parts, int).mapPartitions(total).collect()
    keys, counts = (np.concatenate([np.empty(0, np.int64), *(f[i] for f in found)]) for i in (0, 1))
    top = first(keys, counts)
    return list(zip(keys[top].tolist(), counts[top].tolist()))


def merge_round(words: RDD, plan: list[tuple[int, int, int]], candidates: np.ndarray) -> RDD:
    """Packs after the batch ``plan`` of (left, right, new id), each with the changes of the counts of
    new pairs and of ``candidates`` (keys, ascending)."""
    batch = Batch(plan)

    def run(it):
        for w, _, _ in it:
            after, keys, rises = Words.of(w).merge(batch)
            if len(keys):
                wanted = (keys >= batch.first_new * ID_SHIFT) | (keys % ID_SHIFT >= batch.first_new)
                old = np.flatnonzero(~wanted)
                wanted[old] = _in(candidates, keys[old])
                keys, rises = _sums(keys[wanted], rises[wanted])
            if len(after.ends):
                yield after.pack(), keys.tobytes(), rises.tobytes()
            elif len(keys):
                yield (b"", b"", b""), keys.tobytes(), rises.tobytes()
    return words.mapPartitions(run)


def round_changes(step: RDD) -> tuple[np.ndarray, np.ndarray]:
    """The changes of a round's packs summed: a task's at the task, then the tasks' sums here (new pairs of
    a batch and candidates alone, at most two for each of its symbols and each of the vocabulary's)."""
    def run(it):
        keys, rises = _summed([_unpacked(k, r) for _, k, r in it])
        yield keys.tobytes(), rises.tobytes()
    return _summed([_unpacked(*x) for x in step.mapPartitions(run).collect()])


class Ranking:
    """The first pairs of the ranking with their counts, exact up to ``last``: the place
    (-count, left, right) behind which pairs may be missing (None: none is); and the merges made ahead.

    Symbols have numbers in the order in which words get them; ``ids`` has a symbol's id, or for one
    made ahead, until it is final, its number above ``AHEAD``, behind all ids."""

    def __init__(self, top_k: int):
        self.top_k, self.last = max(1, top_k), None
        self.keys = self.counts = np.empty(0, np.int64)        # keys ascending
        self.ids = np.arange(256, dtype=np.int64)
        self.ahead: dict[int, tuple[int, int, int]] = {}       # symbol: place of the pair it was made of

    def _place(self, key: int, count: int) -> tuple[int, int, int]:
        return -count, int(self.ids[key // ID_SHIFT]), int(self.ids[key % ID_SHIFT])

    def _first(self, n: int) -> np.ndarray:
        return np.lexsort((self.ids[self.keys % ID_SHIFT], self.ids[self.keys // ID_SHIFT], -self.counts))[:n]

    def _end(self, kept: list[tuple[int, int, int]]) -> tuple[int, int, int]:
        """The last of the kept places whose ids are final, and so keep their order."""
        return max((p for p in kept if max(p[1:]) < AHEAD), default=(kept[0][0] - 1, 0, 0))

    def refill(self, words: RDD) -> None:
        """The first ``top_k`` of all pairs."""
        rows = first_pairs(words, self.top_k + 1, self.ids)
        kept = rows[:self.top_k]
        self.last = self._end([self._place(*p) for p in kept]) if len(rows) > len(kept) else None
        kept = sorted(kept)
        self.keys, self.counts = (np.array([p[i] for p in kept], np.int64) for i in (0, 1))

    def update(self, keys: np.ndarray, rises: np.ndarray, first_new: int) -> None:
        """Counts after a round; a new pair with a count smaller than that of ``last`` is behind it."""
        least = 1 if self.last is None else -self.last[0]
        wanted = ((keys < first_new * ID_SHIFT) & (keys % ID_SHIFT < first_new)) | (rises >= least)
        keys, counts = _summed([(self.keys, self.counts), (keys[wanted], rises[wanted])])
        self.keys, self.counts = keys[counts > 0], counts[counts > 0]
        if len(self.keys) > 2 * self.top_k:
            top = self._first(self.top_k)
            end = self._end([self._place(*p) for p in zip(self.keys[top].tolist(), self.counts[top].tolist())])
            self.last = end if self.last is None else min(self.last, end)
            top = np.sort(top)
            self.keys, self.counts = self.keys[top], self.counts[top]

    def walk(self, n: int, left_over: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """A round (see module doc) over at most ``n`` first pairs: the next merges, final, as ids, at most
        ``left_over`` of them; and the round's merges in the words as ``left, right, new`` symbols."""
        top = self._first(n)
        entries = [(place, (), None) for place in self.ahead.values()]
        symbol_of = {place: symbol for symbol, place in self.ahead.items()}
        for key, c in zip(self.keys[top].tolist(), self.counts[top].tolist()):
            place, (left, right) = self._place(key, c), divmod(key, ID_SHIFT)
            # a pair of a symbol made ahead is not there before that symbol's own turn
            turn = max((self.ahead[x] for x in (left, right) if x in self.ahead), default=place)
            entries.append((max(turn, place), place if turn > place else (), (left, right)))
        entries = sorted((e for e in entries if self.last is None or e[0] <= self.last), key=lambda e: e[:2])
        final, plan, lefts, rights, skipped, taken = [], [], set(), set(), False, 0
        n_ids, ids, ahead = int((self.ids < AHEAD).sum()), [], dict(self.ahead)
        for place, _, pair in entries[:n]:
            if taken >= left_over:
                break
            if pair is None:
                symbol = symbol_of[place]
            else:
                left, right = pair
                if (left in self.ahead or right in self.ahead or place[1] in rights or place[2] in lefts
                        or left == right and skipped):
                    skipped = True
                    lefts.add(int(self.ids[left]))
                    rights.add(int(self.ids[right]))
                    continue
                symbol = len(self.ids) + len(plan)
                plan.append((left, right, symbol))
                ids.append(AHEAD + symbol)
                ahead[symbol] = place
            taken += 1
            lefts.add(place[1])
            rights.add(place[2])
            if not skipped:
                final.append((symbol, place[1:]))
                del ahead[symbol]
                if place[1] == place[2]:
                    break
        self.ids, self.ahead = np.concatenate([self.ids, np.array(ids, np.int64)]), ahead
        for i, (symbol, _) in enumerate(final):
            self.ids[symbol] = n_ids + i
        return [pair for _, pair in final], plan


# --------------------------------------------------------------------------- tokenizer

@dataclass
class Tokenizer:
    """Merges (rank order) and the derived vocabulary; size bounded by ``vocab_size``."""
    merges: list[tuple[int, int]] = field(default_factory=list)
    specials: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS))
    pattern: str = SPLIT_PATTERN

    def token_bytes(self) -> list[bytes]:
        out = [bytes([b]) for b in range(256)]
        for left, right in self.merges:
            out.append(out[left] + out[right])
        return out

    @property
    def n_ranks(self) -> int:
        return 256 + len(self.merges)

    @property
    def vocab_size(self) -> int:
        return self.n_ranks + len(self.specials)

    def special_id(self, name: str) -> int:
        return self.n_ranks + self.specials.index(name)

    @property
    def bos_id(self) -> int:
        return self.special_id(BOS_TOKEN)

    def ranks(self) -> dict[bytes, int]:
        return {b: i for i, b in enumerate(self.token_bytes())}


def _word_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def train_bpe(spark: SparkSession, texts: DataFrame, vocab_size: int = VOCAB_SIZE,
              text: str = "text", top_k: int = TOP_K, pattern: str = SPLIT_PATTERN,
              counts: DataFrame | None = None, log=None, incremental: bool = True) -> Tokenizer:
    """H2: learn ``vocab_size - len(specials) - 256`` merges from ``texts`` (or from their piece
    ``counts``), fewer if no pair is left.

    A round is one job of one stage over the packs, which stay cached from round to round; every
    ``CHECKPOINT_EVERY`` rounds a checkpoint cuts the lineage, so that lost executors cost
    a few rounds.  Without ``incremental`` every round counts all pairs again."""
    tok = Tokenizer(pattern=pattern)
    n_merges = vocab_size - len(tok.specials) - 256
    if counts is None:
        counts = pretoken_counts(texts, text, pattern)
    rows = cut_lineage(pack_words(counts.repartition(_word_partitions(spark))), "bpe-words")
    n_words = rows.agg(F.sum(F.length("n") / 8)).first()[0] or 0
    if not n_words and counts.limit(1).count() == 0:
        raise ValueError("no text to learn merges from")
    ensure_checkpoint_dir(spark)
    tasks = max(1, min(int(n_words / WORDS_A_TASK), spark.sparkContext.defaultParallelism))
    words, old = larger_packs(rows, tasks).persist(StorageLevel.MEMORY_AND_DISK), None
    ranking, rounds = Ranking(top_k), 0
    ranking.refill(words)
    while len(tok.merges) < n_merges:
        first_new = len(ranking.ids)
        batch, plan = ranking.walk(LONGEST_BATCH, n_merges - len(tok.merges))
        while not batch and not plan and ranking.last is not None:
            ranking.refill(words)
            batch, plan = ranking.walk(LONGEST_BATCH, n_merges - len(tok.merges))
            ranking.top_k *= 1 if batch or plan else 2
        if not batch and not plan:
            break
        tok.merges += batch
        if not plan:
            continue
        step = merge_round(words, plan, ranking.keys).persist(StorageLevel.MEMORY_AND_DISK)
        rounds += 1
        if rounds % CHECKPOINT_EVERY == 0:
            step.checkpoint()
        ranking.update(*round_changes(step), first_new)
        words.unpersist()
        words = step
        if rounds % CHECKPOINT_EVERY == 0:
            drop_folder(spark, old)
            old = step.getCheckpointFile()
        if not incremental:
            ranking.refill(words)
        if log:
            log(rounds, len(tok.merges), batch)
    words.unpersist()
    drop_folder(spark, old)
    return tok


def merges_frame(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    """M7: ``rank, left, right, new_id``."""
    rows = [(i, l, r, 256 + i) for i, (l, r) in enumerate(tok.merges)]
    return spark.createDataFrame(rows, "rank INT, left INT, right INT, new_id INT")


def decoded_len(b: bytes) -> int:
    """H4: bytes of the token decoded with replacement (a lone byte ≥ 0x80 counts 3)."""
    return len(b.decode("utf-8", errors="replace").encode("utf-8"))


def vocab_frame(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    """H3 + H4 (M6): ranks then specials; ``n_bytes`` is 0 for specials."""
    rows = [(i, b, decoded_len(b), len(b), False) for i, b in enumerate(tok.token_bytes())]
    rows += [(tok.special_id(s), s.encode(), 0, len(s.encode()), True) for s in tok.specials]
    return spark.createDataFrame(
        rows, "token_id INT, token BINARY, n_bytes INT, n_bytes_raw INT, is_special BOOLEAN")


def tokenizer_from_frames(merges: DataFrame) -> Tokenizer:
    """Rebuild from a saved merge table (bounded by the vocabulary size)."""
    rows = sorted((r["rank"], r["left"], r["right"]) for r in merges.collect())
    return Tokenizer(merges=[(l, r) for _, l, r in rows])


# --------------------------------------------------------------------------- encode / decode

def encode_piece(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Lowest-rank pair first, leftmost on a tie, until no pair is a token.

    Parts are kept as their ends; a heap holds the pairs that are tokens by (rank, start).  An
    entry is stale once its parts have changed; the work is n log n for n bytes."""
    n = len(data)
    if data in ranks:
        return [ranks[data]]
    end = list(range(1, n + 1))           # of the part that starts here, 0 once it was merged away
    before = list(range(-1, n - 1))       # where the part to the left starts
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            r = ranks.get(data[i:end[stop]])
            if r is not None:
                heappush(heap, (r, i, end[stop]))
        left = before[i]
        if left >= 0:
            r = ranks.get(data[left:stop])
            if r is not None:
                heappush(heap, (r, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i:end[i]]])
        i = end[i]
    return out


def _encoder(bc, prepend: int | None):
    """Ids of each row's pieces: a batch's distinct pieces are encoded once, and rows put together by arrays."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = bc.value
        cache: dict[str, list[int]] = {}
        for rows in batches:
            null = rows.is_null().to_numpy(zero_copy_only=False)
            in_row = np.where(null, 0, rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            pieces = rows.flatten().dictionary_encode()
            found = []
            for p in pieces.dictionary.to_pylist():
                got = cache.get(p)
                if got is None:
                    got = encode_piece(p.encode("utf-8"), ranks)
                    if len(cache) >= CACHED_PIECES:
                        cache.clear()
                    cache[p] = got
                found.append(got)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            code = pieces.indices.to_numpy()
            n = sizes[code]
            ends = np.cumsum(n)
            # The place in ``ids`` of each id of the rows: a piece's ids are a run.
            place = np.repeat((np.cumsum(sizes) - sizes)[code] - (ends - n), n) + np.arange(int(n.sum()))
            values, ends = ids[place], np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(in_row)])]
            if prepend is not None:
                values = np.insert(values, ends[:-1][~null], prepend)
                ends = ends + np.concatenate([[0], np.cumsum(~null)])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()), mask=pa.array(null))
    return run


def encode(df: DataFrame, tok: Tokenizer, text: str = "text", out: str = "ids",
           prepend_bos: bool = False) -> DataFrame:
    """H5 (+ H6): token ids of ``text``; special-token strings in the text are plain text.
    Splitting is native (``regexp_extract_all``), merging runs in an Arrow-batched UDF."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(tok.ranks())
    udf = F.arrow_udf(_encoder(bc, tok.bos_id if prepend_bos else None), T.ArrayType(T.IntegerType()))
    return df.withColumn(out, udf(pieces_expr(text, tok.pattern)))


def _decoder(bc):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = bc.value
        for ids in batches:
            yield pd.Series([None if a is None else
                             b"".join(table[i] for i in a).decode("utf-8", errors="replace") for a in ids])
    return run


def decode(df: DataFrame, tok: Tokenizer, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """H7: ids → text, invalid UTF-8 replaced by U+FFFD."""
    spark = df.sparkSession
    table = tok.token_bytes() + [s.encode() for s in tok.specials]
    bc = spark.sparkContext.broadcast(table)
    return df.withColumn(out, F.pandas_udf(_decoder(bc), T.StringType())(F.col(ids)))


def roundtrip_check(df: DataFrame, tok: Tokenizer, text: str = "text") -> DataFrame:
    """H8: ``decode(encode(x)) == x`` per row."""
    enc = encode(df, tok, text)
    dec = decode(enc, tok)
    return dec.withColumn("roundtrip_ok", F.col("decoded") == F.col(text)).drop("ids", "decoded")
