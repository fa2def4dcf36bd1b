"""Fill-in-middle transformation: texts cut into prefix, middle and suffix and put in another order.

A text is read as UTF-8 in fixed blocks of bytes.  A Fenwick tree over the blocks stores, for each,
how many units and how many code points start in it; binary-lifting descent finds the block of a
cut, and the boundary is located among that block's unit starts alone.  A unit is a run of ASCII
letters or any other single code point, so units tile the text.

The cuts and the form come from the SHA-256 of ``<seed>:<key>``: four 32-bit numbers h1 to h4.
The prefix ends after the smaller of h1 mod (n+1) and h2 mod (n+1) units, the middle after the
larger.  A text is left plain if it is empty or holds a sentinel, or for the share ``1 - fim_rate``
(by h3); else ``spm_rate`` of them (by h4) put the suffix first."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices

BLOCK = 1024                 # bytes of a block
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


@dataclass(frozen=True)
class Sentinels:
    """Marks in front of the three parts.  None begins another, and none holds a mark's first
    character but at its own start, so no mark can arise where a part and a mark meet."""
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        heads = {m[:1] for m in marks}
        opens = any(i != j and marks[j].startswith(marks[i]) for i in range(3) for j in range(3))
        if "" in heads or opens or any(h in m[1:] for h in heads for m in marks):
            raise ValueError("no sentinel may begin another, and the first character of one may stand nowhere else in any")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Fenwick:
    """Prefix sums over blocks, of units (column 0) and code points (column 1)."""

    def __init__(self, counts: np.ndarray):
        self.n = len(counts)
        # A node sums the 2^k blocks that end at it, 2^k being its lowest set bit.
        sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0, dtype=np.int64)])
        at = np.arange(self.n + 1)
        self.tree = sums - sums[at - (at & -at)]
        self.top = 1 << max(0, self.n.bit_length() - 1)

    def descend(self, units: int) -> tuple[int, int, int]:
        """The block in which the unit of that number (from 0) starts, or the number of blocks if
        there is no such unit, and the units and code points before that block."""
        at, code_points, left, step = 0, 0, units, self.top
        while step:
            nxt = at + step
            if nxt <= self.n and self.tree[nxt, 0] <= left:
                at = nxt
                left -= int(self.tree[nxt, 0])
                code_points += int(self.tree[nxt, 1])
            step >>= 1
        return at, units - left, code_points


class Units:
    """Where the units of a text start, in blocks under a Fenwick tree."""

    def __init__(self, raw: bytes):
        b = np.frombuffer(raw, np.uint8)
        self.size = len(b)
        self.points = (b & 0xC0) != 0x80
        letter = LETTER[b]
        self.starts = self.points.copy()
        self.starts[1:] &= ~(letter[1:] & letter[:-1])
        edges = np.arange(0, self.size, BLOCK)
        counts = np.zeros((len(edges), 2), np.int64)
        if self.size:
            counts[:, 0] = np.add.reduceat(self.starts, edges, dtype=np.int64)
            counts[:, 1] = np.add.reduceat(self.points, edges, dtype=np.int64)
        self.tree, self.n = Fenwick(counts), int(counts[:, 0].sum())

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points before the end of the first ``units`` units."""
        block, before, points = self.tree.descend(units)
        lo = block * BLOCK
        if lo >= self.size:
            return self.size, points
        at = lo + int(np.flatnonzero(self.starts[lo:lo + BLOCK])[units - before])
        return at, points + int(np.count_nonzero(self.points[lo:at]))


def draws(seed: int, key) -> tuple[int, int, int, int]:
    """h1 to h4; a null key is the empty string."""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(h[i:i + 8], 16) for i in (0, 8, 16, 24))


def arrange(raw: bytes, h: tuple[int, int, int, int], plain_from: int, spm_below: int, marks: tuple[bytes, bytes, bytes]):
    """Units, form, code points of prefix and middle (None if plain), and the output."""
    u = Units(raw)
    if not raw or any(m in raw for m in marks) or h[2] % 100 >= plain_from:
        return u.n, "plain", None, None, raw
    first, last = sorted((h[0] % (u.n + 1), h[1] % (u.n + 1)))
    (a, chars_a), (b, chars_b) = u.cut(first), u.cut(last)
    p, s, m = marks
    if h[3] % 100 < spm_below:
        form, out = "spm", b"".join((s, raw[b:], p, raw[:a], m, raw[a:b]))
    else:
        form, out = "psm", b"".join((p, raw[:a], s, raw[b:], m, raw[a:b]))
    return u.n, form, chars_a, chars_b - chars_a, out


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 1, fim_rate: int = 90,
              spm_rate: int = 20, marks: Sentinels = Sentinels()) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output`` per row; the rates are percentages.

    A null text is an empty one and stays plain; repeated rows come out alike, each in its place;
    a null key draws from the empty string; a very long text is cut whole; other columns are left
    behind, so none can clash; an empty table gives no rows."""
    kind = docs.schema[key].dataType.simpleString()
    coded = tuple(m.encode() for m in marks.all)

    def run(batches):
        for b in slices(batches, "_text"):
            rows = [arrange(t or b"", draws(seed, k), fim_rate, spm_rate, coded)
                    for k, t in zip(b.column("_key").to_pylist(), b.column("_text").to_pylist())]
            n, form, first, mid, out = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("_key"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()),
                 pa.array(mid, pa.int64()), pa.array(out, pa.binary()).cast(pa.string(), safe=False)],
                [key, "n", "form", "prefix_chars", "middle_chars", "output"])

    src = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    return map_arrow(src, run, f"`{key}` {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(output: Column, form: Column, marks: Sentinels = Sentinels()) -> Column:
    """The text that ``output`` was made of, from its form alone."""
    at = lambda m: F.locate(m, output)
    part = lambda m, end: F.substring(output, at(m) + len(m), end - at(m) - F.lit(len(m)))
    rest = lambda m: F.substring(output, at(m) + len(m), F.length(output))
    p, s, m = marks.all
    psm = F.concat(part(p, at(s)), rest(m), part(s, at(m)))
    spm = F.concat(part(p, at(m)), rest(m), part(s, at(p)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
