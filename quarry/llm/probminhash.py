"""ProbMinHash signatures of weighted shingles, and their exact similarities.

Every shingle of a text is an exponential process: with rate equal to its weight, points arrive
and each falls on one of ``m`` registers, times and registers being a hash of the shingle.  A
register keeps the shingle that reached it first.  Points after the latest of these first arrivals
cannot matter, so a shingle stops as soon as its next point comes later.  Two texts agree in a
register with a probability equal to their probability Jaccard.

The processes of all texts of a batch run side by side in NumPy: round t is the t-th point of
every shingle that is still running."""

from __future__ import annotations

import numpy as np

WIDTH = 5                    # words of a shingle
BANDS, ROWS = 32, 6          # 0.8^6 in 32 bands: a pair at 0.8 is missed once in 17,000
REGISTERS = BANDS * ROWS
SIG_TYPE = np.dtype("<u2")   # 16 bits of a register's shingle: two texts agree by chance once in 65,536
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A word's hash is the finalised sum of its characters times odd numbers by their place.
_PLACES = mix(np.arange(1, 4097, dtype=np.uint64) * _STEP) | np.uint64(1)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the text's words (runs of anything but ASCII white space), in order."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    begins = ~blank
    begins[1:] &= blank[:-1]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.empty(0, np.uint64)
    place = np.arange(len(code)) - start[np.maximum(np.cumsum(begins) - 1, 0)]
    value = (code.astype(np.uint64) + np.uint64(1)) * _PLACES[place & 4095] + (place >> 12).astype(np.uint64)
    value[blank] = 0
    return mix(np.add.reduceat(value, start))


def shingles(text: str, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and counts of a text's shingles.  A text of fewer words than ``width`` has
    one shingle, all its words; one without words has none."""
    h = word_hashes(text)
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = max(1, len(h) - width + 1)
    acc = np.full(n, min(width, len(h)), np.uint64)
    for j in range(min(width, len(h))):
        acc = acc * _BASE + h[j:n + j]
    return np.unique(mix(acc), return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    """Sub-linear in the count: a phrase said ten times is not ten phrases."""
    return 1.0 + np.log(counts)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """``len(sets) × m`` registers, each the low bits of the shingle that came first (0 for a set
    without shingles)."""
    n = len(sets)
    first = np.full(n * m, np.inf)
    sig = np.zeros(n * m, SIG_TYPE)
    sizes = np.array([len(k) for k, _ in sets], np.int64)
    if not sizes.sum():
        return sig.reshape(n, m)
    key = np.concatenate([k for k, _ in sets])
    rate = np.concatenate([weights(c) for _, c in sets])
    doc = np.repeat(np.arange(n), sizes)
    now = np.zeros(len(key))
    t = 0
    while len(key):
        with np.errstate(over="ignore"):
            u = mix(key + np.uint64(2 * t + 1) * _STEP)
            slot = mix(key + np.uint64(2 * t + 2) * _STEP)
        now = now - np.log(((u >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / rate
        at = doc * m + (slot % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, at, now)
        won = first[at] == now
        sig[at[won]] = key[won].astype(SIG_TYPE)
        still = doc[np.flatnonzero(np.diff(doc, prepend=-1))]      # texts with running shingles, in order
        last = np.zeros(n)
        last[still] = first.reshape(n, m)[still].max(1)
        run = now < last[doc]
        key, rate, doc, now = key[run], rate[run], doc[run], now[run]
        t += 1
    return sig.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """``n × bands`` bucket numbers (int64), different in every band."""
    parts = sig.reshape(len(sig), bands, -1).astype(np.uint64)
    acc = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for j in range(parts.shape[2]):
        acc = mix(acc * _BASE + parts[:, :, j])
    return acc.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Exact Jaccard of the shingle sets, and exact probability Jaccard of their weights:
    the sum over common shingles i of 1 / sum over all j of max(x_j/x_i, y_j/y_i)."""
    (ka, ca), (kb, cb) = a, b
    common, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    jaccard = len(common) / (len(ka) + len(kb) - len(common))
    wa, wb = weights(ca), weights(cb)
    x, y = wa[ia], wb[ib]
    only_x, only_y = wa.sum() - x.sum(), wb.sum() - y.sum()
    # With common shingles in the order of x/y, max(x_j/x_i, y_j/y_i) is x_j/x_i from i on, y_j/y_i before.
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    xs = x[::-1].cumsum()[::-1] + only_x
    ys = y.cumsum() - y + only_y
    return jaccard, float((1.0 / (xs / x + ys / y)).sum())
