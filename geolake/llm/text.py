"""Vectorised word hashing of Arrow text batches (numpy inside tasks).

Words are cut and hashed on the UTF-8 bytes of a whole column, so no Python
string is made per word.  A word's 64-bit hash is a random linear form of its
bytes, an n-gram's a random linear form of its words' hashes, both mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Texts of one vectorised step together have at most so many bytes (or are
#: one long text); it bounds the memory of a task.
CHUNK_BYTES = 1 << 20

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def odd_randoms(n: int, seed: int) -> np.ndarray:
    base = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    return mix(base) | U64(1)


def fold_table() -> np.ndarray:
    """Lower-cases A-Z, leaves every other byte."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def classes(spaces: bytes, marks: bool = False) -> np.ndarray:
    """0 for bytes that separate words, else the class whose runs are words;
    with ``marks``, runs of ASCII punctuation are words of their own."""
    t = np.ones(256, np.uint8)
    if marks:
        t[:128] = [1 if chr(b).isalnum() else 2 for b in range(128)]
    t[list(spaces)] = 0
    return t


#: Words are what ASCII white space separates.
PLAIN = classes(b" \t\n\v\f\r")
#: Words are runs of letters and digits (all of non-ASCII counts as letters);
#: punctuation runs count too.
MARKED = classes(bytes(range(33)) + b"\x7f", marks=True)


def text_chunks(column: pa.Array):
    """(first row, byte array, row bounds) of consecutive rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_BYTES, "right")) - 1)
        yield at, data[bounds[at]:bounds[end]], bounds[at:end + 1] - bounds[at]
        at = end


class WordHasher:
    """Hashes the words of a chunk: (hash, row, class) for each, in order."""

    def __init__(self, table: np.ndarray, fold: bool, seed: int = 1):
        self.table, self.fold, self.seed = table, fold_table() if fold else None, seed
        self.coef = odd_randoms(64, seed)

    def __call__(self, data: np.ndarray, bounds: np.ndarray, tally: np.ndarray | None = None):
        """With ``tally`` (an int64 per byte value), the third result is each
        word's sum of it instead of its class."""
        kind = self.table[data]
        solid = np.flatnonzero(kind)
        if not len(solid):
            return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        row_start = np.zeros(len(data) + 1, bool)
        row_start[bounds[:-1]] = True
        k = kind[solid]
        first = np.empty(len(solid), bool)
        first[0] = True
        first[1:] = (np.diff(solid) > 1) | (k[1:] != k[:-1]) | row_start[solid[1:]]
        head = np.flatnonzero(first)
        length = np.diff(np.append(head, len(solid)))
        place = np.arange(len(solid)) - np.repeat(head, length)
        if (most := int(length.max())) > len(self.coef):
            self.coef = odd_randoms(2 * most, self.seed)
        b = data[solid]
        if self.fold is not None:
            b = self.fold[b]
        h = np.add.reduceat((b.astype(U64) + U64(1)) * self.coef[place], head)
        starts = solid[head]
        rows = np.searchsorted(bounds, starts, "right") - 1
        third = k[head] if tally is None else np.add.reduceat(tally[b], head)
        return mix(h + length.astype(U64)), rows, third


def ngrams(h: np.ndarray, rows: np.ndarray, n: int, seed: int = 11):
    """Hashes of all runs of ``n`` words inside a row, and their rows."""
    if len(h) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    last = len(h) - n + 1
    coef = odd_randoms(n, seed)
    total = np.zeros(last, U64)
    for j in range(n):
        total += h[j:j + last] * coef[j]
    whole = rows[:last] == rows[n - 1:]
    return mix(total[whole]), rows[:last][whole]


def shingle_sets(column: pa.Array, k: int = 5):
    """For each row its set of ``k``-word shingles (sorted hashes); a text of
    fewer words is one shingle, a text without words the empty set."""
    hasher = WordHasher(PLAIN, fold=True)
    for _, data, bounds in text_chunks(column):
        h, rows, _ = hasher(data, bounds)
        n = len(bounds) - 1
        count = np.bincount(rows, minlength=n)
        grams, grow = ngrams(h, rows, k)
        cut = np.searchsorted(grow, np.arange(n + 1))
        word = np.concatenate([[0], np.cumsum(count)])
        for i in range(n):
            if count[i] >= k:
                yield np.unique(grams[cut[i]:cut[i + 1]])
            elif count[i]:
                own = h[word[i]:word[i + 1]]
                yield ngrams(own, np.zeros(len(own), np.int64), len(own), seed=100 + len(own))[0]
            else:
                yield np.zeros(0, U64)
