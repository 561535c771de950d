"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and length at least max(MIN_LENGTH, 2 q) that no neighbouring
word extends.  At each dyadic scale B = 2, 4, 8, ... the text's words are cut
into blocks of B words; a block's distances q of the scale are 1 .. 6 for
B = 2 and 2B-1 .. 4B-2 above, so every run holds a whole block whose copy q
words later lies in the run too.  For each block the sum of squared differences
to every place of its window is one cyclic convolution over residues modulo a
prime (a number theoretic transform: integers, no rounding); a sum of zero
marks an occurrence.  Its distance seeds an extension, which compares the words
themselves, so a residue shared by chance costs a comparison and no result.

Blocks cannot match, and are not transformed, when one of their words has no
like word at any distance of the scale, or when they lie in a known run whose
period is at most B (all their matches there are multiples of that period).
A stretch found at q that an earlier, smaller period already gave is no new
run: a stretch of length 2 q and periods q' < q has gcd(q', q) as a period.

Words are compared by 64-bit hashes of their bytes (two unlike words of one
text need a 64-bit collision to be taken for alike).  A task holds about
CHUNK_BYTES of texts, or one longer text.

Defined cases: null, empty or blank texts have no words, no runs and an empty
collapsed text.  Words are what ASCII white space separates, case kept.  Rows
are independent: repeated ids, null ids and other columns pass through as they
are (each output row holds the caller's columns in a struct until the end, so
equal names cannot clash).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import PLAIN, U64, WordHasher, mix, text_chunks

MIN_LENGTH = 12
#: 15 * 2^27 + 1 and a generator of its multiplicative group: products of two
#: residues fit 64 bits, transforms go up to 2^27 places.
PRIME, GENERATOR = 2013265921, 31
#: Places of one transformed slab.
SLAB = 1 << 19
#: Words compared on either side of a seed before it is extended alone.
NEAR = 12

_P = U64(PRIME)


# ------------------------------------------------------------ transform
def _power(x: int, count: int) -> np.ndarray:
    """x^0 .. x^(count-1) modulo PRIME, by doubling."""
    out = np.ones(1, U64)
    step = x % PRIME
    while len(out) < count:
        out = np.concatenate([out, out * U64(step) % _P])
        step = step * step % PRIME
    return out[:count]


class Transform:
    """Number theoretic transforms of length n (a power of two) along the last
    axis: forward leaves bit-reversed order, inverse takes it."""

    def __init__(self, n: int):
        self.n = n
        root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
        self.down, self.up = [], []
        half = n // 2
        while half:
            w = pow(root, n // (2 * half), PRIME)
            self.down.append((half, _power(w, half)))
            self.up.append((half, _power(pow(w, PRIME - 2, PRIME), half)))
            half //= 2
        self.scale = U64(pow(n, PRIME - 2, PRIME))

    def forward(self, x: np.ndarray) -> np.ndarray:
        for half, w in self.down:
            v = x.reshape(len(x), -1, 2, half)
            a, b = v[:, :, 0], v[:, :, 1]
            total = a + b
            diff = (a + (_P - b)) * w % _P
            v[:, :, 0] = np.minimum(total, total - _P)
            v[:, :, 1] = diff
        return x

    def inverse(self, x: np.ndarray) -> np.ndarray:
        for half, w in reversed(self.up):
            v = x.reshape(len(x), -1, 2, half)
            a, b = v[:, :, 0].copy(), v[:, :, 1] * w % _P
            total, diff = a + b, a + (_P - b)
            v[:, :, 0] = np.minimum(total, total - _P)
            v[:, :, 1] = np.minimum(diff, diff - _P)
        return x * self.scale % _P


def mismatches(blocks: np.ndarray, windows: np.ndarray, transform: Transform) -> np.ndarray:
    """Sum of squared differences modulo PRIME of each block (m, B) with every
    place of its window (m, W), W <= transform.n: (m, W - B + 1)."""
    m, size = blocks.shape
    places = windows.shape[1] - size + 1
    a = np.zeros((m, transform.n), U64)
    a[:, 0] = blocks[:, 0]
    a[:, transform.n - size + 1:] = blocks[:, :0:-1]  # reversed: the product correlates
    b = np.zeros((m, transform.n), U64)
    b[:, :windows.shape[1]] = windows
    cross = transform.inverse(transform.forward(a) * transform.forward(b) % _P)[:, :places]
    own = (blocks * blocks % _P).sum(axis=1) % _P
    squares = np.zeros((m, windows.shape[1] + 1), U64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    there = (squares[:, size:] - squares[:, :places]) % _P
    return (own[:, None] + there + (_P - cross) * U64(2)) % _P


# ------------------------------------------------------------ one chunk
class _Found:
    """Runs found so far; places are those of the chunk."""

    def __init__(self):
        self.rows: list[tuple[int, int, int]] = []
        self.seen: set[tuple[int, int]] = set()
        self._at = None

    def add(self, start: int, end: int, q: int) -> None:
        if (start, end) not in self.seen:
            self.seen.add((start, end))
            self.rows.append((start, end, q))
            self._at = None

    def covering(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Period of the run, among those that start at ``start`` or before,
        that reaches furthest, if it reaches ``end``; else 0."""
        if not self.rows:
            return np.zeros(len(start), np.int64)
        if self._at is None:
            r = np.array(sorted(self.rows), np.int64)
            far = np.maximum.accumulate(r[:, 1])
            best = np.maximum.accumulate(np.where(r[:, 1] == far, np.arange(len(r)), 0))
            self._at = r[:, 0], far, r[best, 2]
        starts, far, period = self._at
        k = np.searchsorted(starts, start, "right") - 1
        return np.where((k >= 0) & (far[k] >= end), period[k], 0)


def _seeds(word, key, order, doc_start, doc_end, size, low, high, transform, found):
    """(place, distance) of the zero-mismatch occurrences of a scale."""
    # Docs long enough for the scale's smallest run.
    docs = np.flatnonzero(doc_end - doc_start >= max(MIN_LENGTH, 2 * low))
    if not len(docs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = np.maximum((doc_end[docs] - doc_start[docs] - low) // size, 0)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(doc_start[docs], count) + within * size
    stop = np.repeat(doc_end[docs], count)
    # Words with a like word at some distance of the scale.
    nearest = np.searchsorted(key, key + low)
    again = np.zeros(len(key) + 1, np.int64)
    hit = key[np.minimum(nearest, len(key) - 1)] - key
    again[order + 1] = (nearest < len(key)) & (hit >= low) & (hit <= high)
    again = np.cumsum(again)
    keep = again[np.minimum(at + size, len(key))] - again[at] == size
    at, stop = at[keep], stop[keep]
    inside = found.covering(at, np.minimum(at + high + size, stop))
    keep = (inside == 0) | (inside > size)
    at, stop = at[keep], stop[keep]
    reach = np.arange(high - low + size)
    places, distances = [], []
    for k in range(0, len(at), max(1, SLAB // transform.n)):
        x, e = at[k:k + max(1, SLAB // transform.n)], stop[k:k + max(1, SLAB // transform.n)]
        window = word[np.minimum(x[:, None] + low + reach, len(word) - 1)]
        row, q = np.nonzero(mismatches(word[x[:, None] + np.arange(size)], window, transform) == 0)
        q += low
        ok = x[row] + q + size <= e[row]
        places.append(x[row][ok])
        distances.append(q[ok])
    return (np.concatenate(places), np.concatenate(distances)) if places else (np.zeros(0, np.int64),) * 2


def _near_enough(h, x, q, size, lo, hi):
    """Whether the like words around each seed, as far as NEAR words on either
    side show, can be a run."""
    span = np.arange(-NEAR, NEAR + 1)
    left = x[:, None] + span[None, :NEAR]
    right = (x + size)[:, None] + span[None, NEAR:-1]
    like = []
    for p in (left, right):
        ok = (p >= lo[:, None]) & (p + q[:, None] < hi[:, None])
        like.append(ok & (h[np.where(ok, p, 0)] == h[np.where(ok, p + q[:, None], 0)]))
    before = np.argmin(np.column_stack([like[0][:, ::-1], np.zeros(len(x), bool)]), axis=1)
    after = np.argmin(np.column_stack([like[1], np.zeros(len(x), bool)]), axis=1)
    whole = (before < NEAR) & (after < NEAR)  # both ends seen
    return ~whole | (before + after + size >= np.maximum(MIN_LENGTH - q, q))


def _extent(h, x, q, lo, hi):
    """The maximal stretch around place x whose words q apart are alike."""
    end, step = x, 64
    while end + q < hi:
        n = min(step, hi - q - end)
        off = np.flatnonzero(h[end:end + n] != h[end + q:end + q + n])
        if len(off):
            end += int(off[0])
            break
        end, step = end + n, 2 * step
    start, step = x, 64
    while start > lo:
        n = min(step, start - lo)
        off = np.flatnonzero(h[start - n:start] != h[start - n + q:start + q])
        if len(off):
            start += int(off[-1]) + 1 - n
            break
        start, step = start - n, 2 * step
    return start, end + q


def find_runs(h: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in the texts bounds[i]:bounds[i+1] of
    the word hashes ``h``."""
    found = _Found()
    total = len(h)
    doc_start, doc_end = bounds[:-1], bounds[1:]
    longest = int((doc_end - doc_start).max(initial=0))
    if longest < MIN_LENGTH:
        return []
    doc = np.repeat(np.arange(len(doc_start)), doc_end - doc_start)
    own = mix(h ^ mix(doc.astype(U64) + U64(0x51ED27)))  # like words of two texts are not alike
    order = np.argsort(own, kind="stable")
    fresh = np.concatenate([[False], own[order][1:] != own[order][:-1]])
    # (word, place) as one number; the gap keeps distances inside a word.
    key = np.cumsum(fresh) * (2 * total + 2) + order
    word = mix(own ^ U64(0xA24BAED4963EE407)) % _P
    size = 2
    while True:
        low, high = (1, 6) if size == 2 else (2 * size - 1, 4 * size - 2)
        if 2 * low > longest:
            return found.rows
        x, q = _seeds(word, key, order, doc_start, doc_end, size, low, high, Transform(4 * size), found)
        inside = found.covering(x, x + q + size)
        new = (inside == 0) | (q % np.maximum(inside, 1) != 0)
        x, q = x[new], q[new]
        lo, hi = doc_start[doc[x]], doc_end[doc[x]]
        for part in range(0, len(x), SLAB // 32):
            _extend(own, *(v[part:part + SLAB // 32] for v in (x, q, lo, hi)), size, found)
        size *= 2


def _extend(h, x, q, lo, hi, size, found):
    near = _near_enough(h, x, q, size, lo, hi)
    x, q, lo, hi = x[near], q[near], lo[near], hi[near]
    past = (0, -1, 0)  # (distance, text, end of its last stretch)
    for k in np.lexsort((x, lo, q)):
        place, step, first = int(x[k]), int(q[k]), int(lo[k])
        if past[:2] == (step, first) and place + step + size <= past[2]:
            continue
        start, end = _extent(h, place, step, first, int(hi[k]))
        if start <= place and end >= place + step + size:
            past = (step, first, end)
            if end - start >= max(MIN_LENGTH, 2 * step):
                found.add(start, end, step)


# ------------------------------------------------------------ texts
def _word_spans(data: np.ndarray, bounds: np.ndarray):
    """Byte start and end of every word of a chunk, in order."""
    solid = PLAIN[data] > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    return (np.flatnonzero(solid & (~before | edge[:-1])),
            np.flatnonzero(solid & (~after | edge[1:])) + 1)


def _collapsed(data, begin, end, cuts, dropped) -> pa.Array:
    """The kept words of each text, joined by one space."""
    kept = np.flatnonzero(~dropped)
    row = np.searchsorted(cuts, kept, "right") - 1
    length = end[kept] - begin[kept]
    last = np.append(row[1:] != row[:-1], True)[:len(kept)]
    wide = length + ~last  # a space follows all but a text's last word
    at = np.cumsum(wide) - wide
    out = np.full(int(wide.sum()), 32, np.uint8)
    place = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    source = np.repeat(begin[kept] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    out[place] = data[source]
    size = np.bincount(row, weights=wide, minlength=len(cuts) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def runs_of_texts(column: pa.Array):
    """For each chunk of the column: (runs of each text as a list array of
    (start, length, period), collapsed texts)."""
    hasher = WordHasher(PLAIN, fold=False)
    for _, data, bounds in text_chunks(column):
        h, rows, _ = hasher(data, bounds)
        cuts = np.searchsorted(rows, np.arange(len(bounds)))
        runs = np.array(find_runs(h, cuts), np.int64).reshape(-1, 3)
        row = np.searchsorted(cuts, runs[:, 0], "right") - 1
        order = np.lexsort((runs[:, 2], runs[:, 0]))
        runs, row = runs[order], row[order]
        marks = np.zeros(len(h) + 1, np.int64)
        np.add.at(marks, np.minimum(runs[:, 0] + runs[:, 2], len(h)), 1)
        np.add.at(marks, runs[:, 1], -1)
        begin, end = _word_spans(data, bounds)
        text = _collapsed(data, begin, end, cuts, np.cumsum(marks)[:len(h)] > 0)
        fields = [pa.array(runs[:, 0] - cuts[row]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])]
        offsets = pa.array(np.searchsorted(row, np.arange(len(bounds))).astype(np.int32))
        yield pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["start", "length", "period"])), text


RUN = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs by start then period, collapsed) for every row: ``collapsed``
    is the text without the words that some run holds after its first period."""
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias(id_col)).alias("k"),
                       F.col(f"`{text_col}`").cast("string").alias("t"))

    def run(batches):
        for batch in batches:
            at = 0
            for runs, text in runs_of_texts(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(runs)), runs, text.cast(pa.string()) if text.nbytes < 1 << 31 else text],
                    names=["k", "runs", "collapsed"])
                at += len(runs)

    schema = T.StructType([rows.schema["k"], T.StructField("runs", T.ArrayType(T.StructType(
        [T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(run, schema).select(f"k.`{id_col}`", "runs", "collapsed")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest (ties: smallest start, then period), its
    exponent in thousandths, and digests of all runs and of the kept words."""
    first = F.array_sort("runs", lambda a, b: F.coalesce(
        F.nullif(F.signum(b["length"] - a["length"]), F.lit(0.0)), F.nullif(F.signum(a["start"] - b["start"]), F.lit(0.0)),
        F.signum(a["period"] - b["period"])).cast("int"))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    out = found.withColumn("top", F.get(first, F.lit(0)))
    return out.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(text: Column, key: Column) -> Column:
    """The text's words joined by one space; where h % 10 = 0 for h, the CRC of
    the key's decimal digits, with g = h div 10, each word from a = g % n on is
    replaced by the word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8).
    Texts of a null key keep their words."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(key.cast("string").cast("binary"))

    def periodic(s):
        n = F.size(s["w"]).cast("long")
        a = F.pmod(s["g"], n)
        p = 1 + F.floor((n - a) / (3 + s["g"] % 8))
        head = F.slice(s["w"], F.lit(1), a.cast("int"))
        body = F.slice(s["w"], (a + 1).cast("int"), p.cast("int"))
        rest = n - a
        tail = F.flatten(F.array_repeat(body, F.ceil(rest / p).cast("int")))
        return F.concat(head, F.slice(tail, F.lit(1), rest.cast("int")))

    bound = F.struct(words.alias("w"), F.floor(h / 10).alias("g"))
    repeated = F.get(F.transform(F.array(bound), periodic), F.lit(0))
    changed = (h % 10 == 0) & (F.size(words) > 0)
    return F.when(changed, F.array_join(repeated, " ")).otherwise(F.coalesce(text, F.lit("")))
