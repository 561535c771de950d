"""Quality classifier: logistic regression on hashed word n-grams, learnt by
follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text: its words and punctuation runs, pairs of neighbours, and
the forms of words and of pairs (lower, capitalised, all capitals, digits,
punctuation, same word again), hashed to 2**BITS buckets; the count vector is
scaled to length 1.  A score is the logistic function of its sparse dot
product with the weights.  Only the text is used.

The fit takes at most MAX_TRAIN labelled rows, those of the smallest hash of
their id, in that order: the one bounded sample here.  Scoring covers every
row and whole texts, in tasks of bounded memory.

Defined cases: null or empty texts score as the bias alone; a label repeated
for one doc_id counts once (its smallest value); null labels are not learnt
from; rows with a null doc_id are scored, never learnt from, not held out.
Without any labelled row every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import MARKED, U64, WordHasher, mix, ngrams, text_chunks

BITS = 20
MAX_TRAIN = 8_000
EPOCHS = 3
#: FTRL-proximal: learning rate, its offset, L1 and L2 strength.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
FOLDS = 5

_UP = 1 << 20
_DIGIT = 1 << 40


def _tally() -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[97:123] = 1
    t[65:91] = _UP
    t[48:58] = _DIGIT
    return t


def held_out(doc_id: Column) -> Column:
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == 0, F.lit(False))


def feature_rows(column: pa.Array):
    """(row, buckets, values) of every row, in order; empty ones included."""
    hasher, tally = WordHasher(MARKED, fold=False, seed=3), _tally()
    for base, data, bounds in text_chunks(column):
        h, rows, t = hasher(data, bounds, tally)
        low, up, digit = t & (_UP - 1), (t >> 20) & (_UP - 1), t >> 40
        form = np.where(up + low + digit == 0, 4, np.where(digit > 0, 3, np.where((up > 1) & (low == 0), 2, np.where(up > 0, 1, 0))))
        shape = np.where(form == 4, h, mix(form.astype(U64) + U64(0xF0)))
        again = np.zeros(len(h), bool)
        if len(h) > 1:
            again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        shape = np.where(again, mix(np.full(1, 0xA6, U64)), shape)
        pairs, pair_rows = ngrams(h, rows, 2, seed=21)
        shapes, shape_rows = ngrams(shape, rows, 2, seed=22)
        every = np.concatenate([h, pairs, shape, shapes])
        whose = np.concatenate([rows, pair_rows, rows, shape_rows])
        key, count = np.unique((whose.astype(U64) << U64(BITS)) | (mix(every) >> U64(64 - BITS)), return_counts=True)
        row, bucket = (key >> U64(BITS)).astype(np.int64), (key & U64((1 << BITS) - 1)).astype(np.int32)
        n = len(bounds) - 1
        norm = np.sqrt(np.bincount(row, weights=count.astype(float) ** 2, minlength=n))
        value = (count / norm[row]).astype(np.float32)
        cut = np.searchsorted(row, np.arange(n + 1))
        yield base, n, row, bucket, value, cut


def features(rows: DataFrame) -> DataFrame:
    """(key, y, buckets, vals) of rows (key, y, t)."""
    def run(batches):
        for batch in batches:
            at = [(bucket[cut[i]:cut[i + 1]].tobytes(), value[cut[i]:cut[i + 1]].tobytes())
                  for _, n, _, bucket, value, cut in feature_rows(batch.column(2)) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in at], pa.binary()),
                 pa.array([x[1] for x in at], pa.binary())], names=["key", "y", "buckets", "vals"])

    return rows.mapInArrow(run, "key long, y int, buckets binary, vals binary")


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes over (buckets, values, label)."""
    z, s = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = sb = bias = 0.0

    def weights(i):
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(s[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, x, y in examples:
            w = weights(i)
            bias = -zb / ((BETA + sb ** 0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35)))
            g = (p - y) * x
            z[i] += g - (np.sqrt(s[i] + g * g) - np.sqrt(s[i])) / ALPHA * w
            s[i] += g * g
            d = p - y
            zb += d - ((sb + d * d) ** 0.5 - sb ** 0.5) / ALPHA * bias
            sb += d * d
    return weights(np.arange(1 << BITS)).astype(np.float32), float(-zb / ((BETA + sb ** 0.5) / ALPHA))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Learn from ``labels`` (doc_id, quality) outside the held-out fold."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # At most max_train ids: a proven bound for the broadcast.
    texts = (docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").alias("t"))
             .join(F.broadcast(chosen.withColumnRenamed("doc_id", "key")), "key").select("key", "y", "t"))
    got = sorted((r.key, bytes(r.buckets), bytes(r.vals), r.y) for r in features(texts).collect())
    order = np.random.default_rng(5).permutation(len(got))
    return ftrl([(np.frombuffer(got[k][1], np.int32), np.frombuffer(got[k][2], np.float32).astype(float), got[k][3]) for k in order])


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    weights = docs.sparkSession.sparkContext.broadcast(model[0])  # 2**BITS floats
    bias = model[1]

    def run(batches):
        w = weights.value
        for batch in batches:
            out = [np.bincount(row, weights=w[bucket] * value, minlength=n)
                   for _, n, row, bucket, value, _ in feature_rows(batch.column(1))]
            z = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-(z + bias))))], names=["doc_id", "score"])

    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t"))
           .mapInArrow(run, "doc_id long, score double"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
