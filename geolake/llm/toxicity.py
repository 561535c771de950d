"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear (logistic) models
over the words a text holds; each later model also gets the probabilities of
the earlier categories.  It is trained with their out-of-fold predictions, so
it learns from probabilities as good as those it meets on new texts: each
fold's features and weak labels are chosen without its rows.

Categories, in chain order: ``abusive_term`` (a toxic text with a term that
marks toxic texts), ``abusive_repeatedly`` (with at least three of them) and
``toxic`` (the label itself), whose probability decides.  The first two are
weak labels, found in the training rows by the association of terms with the
label.

The fit takes at most MAX_PER_CLASS labelled rows of each class, those of the
smallest hash of their id: the one bounded sample here.  Spark counts its terms
by class and fold; the driver gets the counts of the terms that may be
features, and the rows over those.  Scoring covers every row and whole texts.

Defined cases: null, empty or wordless texts hold no term and get the models'
intercepts; a label repeated for one doc_id counts once (its largest value);
null labels are not learnt from; a doc_id with several rows is learnt from once
(its smallest text).  Without both classes among the labels no
document is toxic (probability 0).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_stage, stage
from .text import MARKED, U64, WordHasher, text_chunks

MAX_PER_CLASS = 8_000
CATEGORIES = ("abusive_term", "abusive_repeatedly", "toxic")
FOLDS = 3
#: A term is a feature if its association with a category's labels has this
#: z-score and it occurs in so many rows; it marks toxic texts if also nearly
#: all texts with it are toxic.
MIN_Z, MIN_ROWS, MARK_SHARE = 3.0, 3, 0.98
RIDGE, STEPS = 1e-6, 800
#: The deciding probability is twice what one clean training text in a thousand
#: gets out of fold, within these limits.
THRESHOLD = (0.1, 0.5)


def term_sets(column: pa.Array):
    """For each row the sorted distinct hashes of its lower-cased words."""
    hasher = WordHasher(MARKED, fold=True, seed=5)
    for _, data, bounds in text_chunks(column):
        h, rows, kind = hasher(data, bounds)
        h, rows = h[kind == 1], rows[kind == 1]
        cut = np.searchsorted(rows, np.arange(len(bounds)))
        for i in range(len(bounds) - 1):
            yield np.unique(h[cut[i]:cut[i + 1]])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Rows:
    """Sparse 0/1 rows over the terms in ``vocab`` (sorted hashes)."""

    def __init__(self, sets: list[np.ndarray], vocab: np.ndarray):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.zeros(0, U64)
        col = np.searchsorted(vocab, flat)
        on = col < len(vocab)
        on[on] = vocab[col[on]] == flat[on]
        self.row, self.col, self.n, self.width = row[on], col[on], len(sets), len(vocab)

    def dot(self, w):
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def back(self, g):
        return np.bincount(self.col, weights=g[self.row], minlength=self.width)


def fit_linear(x: Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray):
    """Ridge logistic regression on the rows ``use`` by gradient steps with
    momentum and per-coordinate scaling: (weights, extra weights, intercept).
    Weights stay at 0 or above: no term makes a text less toxic."""
    weight = use.astype(float)
    count = max(weight.sum(), 1)
    if count == 0 or y[use].min(initial=1) == y[use].max(initial=0):
        share = (y[use].sum() + 0.5) / (count + 1)
        return np.zeros(x.width), np.zeros(extra.shape[1]), float(np.log(share / (1 - share)))
    w, v, b = np.zeros(x.width), np.zeros(extra.shape[1]), 0.0
    mw, mv, mb = w.copy(), v.copy(), 0.0
    sw, sv, sb = np.full(x.width, 1e-12), np.full(len(v), 1e-12), 1e-12
    for step in range(1, STEPS + 1):
        g = (_sigmoid(x.dot(w) + extra @ v + b) - y) * weight / count
        gw, gv, gb = x.back(g) + RIDGE * w, extra.T @ g + RIDGE * v, g.sum()
        mw, mv, mb = (0.9 * m + 0.1 * q for m, q in ((mw, gw), (mv, gv), (mb, gb)))
        sw, sv, sb = (0.99 * s + 0.01 * q * q for s, q in ((sw, gw), (sv, gv), (sb, gb)))
        rate = 0.1 / (1 - 0.9 ** step) * np.sqrt(1 - 0.99 ** step)
        w, v, b = (p - rate * m / (np.sqrt(s) + 1e-10) for p, m, s in ((w, mw, sw), (v, mv, sv), (b, mb, sb)))
        w, v = np.maximum(w, 0), np.maximum(v, 0)
    return w, v, float(b)


def _folds(n: int) -> np.ndarray:
    return np.arange(n) % FOLDS


class Terms:
    """How many training rows of each (fold, label) hold each term: ``terms``
    (sorted hashes) and ``held`` (terms x folds x 2); ``rows`` (folds x 2)."""

    def __init__(self, terms: np.ndarray, held: np.ndarray, rows: np.ndarray):
        self.terms, self.held, self.rows = terms, held.astype(float), rows.astype(float)

    @classmethod
    def of(cls, sets: list[np.ndarray], y: np.ndarray) -> Terms:
        slot = _folds(len(y)) * 2 + y.astype(int)
        terms, at = np.unique(np.concatenate(sets) if sets else np.zeros(0, U64), return_inverse=True)
        held = np.zeros((len(terms), FOLDS * 2))
        np.add.at(held, (at, np.repeat(slot, [len(s) for s in sets])), 1)
        return cls(terms, held.reshape(-1, FOLDS, 2), np.bincount(slot, minlength=FOLDS * 2).reshape(FOLDS, 2))

    def chosen(self, without: int | None):
        """(feature terms, terms that mark toxic texts), found in the rows
        outside the fold ``without``."""
        use = [k for k in range(FOLDS) if k != without]
        p, n = self.held[:, use, 1].sum(axis=1), self.held[:, use].sum(axis=(1, 2))
        neg, pos = self.rows[use].sum(axis=0)
        odds = np.log((p + .5) / (pos - p + .5)) - np.log((n - p + .5) / (neg - n + p + .5))
        z = odds / np.sqrt(1 / (p + .5) + 1 / (n - p + .5))
        some = (z >= MIN_Z) & (n >= MIN_ROWS)
        return self.terms[some], self.terms[some & (p >= MARK_SHARE * n)]


def _features(sets: list[np.ndarray], y: np.ndarray, known: Terms, without: int | None):
    """(feature terms, rows over them, labels of each category); the terms and
    the weak labels are found outside the fold ``without``."""
    vocab, marks = known.chosen(without)
    marked = Rows(sets, marks).dot(np.ones(len(marks)))
    labels = {"abusive_term": y * (marked >= 1), "abusive_repeatedly": y * (marked >= 3), "toxic": y}
    return vocab, Rows(sets, vocab), labels


def out_of_fold(sets: list[np.ndarray], y: np.ndarray, known: Terms | None = None) -> np.ndarray:
    """Probability of each category for each row by models that saw nothing of its fold."""
    fold, known = _folds(len(y)), known or Terms.of(sets, y)
    parts = [_features(sets, y, known, k)[1:] for k in range(FOLDS)]
    before = np.zeros((len(y), 0))
    for name in CATEGORIES:
        out = np.zeros(len(y))
        for k, (x, labels) in enumerate(parts):
            w, v, b = fit_linear(x, before, labels[name], fold != k)
            out[fold == k] = _sigmoid(x.dot(w) + before @ v + b)[fold == k]
        before = np.column_stack([before, out])
    return before


def fit_chain(sets: list[np.ndarray], toxic: np.ndarray, known: Terms | None = None) -> dict | None:
    """Train the chain on term sets and 0/1 labels.  With ``known``, the counts
    of all terms, the sets need hold the terms only that some fold chooses."""
    y = np.asarray(toxic, float)
    if not len(y) or y.min() == y.max():
        return None
    known = known or Terms.of(sets, y)
    before, every = out_of_fold(sets, y, known), np.ones(len(y), bool)
    vocab, x, labels = _features(sets, y, known, None)
    links = [fit_linear(x, before[:, :i], labels[name], every) for i, name in enumerate(CATEGORIES)]
    clean = np.quantile(before[y == 0, -1], 0.999)
    return {"vocab": vocab, "links": links, "threshold": float(np.clip(2 * clean, *THRESHOLD))}


def predict(chain: dict | None, sets: list[np.ndarray]) -> np.ndarray:
    """Probability of each category, in chain order, for each set."""
    before = np.zeros((len(sets), 0))
    if chain is None:
        return np.zeros((len(sets), len(CATEGORIES)))
    x = Rows(sets, chain["vocab"])
    for w, v, b in chain["links"]:
        before = np.column_stack([before, _sigmoid(x.dot(w) + before @ v + b)])
    return before


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> dict | None:
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")))
    chosen = None
    for c in (0, 1):
        some = known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class)
        chosen = some if chosen is None else chosen.unionByName(some)

    # At most 2 * max_per_class ids: a proven bound for the broadcast.  A doc_id
    # with several rows is learnt from once.
    texts = (docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("t"))
             .join(F.broadcast(chosen.withColumnRenamed("doc_id", "key")), "key").groupBy("key", "y").agg(F.min("t").alias("t")))
    sample = stage(texts.mapInArrow(_sets, "key long, y int, terms binary"), "toxic_sample")
    place = F.row_number().over(Window.orderBy("key")) - 1   # of the sample's ids
    folds = sample.select("key", (place % FOLDS).alias("fold"))
    dealt = stage(sample.join(F.broadcast(folds), "key"), "toxic_folds")
    known = _counted(dealt)
    vocab = known.terms
    got = dealt.select("key", "y", "terms").mapInArrow(_kept(vocab), "key long, y int, terms binary").toArrow().sort_by("key")
    drop_stage(sample)
    drop_stage(dealt)
    return fit_chain([np.frombuffer(t.as_buffer(), U64) for t in got.column("terms")], got.column("y").to_numpy(), known)


def _sets(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([s.tobytes() for s in term_sets(batch.column(2))], pa.binary())],
            names=["key", "y", "terms"])


def _kept(vocab: np.ndarray):
    def run(batches):
        for batch in batches:
            own = [np.frombuffer(t.as_buffer(), U64) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s[np.isin(s, vocab)].tobytes() for s in own], pa.binary())],
                names=["key", "y", "terms"])
    return run


def _counted(dealt: DataFrame) -> Terms:
    """Counts of the terms that some fold's rows may choose, made by Spark; the
    driver gets those terms alone."""
    def run(batches):
        for batch in batches:
            own = [np.frombuffer(t.as_buffer(), np.int64) for t in batch.column(2)]
            slot = batch.column(1).to_numpy() * 2 + batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(own) if own else np.zeros(0, np.int64)), pa.array(np.repeat(slot, [len(s) for s in own]).astype(np.int32))],
                names=["term", "slot"])

    slots = range(FOLDS * 2)
    rows = np.zeros(FOLDS * 2)
    for r in dealt.groupBy((F.col("fold") * 2 + F.col("y")).alias("slot")).count().collect():   # at most 2 * FOLDS rows
        rows[r["slot"]] = r["count"]
    terms = dealt.select("y", "fold", "terms").mapInArrow(run, "term long, slot int")
    terms = terms.groupBy("term").agg(*(F.count(F.when(F.col("slot") == k, 1)).cast("double").alias(f"s{k}") for k in slots))
    likely = F.lit(False)
    for without in (None, *range(FOLDS)):
        use = [k for k in range(FOLDS) if k != without]
        p = sum((F.col(f"s{2 * k + 1}") for k in use), F.lit(0.0))
        m = sum((F.col(f"s{2 * k}") for k in use), F.lit(0.0))
        neg, pos = (float(sum(rows[2 * k + c] for k in use)) for c in (0, 1))
        odds = F.log((p + .5) / (F.lit(pos) - p + .5)) - F.log((m + .5) / (F.lit(neg) - m + .5))
        z = odds / F.sqrt(1 / (p + .5) + 1 / (m + .5))
        likely = likely | ((z >= MIN_Z - 1e-6) & (p + m >= MIN_ROWS))   # decided below, to the last digit
    got = terms.where(likely).toArrow()
    found = got.column("term").to_numpy().view(U64)
    order = np.argsort(found)
    held = np.column_stack([got.column(f"s{k}").to_numpy() for k in slots])
    return Terms(found[order], held[order].reshape(-1, FOLDS, 2), rows.reshape(FOLDS, 2))


def _scored(docs: DataFrame, chain: dict | None, text_col: str, keep: list[str]) -> DataFrame:
    """``k`` (a struct of the columns ``keep``) and p0, p1, ... per category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the sample's terms
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    cols = [f"p{i}" for i in range(len(CATEGORIES))]

    def run(batches):
        for batch in batches:
            p = predict(shared.value, list(term_sets(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, i]) for i in range(p.shape[1]))], names=["k", *cols])

    schema = T.StructType([rows.schema["k"], *(T.StructField(c, T.DoubleType()) for c in cols)])
    return rows.mapInArrow(run, schema)


def _toxic(chain: dict | None) -> Column:
    return F.col(f"p{len(CATEGORIES) - 1}") >= (chain["threshold"] if chain else 0.5)


def score(docs: DataFrame, chain: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a probability per category, is_toxic) for every row."""
    out = _scored(docs, chain, text_col, [id_col])
    return out.select(f"k.`{id_col}`", *(F.col(f"p{i}").alias(c) for i, c in enumerate(CATEGORIES)),
                      _toxic(chain).alias("is_toxic"))


def remove_toxic(docs: DataFrame, chain: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows judged toxic; all columns kept."""
    return _scored(docs, chain, text_col, docs.columns).where(~_toxic(chain)).select("k.*")
