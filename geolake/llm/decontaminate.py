"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every WINDOW consecutive K-grams (hashes of K words) the smallest is kept as
a fingerprint, so two texts that share K + WINDOW - 1 = SPAN words share one:
the guarantee that finds every benchmark window of SPAN words.  The document's
fingerprints are joined with the benchmark's; around each hit every SPAN-word
window that could hold it is extended and compared with the benchmark's windows
by its words, so a hash never decides.  A benchmark item of fewer words is one
window; for each such length that occurs the documents' runs of that length
are fingerprints too.

Benchmark fingerprints and windows are broadcast only if their counted rows
stay under BROADCAST_ROWS; beyond that the joins shuffle (and adaptive
execution splits a passage that many documents share).  A document's own
fingerprints are distinct before they leave it.

Defined cases: A-Z are lower-cased; words are runs of 0-9, a-z and non-ASCII
characters; null or wordless texts have no words and no hits, null or wordless
items no windows; repeated items count once per item_id, a null item_id counts
as no item but its windows still hit; repeated documents get a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage

SPAN, K = 10, 5
WINDOW = SPAN - K + 1
#: Rows of 16 bytes (fingerprints) or about 100 bytes (windows).
BROADCAST_ROWS = 200_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _runs(h: Column, n: Column, length: int, *seed: Column) -> Column:
    """Hash of every run of ``length`` words (none if there are fewer)."""
    starts = F.sequence(F.lit(0), n - length)
    made = F.transform(starts, lambda i: F.xxhash64(*seed, *(F.get(h, i + j) for j in range(length))))
    return F.when(n >= length, made).otherwise(F.array().cast("array<bigint>"))


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """Adds ``words``, ``n`` and ``h`` (a hash per word)."""
    df = df.withColumn("words", words_of(F.col(text)))
    return df.select("*", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))


def _fingerprints(g: Column) -> Column:
    """Distinct minima of the windows of K-gram hashes."""
    m = F.size(g)
    starts = F.sequence(F.lit(0), m - WINDOW)
    low = F.transform(starts, lambda i: F.least(*(F.get(g, i + j) for j in range(WINDOW))))
    return F.when(m >= WINDOW, F.array_distinct(low)).otherwise(F.array().cast("array<bigint>"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _found(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """Of documents (id, t, x): (id, x, n) for every row, and a summary
    (id2, x2, n_hit, n_items, items_sha256) of those that hit."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).cast("string").alias("t"))
    items = stage(_hashed(items, "t").where("n > 0").select("item", "words", "n", "h"), "items")

    long_items = items.where(F.col("n") >= SPAN)
    short_items = items.where(F.col("n") < SPAN)
    lengths = sorted(r.n for r in short_items.select("n").distinct().collect())  # at most SPAN - 1 values
    windows = long_items.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n") - SPAN + 1), lambda s: F.array_join(F.slice("words", s, SPAN), " "))).alias("window"))
    windows = windows.unionByName(short_items.select("item", F.array_join("words", " ").alias("window")))
    windows = stage(windows.distinct(), "windows")
    prints = long_items.select(_runs(F.col("h"), F.col("n"), K).alias("g")).select(F.explode(_fingerprints(F.col("g"))).alias("fp"))
    for n in lengths:
        prints = prints.unionByName(short_items.where(F.col("n") == n).select(F.explode(_runs(F.col("h"), F.col("n"), n, F.lit(n))).alias("fp")))
    prints = stage(prints.distinct(), "prints")

    # One pass over all texts: word counts, and the fingerprints that hit.
    hashed = _hashed(docs, "t").select("id", "x", "n", "h")
    grams = hashed.select("id", "x", "n", "h", _runs(F.col("h"), F.col("n"), K).alias("g"))
    found = F.when(F.col("n") >= SPAN, _fingerprints(F.col("g"))).otherwise(F.array().cast("array<bigint>"))
    for n in lengths:
        found = F.array_union(found, _runs(F.col("h"), F.col("n"), n, F.lit(n)))
    exploded = grams.select("id", "x", "n", F.posexplode_outer(found).alias("pos", "fp"))
    hits = exploded.join(_small(prints.select("fp", F.lit(True).alias("hit"))), "fp", "left")
    hits = hits.where("hit or pos = 0 or pos is null")
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    hits = stage(hits.select("id", "x", "n", first.alias("first"), F.when(F.col("hit"), F.col("fp")).alias("fp")), "hits")

    # The documents that hit: extend and compare the words.
    by_doc = stage(hits.where("fp is not null").groupBy("id", "x").agg(F.collect_set("fp").alias("fps")), "by_doc")
    # The comparison marks the side as selective: Spark builds its runtime Bloom
    # filter from it, and only texts that hit are shuffled.
    by_doc = by_doc.where(F.col("x") >= F.lit(-(1 << 63)).cast("long"))
    same = docs.id.eqNullSafe(by_doc.id) & (docs.x == by_doc.x)
    near = docs.join(by_doc, same).select(docs.id, docs.x, "t", "fps").dropDuplicates(["id", "x"])
    near = _hashed(near, "t").select("id", "x", "fps", "words", "n", "h")
    near = near.withColumn("g", _runs(F.col("h"), F.col("n"), K))
    for n in lengths:
        near = near.withColumn(f"g{n}", _runs(F.col("h"), F.col("n"), n, F.lit(n)))

    def where_hit(g: str) -> Column:
        at = F.transform(F.col(g), lambda v, i: F.when(F.array_contains("fps", v), i))
        return F.array_compact(at)

    def around(p: Column) -> Column:
        low, high = F.greatest(p - (SPAN - K), F.lit(0)), F.least(p, F.col("n") - SPAN)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    near = near.withColumn("at", where_hit("g"))
    starts = F.when(F.col("n") >= SPAN, F.array_distinct(F.flatten(F.transform("at", around)))).otherwise(F.array().cast("array<int>"))
    def as_spans(at: Column, length: int) -> Column:
        return F.transform(at, lambda s: F.struct(s.alias("s"), F.lit(length).alias("len")))

    spans = F.concat(as_spans(starts, SPAN), *(as_spans(where_hit(f"g{n}"), n) for n in lengths))
    near = near.select("id", "x", "words", spans.alias("spans"))
    tried = near.select("id", "x", F.explode(F.transform("spans", lambda p: F.struct(
        p.s.alias("s"), p.len.alias("len"), F.array_join(F.slice("words", p.s + 1, p.len), " ").alias("window")))).alias("p"))
    tried = tried.select("id", "x", "p.s", "p.len", "p.window")
    real = tried.join(_small(windows), "window")
    summary = real.groupBy("id", "x").agg(F.collect_set(F.struct("s", "len")).alias("spans"), F.collect_set("item").alias("items"))
    covered = F.flatten(F.transform("spans", lambda p: F.sequence(p.s, p.s + p.len - 1)))
    summary = summary.select(F.col("id").alias("id2"), F.col("x").alias("x2"), F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                             F.size("items").cast("long").alias("n_items"),
                             F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"))

    return hits.where("first").select("id", "x", "n"), summary


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row is known by its id and a hash of its text, null ids included."""
    t = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), t.alias("t"), F.xxhash64(t).alias("x"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    every, summary = _found(_keyed(docs, id_col, text_col), benchmark, item_col, item_text)
    out = every.join(summary, every.id.eqNullSafe(summary.id2) & (every.x == summary.x2), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    _, summary = _found(_keyed(docs, id_col, text_col), benchmark, "item_id", "text")
    same = F.col(f"`{id_col}`").eqNullSafe(summary.id2) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == summary.x2)
    return docs.join(summary.select("id2", "x2"), same, "left_anti")
