"""How five document filters interact, in every order.

Failure conditions: A, fewer than 50 words; B, fewer than 65 distinct words in
a hundred; C, more than 5 capitals A-Z in a hundred code points; D, one of
``#$%&*|``; E, a text identical to that of a smaller doc_id, wherever it is.

E is an existential self-join: rows of texts that occur under several ids meet
the smallest id of each such text by hash, exact text and smaller doc_id in a
left-semi join.  A row's other conditions and E form a set of letters (five
bits); the union of all rows, counted without E, and of E's rows, which move
one count from their set to the set with E, gives the counts of the 32 bit
combinations of each part.  Every figure of the 120 orders follows from them: a
filter removes, at its place in an order, the documents that fail it and none
before it; over all orders, a document failing k filters is removed 120 / k
times by each of them.

Texts are shuffled only for ids whose hash occurs under several ids (Spark's
runtime Bloom filter keeps the others out).  Groups of copies of any size are
combined on the map side to one row per text; the joins of their rows are with
staged tables, so adaptive execution splits a hot text or id.  What is
collected per part has at most 32 entries.

Defined cases: null texts are empty (A fails, B to D pass, E as any text), a
null part is the empty string.  A null doc_id fails no E and makes none fail.
Every row counts, repeated rows too; rows of one doc_id are no copies of each
other.  Labels of one doc_id repeated count once (their largest values).  An
empty table has no parts and gives no rows.  Columns other than those named are
not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, drop_stage, stage

FILTERS = "ABCDE"
E_BIT = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SPACES = "[\\x20\\x09-\\x0D]+"


def own_failures(text: Column) -> Column:
    """The bits of A to D for a text (not null)."""
    words = F.array_remove(F.split(text, SPACES), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.length(text).cast("long")
    capitals = chars - F.length(F.translate(text, UPPER, ""))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * chars, text.rlike("[#$%&*|]")]
    bits = F.lit(0)
    for k, fail in enumerate(fails):
        bits = bits + F.when(fail, F.lit(1 << k)).otherwise(0)
    return bits.cast("int")


def _rows(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))


def _judged(labels: DataFrame, id_col: str) -> DataFrame:
    known = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("id"))
    return known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """(part, bits, n, good, toxic): documents of each combination of failures."""
    rows = _rows(docs, id_col, text_col, part_col)
    judged = stage(_judged(labels, id_col), "judged")
    facts = stage(rows.select("id", "part", own_failures(F.col("t")).alias("bits"), F.xxhash64("t").alias("h"),
                              F.octet_length("t").alias("size")), "facts")
    marked = stage(facts.join(judged, "id", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")}), "marked")
    # Texts, by hash and size, under several ids.
    twice = stage(marked.where("id is not null").groupBy("h", "size").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                  .where("lo < hi").select("h", "size"), "twice")
    ids = stage(marked.where("id is not null").join(twice, ["h", "size"], "left_semi").select("id", "good", "toxic").distinct(), "ids")
    # The comparison marks the side as selective: Spark then builds its runtime
    # Bloom filter from it.
    needed = ids.where(F.col("id") >= F.lit(-(1 << 63)).cast("long"))
    texts = stage(rows.join(needed, "id").withColumn("h", F.xxhash64("t")), "texts")
    first = stage(texts.groupBy("h", "t").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                  .where("first < last").select("h", "t", "first"), "first")
    a, b = texts.alias("a"), first.alias("b")
    copies = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.t") == F.col("b.t")) & (F.col("b.first") < F.col("a.id")), "left_semi")
    moved = copies.select("part", "good", "toxic", own_failures(F.col("t")).alias("bits"))
    moved = moved.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("bits"), F.lit(-1).cast("long").alias("n")),
        F.struct((F.col("bits") + E_BIT).alias("bits"), F.lit(1).cast("long").alias("n")))).alias("x"))
    union = marked.select("part", "good", "toxic", "bits", F.lit(1).cast("long").alias("n")).unionByName(
        moved.select("part", "good", "toxic", "x.bits", "x.n"))
    counts = stage(union.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")), "counts")
    for t in (judged, facts, marked, twice, ids, texts, first):
        drop_stage(t)
    return counts


def _bit(letters: Column) -> Column:
    """The bits of the letters a string holds."""
    return sum((F.when(F.contains(letters, F.lit(c)), F.lit(1 << k)).otherwise(0) for k, c in enumerate(FILTERS)), F.lit(0))


def order_figures(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts of bit combinations."""
    sets = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("sets"))
    each = sets.select("part", "sets", F.explode(F.split(F.lit(" ".join(ORDERS)), " ")).alias("filter_order"))
    each = each.select("part", "sets", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    each = each.withColumn("own", _bit(F.substring("filter_order", F.col("step"), F.lit(1)))).withColumn(
        "before", _bit(F.substring("filter_order", F.lit(1), F.col("step") - 1)))

    def total(keep, value):
        return F.aggregate(F.filter("sets", keep), F.lit(0).cast("long"), lambda acc, s: acc + value(s))

    def fails(s):
        return s["bits"].bitwiseAND(F.col("own")) != 0

    def earlier(s):
        return s["bits"].bitwiseAND(F.col("before")) != 0
    out = {
        "kept": total(lambda s: s["bits"].bitwiseAND(F.col("own").bitwiseOR(F.col("before"))) == 0, lambda s: s["n"]),
        "removed": total(lambda s: fails(s) & ~earlier(s), lambda s: s["n"]),
        "redundant": total(lambda s: fails(s) & earlier(s), lambda s: s["n"]),
        "unique_fails": total(lambda s: s["bits"] == F.col("own"), lambda s: s["n"]),
        "good_lost": total(lambda s: fails(s) & ~earlier(s), lambda s: s["good"]),
        "toxic_lost": total(lambda s: fails(s) & ~earlier(s), lambda s: s["toxic"]),
        "shapley": total(fails, lambda s: s["n"] * (F.lit(len(ORDERS)) / F.bit_count(s["bits"])).cast("long")),
    }
    return each.select("part", "filter_order", "step", *(c.alias(name) for name, c in out.items()))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """The figures of every order and step for each part of ``docs``."""
    return order_figures(failure_counts(docs, labels, id_col, text_col, part_col))
