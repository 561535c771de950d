"""Record boundaries of large delimited and JSON documents, found in parallel.

A file is read in byte ranges (splits).  Whether a line of a split begins
inside a quoted field, or how deep a piece of JSON lies, depends on everything
before it; so every split first reports what it does to the reader's state (a
function of the state it is entered with, or a sum), the reports of a file's
splits are folded in order, and each split then continues from its own entry
state.  A task holds one split, never a file; records are assembled from their
lines only.

Delimited files follow the usual rules: a quote opens a quoted field at the
start of a field only, ``""`` inside it is a quote, and separators and line
ends inside it belong to the field; blank lines are skipped and empty fields
are NULL.  Lines end in LF or CRLF.  A quote that is never closed makes the
rest of its file a reject, not a record.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialize, release

#: Header lines that differ among the files of one read.
MAX_HEADERS = 100

_SPLIT = ["file", "split"]


def _pieces(spark: SparkSession, path: str | Sequence[str], end: str, encoding: str) -> DataFrame:
    """(file, split, row, value): the pieces between ``end``, in order of row
    inside a split of a file."""
    raw = spark.read.option("lineSep", end).text(path)
    value = F.col("value") if encoding.lower().replace("-", "") == "utf8" else F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("row"), value.alias("value"))


# ------------------------------------------------------------ folds
def running_total(df: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the sum of ``col`` over all pieces of the file before it."""
    before = Window.partitionBy(*_SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    splits = df.groupBy(*_SPLIT).agg(F.sum(col).alias("_sum"))
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    entry = splits.select(*_SPLIT, F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_entry"))
    return (df.withColumn("_own", F.coalesce(F.sum(col).over(before), F.lit(0))).join(entry, _SPLIT)
            .withColumn(out, F.col("_entry") + F.col("_own")).drop("_entry", "_own"))


def _after(window, order_flips: str, start: Column) -> Column:
    """State after the pieces of ``window`` entered with ``start``: what the
    last piece that sets it leaves, flipped as often as pieces flip it since."""
    sets = F.last("_set", ignorenulls=True).over(window)
    flips = F.coalesce(F.sum(order_flips).over(window), F.lit(0))
    return F.when(sets.isNull(), (start + flips) % 2).otherwise((sets["v"] + flips - sets["f"]) % 2)


def entering_state(df: DataFrame, from0: str, from1: str, out: str) -> DataFrame:
    """``df`` with the state (0 or 1) before each piece; ``from0`` and
    ``from1`` are the states after it if it is entered with 0 or 1.  Files
    begin with 0."""
    flip = ((F.col(from0) == 1) & (F.col(from1) == 0)).cast("int")
    fixed = F.col(from0) == F.col(from1)
    here = Window.partitionBy(*_SPLIT).orderBy("row")
    counted = df.withColumn("_flip", flip).withColumn("_flips", F.sum("_flip").over(here))
    marked = counted.withColumn("_set", F.when(fixed, F.struct(F.col(from0).alias("v"), F.col("_flips").alias("f"))))
    # What a split does: its flips, and the last piece that sets the state.
    splits = marked.groupBy(*_SPLIT).agg(F.sum("_flip").alias("_flip"), F.max_by("_set", F.when(fixed, F.col("row"))).alias("_last"))
    whole = Window.partitionBy("file").orderBy("split")
    ahead = whole.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_done", F.sum("_flip").over(whole))
    # A set state inside a split, with the flips of the file until then.
    splits = splits.withColumn("_set", F.when(F.col("_last").isNotNull(), F.struct(
        F.col("_last.v").alias("v"), (F.col("_done") - F.col("_flip") + F.col("_last.f")).alias("f"))))
    entry = splits.select(*_SPLIT, _after(ahead, "_flip", F.lit(0)).alias("_entry"))
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    return (marked.join(entry, _SPLIT).withColumn(out, _after(before, "_flip", F.col("_entry")).cast("int"))
            .drop("_flip", "_flips", "_set", "_entry"))


# ------------------------------------------------------------ delimited
def _open_patterns(sep: str) -> tuple[str, str]:
    """Patterns of lines that end inside a quoted field, entered outside one
    and inside one.  Possessive: no backtracking."""
    s = re.escape(sep)
    quoted = r'"[^"]*+(?:""[^"]*+)*+'
    fields = rf'(?:(?:{quoted}"[^{s}]*+|[^"{s}][^{s}]*+)?+{s})*+'
    inside = r'[^"]*+(?:""[^"]*+)*+'
    return (rf'\A{fields}{quoted}\z', rf'\A{inside}(?:"[^{s}]*+{s}{fields}{quoted})?+\z')


def delimited_records(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
                      encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """(records, rejects): records (file, split, row, first, value) of one or
    more lines, ``first`` marking each file's first; rejects (file, split, row,
    value, reason)."""
    from0, from1 = _open_patterns(sep)
    lines = _pieces(spark, path, "\n", encoding).withColumn("value", F.regexp_replace("value", "\r\\z", ""))
    quote = F.contains("value", F.lit('"'))
    lines = materialize(lines.withColumns({
        "from0": F.when(quote, F.col("value").rlike(from0).cast("int")).otherwise(0),
        "from1": F.when(quote, F.col("value").rlike(from1).cast("int")).otherwise(1)}), "lines")
    state = entering_state(lines.select(*_SPLIT, "row", "from0", "from1", (F.trim("value") == "").alias("blank")), "from0", "from1", "inside")
    state = state.withColumn("starts", ((F.col("inside") == 0) & ~F.col("blank")).cast("int")).withColumn(
        "open", F.when(F.col("inside") == 0, F.col("from0")).otherwise(F.col("from1")))
    state = materialize(running_total(state, "starts", "before").select(*_SPLIT, "row", "inside", "starts", "open", "before"), "states")
    # The last line of a file tells whether its last record is ever closed.
    last = state.groupBy("file").agg(F.max_by("open", F.struct("split", "row")).alias("torn"), F.sum("starts").alias("records"))
    number = F.col("before") + F.col("starts") - 1
    placed = lines.select(*_SPLIT, "row", "value").join(state, [*_SPLIT, "row"]).withColumn("record", number).join(last, "file")
    torn = (F.col("torn") == 1) & (F.col("record") == F.col("records") - 1)
    kept = placed.where(~torn & ((F.col("inside") == 1) | (F.col("starts") == 1)))
    single = kept.where((F.col("inside") == 0) & (F.col("open") == 0)).select(
        *_SPLIT, "row", (F.col("record") == 0).alias("first"), "value")
    parts = kept.where((F.col("inside") == 1) | (F.col("open") == 1)).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "value"))).alias("parts"))
    long = parts.select("file", F.get("parts", F.lit(0))["split"].alias("split"), F.get("parts", F.lit(0))["row"].alias("row"),
                        (F.col("record") == 0).alias("first"), F.array_join(F.col("parts.value"), "\n").alias("value"))
    rejects = placed.where(torn).select(*_SPLIT, "row", "value", F.lit("a quote is never closed").alias("reason"))
    return single.unionByName(long), rejects


def has_open_lines(spark: SparkSession, path: str | Sequence[str], sep: str, encoding: str = "UTF-8") -> bool:
    """Whether some line, read as a record of its own, ends inside a quoted
    field.  If none does, every line is a record."""
    from0, _ = _open_patterns(sep)
    return not _pieces(spark, path, "\n", encoding).where(
        F.contains("value", F.lit('"')) & F.regexp_replace("value", "\r\\z", "").rlike(from0)).isEmpty()


def _fields(record: Column, names: Sequence[str], sep: str) -> Column:
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    return F.from_csv(record, schema.simpleString()[len("struct<"):-1].replace(":", " "),
                      {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"})


def header_names(line: str, sep: str) -> list[str]:
    """The column names of a header record."""
    import csv
    return next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8",
                   place: bool = False) -> DataFrame:
    """Every column as text, by each file's own header, plus ``_file`` (and
    ``_place``: file, split, row, in file order).  Columns that a file lacks
    are NULL.  Files without multi-line fields are read line by line."""
    if not has_open_lines(spark, path, sep, encoding):
        records = _pieces(spark, path, "\n", encoding).withColumn("value", F.regexp_replace("value", "\r\\z", ""))
        records = records.where(F.trim("value") != "")
        heads = records.groupBy("file").agg(F.min_by("value", F.struct("split", "row")).alias("head"),
                                            F.min(F.struct("split", "row")).alias("at"))
        records = records.withColumn("first", F.lit(None).cast("boolean"))
    else:
        records, _ = delimited_records(spark, path, sep, encoding)
        heads = records.where("first").select("file", F.col("value").alias("head"), F.struct("split", "row").alias("at"))
    heads = materialize(heads, "headers")
    texts = [r[0] for r in heads.select("head").distinct().orderBy("head").limit(MAX_HEADERS + 1).collect()]
    if len(texts) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {path}")
    out = None
    for text in texts:
        names = header_names(text, sep)
        # One row per file is sent out: the records stay where they are, in order.
        mine = records.join(F.broadcast(heads.where(F.col("head") == text).select("file", "at")), "file").where(
            F.struct("split", "row") != F.col("at"))
        rows = mine.select(_fields(F.col("value"), names, sep).alias("r"), F.col("file").alias("_file"),
                           F.struct("file", "split", "row").alias("_place"))
        cols = [F.nullif(F.col(f"r.c{i}"), F.lit("")).alias(n) for i, n in enumerate(names)]
        rows = rows.select(*cols, "_file", *(["_place"] if place else []))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no header under {path}")
    return out


# ------------------------------------------------------------ JSON
def json_records(spark: SparkSession, path: str | Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON documents (one per file) of any size and
    layout.  Records (file, place, value) are the texts of all objects in the
    top-level array ``key``, ``place`` ordering those of a file; rejects (file,
    reason) are documents that end too early, whose last object is left out.

    The document is read in pieces that end at ``}``; quotes before a piece
    tell whether it begins inside a string, braces outside strings how deep it
    ends, and an object of the array ends where the depth returns to 1."""
    text = _pieces(spark, path, "}", "UTF-8")
    plain = F.regexp_replace("value", r"\\.", "")
    outside = F.regexp_replace(F.concat(F.when(F.col("inside") == 1, F.lit('"')).otherwise(F.lit("")), plain), r'"[^"]*+("|\z)', "")

    def count(c: Column, char: str) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))
    staged = materialize(text.withColumn("quotes", count(plain, '"')), "json")
    strings = running_total(staged, "quotes", "q").withColumn("inside", (F.col("q") % 2).cast("int"))
    strings = strings.withColumn("closes", ((F.col("q") + F.col("quotes")) % 2 == 0).cast("int"))
    delta = materialize(strings.select(*_SPLIT, "row", "closes", (count(outside, "{") - F.col("closes")).alias("delta")), "depths")
    depth = running_total(delta, "delta", "d").withColumn(
        "ends", ((F.col("closes") == 1) & (F.col("d") + F.col("delta") == 1)).cast("int"))
    # What follows the last brace is read as a piece too: its end is none.
    last = materialize(depth.groupBy("file").agg(F.max(F.struct("split", "row")).alias("end"),
                                                 F.max_by(F.col("d") + F.col("delta"), F.struct("split", "row")).alias("left")), "ends")
    depth = depth.join(last.select("file", "end"), "file").withColumn(
        "ends", F.when(F.struct("split", "row") == F.col("end"), 0).otherwise(F.col("ends")))
    rejects = last.where("left > 0").select("file", F.lit("the document ends inside an object").alias("reason"))
    depth = materialize(running_total(depth, "ends", "record").select(*_SPLIT, "row", "ends", "record"), "records")
    # A piece that starts a record shows the key before it, if there is one.
    pieces = staged.select(*_SPLIT, "row", "value").join(depth, [*_SPLIT, "row"])
    parts = pieces.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "value"))).alias("parts"), F.max("ends").alias("ends"))
    whole = parts.where("ends = 1").select("file", "record", F.concat(F.array_join(F.col("parts.value"), "}"), F.lit("}")).alias("t"))
    root = F.when(F.col("record") == 0, F.regexp_replace("t", r"\A[^{]*+\{", "")).otherwise(F.col("t"))
    lead = F.regexp_extract(root, r'\A([^"{]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{]*+)*+)\{', 1)
    name = F.nullif(F.regexp_extract("lead", r'"([^"\\]*)"\s*:\s*\[?\s*\z', 1), F.lit(""))
    rows = whole.withColumn("body", root).withColumn("lead", lead).select(
        "file", "record", name.alias("name"), F.expr("substring(body, length(lead) + 1)").alias("value"))
    rows = materialize(rows, "objects")
    # Objects without a key of their own belong to the array of the last key.
    starts = rows.where(F.col("name").isNotNull()).select("file", F.col("record").alias("lo"), "name")
    ranges = starts.withColumn("hi", F.lead("lo").over(Window.partitionBy("file").orderBy("lo"))).where(F.col("name") == key)
    ranges = materialize(ranges.select("file", "lo", "hi"), "arrays")   # one row per document, as a rule
    inside = (F.col("record") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("record") < F.col("hi")))
    out = rows.join(ranges, "file").where(inside).select("file", F.col("record").alias("place"), "value")
    for t in (staged, delta, depth):
        release(t)
    return out, rejects
