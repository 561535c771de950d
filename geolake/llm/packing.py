"""Best-fit packing of documents into sequences of a fixed capacity.

Large-item matching: pieces above a third of the capacity share a sequence at
most in twos, so the largest of them is matched, again and again, with the
largest other one that fits beside it.  The smaller pieces, longest first, then
go to the tightest remaining gap that holds them, or open a new sequence.

Pieces of equal length are alike, so the packing is decided on the number of
pieces of each length (at most ``capacity`` counts, whatever the corpus): the
plan lists, for each length, which ranks go to which sequences at which
offset, in runs of alike sequences.  Its size is bounded by the capacity, not by
the data.  Every piece then finds its place from its rank among the pieces of
its length.  Ranks come from the counts per (length, bucket of the id) and a
numbering inside one bucket; a length of n pieces has about sqrt(n) buckets of
sqrt(n) pieces, so a length shared by a third of all pieces is split too.

A document longer than the capacity, and only such a one, is cut into pieces of
the capacity and a shorter last one.

Defined cases: a null text is empty, and a document has at least its end token.
Rows are independent: repeated rows and null ids are packed as often as they
come.  An empty table packs to an empty one.  A long text is encoded whole by
one task.  ``pack`` returns the caller's columns and the two new ones, which
must not be among them (an error otherwise).
"""

from __future__ import annotations

import math
import re
import struct
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_stage, stage

CAPACITY, END = 4096, 1
#: Distinct words, and distinct parts of words, that a worker remembers the
#: ids of: about 350 MB.
WORDS, PARTS = 600_000, 1_000_000


# ------------------------------------------------------------ tokens
#: Words of printable ASCII and Latin-1 letters: composed already, and folded
#: character by character.
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: What the tokenizer's pattern takes from such a word, folded.
CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if it shows in Latin-1, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PartIds(dict):
    """The token ids of a part of a word, by the tokenizer's merges."""

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, byte_letters()

    def __missing__(self, part: str) -> bytes:
        text = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
        ids = _packed([t.id for t in self.tokenize(text)])
        if len(self) < PARTS:
            self[part] = ids
        return ids


class WordIds(dict):
    """The token ids of a word, as little-endian 32-bit integers.

    For a tokenizer that drops white space and looks at each stretch between
    white space by itself (case folding and composition by character), the ids
    of a text are those of its words in turn.  A simple word is folded and cut
    by the tokenizer's pattern, and each part merged by its model; a word with
    other characters, or that may hold a special token, is encoded as it is.
    Words beyond the first WORDS ones are not remembered.

    An instance travels as its file's name and is filled in each worker."""

    def __init__(self, path: str):
        super().__init__()
        self.path, self.tokenizer = path, None

    def __reduce__(self):
        return WordIds, (self.path,)

    def __missing__(self, word: bytes) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(self.path)
            self.parts = PartIds(self.tokenizer.model)
        text = word.decode()
        if SIMPLE.fullmatch(text) and "<|" not in text:
            ids = b"".join(map(self.parts.__getitem__, CUT.findall(text.lower())))
        else:
            ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self) < WORDS:
            self[word] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        # bytes.split() cuts at ASCII white space only.
        return b"".join(map(self.__getitem__, (text or "").encode().split()))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): the token ids of each text and an end
    token, cut where longer than ``capacity``; ``ids`` are little-endian
    unsigned 32-bit integers."""
    stop = np.array([end], "<u4").tobytes()
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("t"))
    names = [id_col, "piece", "start", "length", "ids"]
    shared = docs.sparkSession.sparkContext.broadcast(WordIds(path))  # a file name; a worker keeps what it learns

    def run(batches):
        words = shared.value
        for batch in batches:
            found, size = ([], [], [], [], []), 0
            for k, text in enumerate(batch.column(1)):
                ids = words.of(text.as_py()) + stop
                for piece, at in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * at:4 * (at + capacity)]
                    for column, value in zip(found, (k, piece, at, len(part) // 4, part)):
                        column.append(value)
                    size += len(part)
                    if size > 1 << 22:
                        yield _piece_rows(batch.column(0), found, names)
                        found, size = ([], [], [], [], []), 0
            yield _piece_rows(batch.column(0), found, names)

    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _piece_rows(ids: pa.Array, found, names) -> pa.RecordBatch:
    row, piece, start, length, part = found
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
         pa.array(length, pa.int64()), pa.array(part, pa.binary())], names=names)


# ------------------------------------------------------------ plan
class _Plan:
    """Runs of alike sequences and the places given in them."""

    def __init__(self, capacity: int):
        self.capacity, self.next = capacity, 0
        self.used: dict[int, int] = {}  # pieces placed, by length
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, count)
        self.gaps: list[int] = []

    def place(self, length: int, first: int, count: int, each: int, offset: int) -> None:
        """``each`` pieces go to every sequence first .. first + count - 1."""
        if count and each:
            lo = self.used.get(length, 0)
            self.used[length] = lo + count * each
            self.rows.append((length, lo, lo + count * each, first, each, offset))

    def leave(self, gap: int, first: int, count: int) -> None:
        if count and gap:
            if gap not in self.open:
                self.open[gap] = []
                insort(self.gaps, gap)
            self.open[gap].append((first, count))

    def begin(self, count: int) -> int:
        first, self.next = self.next, self.next + count
        return first


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces in each sequence,
    offset) for all ``counts`` of lengths 1 .. capacity."""
    plan = _Plan(capacity)
    _match_large(plan, {n: c for n, c in counts.items() if 3 * n > capacity and c})
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        _fit_small(plan, length, counts[length])
    return plan.rows


def _match_large(plan: _Plan, left: dict[int, int]) -> None:
    sizes = sorted(left)

    def used_up(n):
        if not left[n]:
            sizes.pop(bisect_left(sizes, n))
    while sizes:
        big, room = sizes[-1], plan.capacity - sizes[-1]
        k = bisect_left(sizes, room + 1) - 1
        if k < 0:  # no partner: alone, all of this length
            count = left.pop(big)
            sizes.pop()
            first = plan.begin(count)
            plan.place(big, first, count, 1, 0)
            plan.leave(room, first, count)
            continue
        mate = sizes[k]
        if mate == big:
            if left[big] < 2:
                mate = sizes[k - 1] if k else None
            if mate == big:
                count = left[big] // 2
                first = plan.begin(count)
                plan.place(big, first, count, 2, 0)
                plan.leave(room - big, first, count)
                left[big] -= 2 * count
                used_up(big)
                continue
        count = min(left[big], left[mate]) if mate is not None else left[big]
        first = plan.begin(count)
        plan.place(big, first, count, 1, 0)
        left[big] -= count
        if mate is not None:
            plan.place(mate, first, count, 1, big)
            left[mate] -= count
            used_up(mate)
        plan.leave(room - (mate or 0), first, count)
        used_up(big)


def _fit_small(plan: _Plan, length: int, count: int) -> None:
    while count:
        k = bisect_left(plan.gaps, length)
        if k == len(plan.gaps):
            each = plan.capacity // length
            gap, first, there = plan.capacity, plan.begin(-(-count // each)), -(-count // each)
        else:
            gap = plan.gaps[k]
            first, there = plan.open[gap].pop()
            if not plan.open[gap]:
                del plan.open[gap]
                plan.gaps.pop(k)
        each, offset = gap // length, plan.capacity - gap
        whole = min(there, count // each)
        plan.place(length, first, whole, each, offset)
        plan.leave(gap - each * length, first, whole)
        count -= whole * each
        rest = there - whole
        if rest and count:  # the last sequence of this length, filled in part
            plan.place(length, first + whole, 1, count, offset)
            plan.leave(gap - count * length, first + whole, 1)
            count, whole, rest = 0, whole + 1, rest - 1
        plan.leave(gap, first + whole, rest)


# ------------------------------------------------------------ places
def _in_buckets(rows: DataFrame, lengths: dict[int, int]) -> DataFrame:
    """``rows`` with ``bucket``, one of sqrt(n) for a length of n rows."""
    known = rows.sparkSession.createDataFrame([(n, math.isqrt(c) + 1) for n, c in lengths.items()] or [(0, 1)], "len long, buckets long")
    return (rows.join(F.broadcast(known), "len")   # at most capacity rows
            .withColumn("bucket", F.pmod(F.xxhash64("row"), F.col("buckets"))).drop("buckets"))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (rows with a ``length`` of 1 .. capacity) with ``sequence_id``
    and ``offset``."""
    if {"sequence_id", "offset"} & {c.lower() for c in found.columns}:
        raise ValueError("the rows have a column sequence_id or offset already")
    # The staged number tells rows apart, equal ones too.
    kept = stage(found.select(F.struct(*(F.col(f"`{c}`") for c in found.columns)).alias("own"), F.col("length").cast("long").alias("len"),
                              F.monotonically_increasing_id().alias("row")), "pieces")
    lengths = {r["len"]: r["n"] for r in kept.groupBy("len").agg(F.count("*").alias("n")).limit(capacity + 2).collect()}
    if any(n is None or not 0 < n <= capacity for n in lengths):
        raise ValueError("lengths must be 1 to the capacity")
    dealt = _in_buckets(kept, lengths)
    counts = stage(dealt.groupBy("len", "bucket").agg(F.count("*").alias("n")), "piece_counts")
    plan = np.array(sorted(packing_plan(lengths, capacity)), np.int64).reshape(-1, 6)
    shared = found.sparkSession.sparkContext.broadcast(plan)  # bounded by the capacity

    before = Window.partitionBy("len").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # A group has a row for each bucket of a length.
    starts = stage(counts.select("len", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece_starts")
    inside = Window.partitionBy("len", "bucket").orderBy("row")
    ranked = dealt.withColumn("r", F.row_number().over(inside)).join(starts, ["len", "bucket"])
    ranked = ranked.select("own", "len", (F.col("base") + F.col("r") - 1).alias("rank"))

    def run(batches):
        rows = shared.value
        # Plan rows are sorted by (length, first rank): one number orders both.
        wide = int(rows[:, 2].max(initial=0)) + 1
        for batch in batches:
            length, rank = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            k = np.searchsorted(rows[:, 0] * wide + rows[:, 1], length * wide + rank, "right") - 1
            place = rank - rows[k, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows[k, 3] + place // rows[k, 4]), pa.array(rows[k, 5] + place % rows[k, 4] * length)],
                names=["own", "sequence_id", "offset"])

    schema = T.StructType([ranked.schema["own"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    drop_stage(counts)
    return ranked.mapInArrow(run, schema).select("own.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) from packed pieces with their ``ids``: at
    most ``capacity`` pieces meet in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
