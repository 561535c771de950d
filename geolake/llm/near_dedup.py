"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct five-word shingles.  Its SetSketch has M
registers: each shingle drops a seeded Poisson stream of points on the
registers, a register keeps its smallest point x as the exponentially spaced,
truncated value floor(1 - log_B x), clipped to [0, LIMIT].  Sketches of parts
merge by the register-wise maximum, and equal registers become likelier with
the Jaccard similarity, so bands of register values find candidates:

1. documents of equal sets (128-bit set fingerprint and size) get the smallest
   doc_id as representative; only representatives go on;
2. in every band bucket the members are paired with the bucket's smallest
   member (a star: as many pairs as members, whatever the bucket's size);
3. a pair goes on if the joint likelihood of its register comparisons allows
   the threshold, and becomes a link if the full sets confirm it exactly;
4. the links' connected components are found, and buckets that still hold
   several components are finished: their members of different components meet
   in cells of bounded size, which compare the full sets of all their pairs and
   return only the links that tie components together, so no link between
   different texts is lost to a star, and no list of pairs leaves a task;
5. the components after both rounds are the result.

Texts and registers are fetched once, for the members of shared buckets only
(Spark's runtime Bloom filter keeps the others out of the shuffle).

With M = 256 registers in 51 bands of 5 a pair of similarity 0.75 meets in
some band with probability 1 - 1e-6, a more similar pair almost surely.

Defined cases: A-Z are lower-cased, words are runs without ASCII white space.
A text of fewer than five words has its whole sequence as the one shingle;
null, empty or blank texts have the empty set, are linked with nothing and
kept.  Rows of one doc_id are one document (linked with each other).  Rows
with a null doc_id have a null component and are kept.  Groups of copies of
any size are split over tasks: aggregations combine on the map side, a leader's
members are verified in blocks of BLOCK rows, and cells hold at most about
CELL_ROWS rows and CELL_SHINGLES shingles of either side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import collect_garbage, drop_stage, shuffle_parts, stage
from .components import components
from .text import U64, mix, odd_randoms, shingle_sets

M, BANDS, ROWS = 256, 51, 5
#: Base of the register values' spacing, rate of a register's points, and the
#: largest value (16 bits).
B, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1
#: A pair is dropped when the threshold is exp(SLACK) times less likely than
#: the best similarity.
SLACK = 14.0
#: Members verified against one leader per step.
BLOCK = 256
#: What tells one set from another, and the most sets whose copies are salted.
SAME, HOT_SETS = ["n", "f1", "f2"], 1000
#: Size of one side of a cell, and the columns of one step of its comparison.
CELL_ROWS, CELL_SHINGLES, CELL_COLUMNS = 1024, 500_000, 8192


# ------------------------------------------------------------ registers
def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch register values (uint16) of each set, one row per set."""
    n = np.array([len(s) for s in sets])
    low = np.full((len(sets), M), np.inf)
    todo, reach = np.flatnonzero(n), np.log(M) + 14.0
    while len(todo):
        _drop_points([sets[i] for i in todo], low, todo, reach / n[todo])
        todo = todo[np.isinf(low[todo]).any(axis=1)]  # an empty register is rare: go further
        reach *= 2
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(low / RATE) / np.log(B))
    return np.clip(value, 0, LIMIT).astype(np.uint16)


def _drop_points(sets, low, rows, until) -> None:
    """Minima of the points before ``until``: per element a Poisson stream of
    rate M, each point on a uniform register; later points cannot be minima
    once all registers are filled."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    state = mix(np.concatenate(sets))
    at = np.zeros(len(row))
    flat = np.full(len(sets) * M, np.inf)
    while len(row):
        state = state + U64(0x9E3779B97F4A7C15)
        z = mix(state)
        at = at - np.log(((z >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / M
        on = at <= until[row]
        row, at, state, z = row[on], at[on], state[on], z[on]
        np.minimum.at(flat, row * M + (z & U64(M - 1)).astype(np.int64), at)
    low[rows] = np.minimum(low[rows], flat.reshape(-1, M))


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    part = regs[:, :BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(U64)
    total = (part * odd_randoms(ROWS, 77)).sum(axis=2, dtype=U64)
    return mix(mix(total) + odd_randoms(BANDS, 78)).view(np.int64)


def _log_p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (B - 1) / B) / np.log(B)


def likely(more, less, nu, nv, percent: int) -> np.ndarray:
    """Whether the similarity ``percent`` or more is within SLACK of the best
    log-likelihood of (registers greater, registers smaller, rest equal)."""
    more, less, nu, nv = (np.asarray(x, np.float64)[:, None] for x in (more, less, nu, nv))
    same = M - more - less
    top = np.minimum(nu, nv) / np.maximum(nu, nv)
    share = nu / (nu + nv)
    grid = np.linspace(0, 1, 65)[None, :] * top * (1 - 1e-9)

    def value(j):
        j = np.minimum(j, top * (1 - 1e-9))
        p = np.maximum(_log_p(np.maximum(share - (1 - share) * j, 0)), 1e-12)
        q = np.maximum(_log_p(np.maximum(1 - share - share * j, 0)), 1e-12)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    best = value(grid).max(axis=1)
    over = value(percent / 100 + np.linspace(0, 1, 17)[None, :] * (1 - percent / 100)).max(axis=1)
    return (over >= best - SLACK) & (top[:, 0] >= percent / 100 - 1e-9)


def confirmed(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


# ------------------------------------------------------------ steps
def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, f1, f2, regs): set size, set fingerprint, packed registers."""
    def run(batches):
        for batch in batches:
            ids, at, part, size = batch.column(0), 0, [], 0
            for s in shingle_sets(batch.column(1)):
                part.append(s)
                size += len(s)
                if size > 100_000 or at + len(part) == len(ids):
                    yield _sketch_rows(ids.slice(at, len(part)), part)
                    at, part, size = at + len(part), [], 0

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "id long, n long, f1 long, f2 long, regs binary"))


def _sketch_rows(ids, sets) -> pa.RecordBatch:
    regs = registers(sets)
    f1, f2 = (np.array([mix(s ^ U64(seed)).sum(dtype=U64) for s in sets], U64).view(np.int64)
              for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2),
         pa.array([r.tobytes() for r in regs], pa.binary())], names=["id", "n", "f1", "f2", "regs"])


def _buckets(reps: DataFrame) -> DataFrame:
    """(bkey, id, n) for every band of every representative."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, M)
            ids, n = (np.repeat(batch.column(k).to_numpy(zero_copy_only=False), BANDS) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(regs).ravel()), pa.array(ids), pa.array(n)], names=["bkey", "id", "n"])

    return reps.select("id", "n", "regs").mapInArrow(run, "bkey long, id long, n long")


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches allow the threshold."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, nb, ra, rb = (batch.column(i) for i in range(6))
            u, v = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, M) for x in (ra, rb))
            keep = likely((u > v).sum(axis=1), (u < v).sum(axis=1), na.to_numpy(), nb.to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    # An id with several texts has several sketches; each pair of them is tried.
    one = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    two = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    return (pairs.select("a", "b").join(one, "a").join(two, "b").where(_close("na", "nb", percent))
            .select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long").distinct())


def _close(m: str, n: str, percent: int) -> Column:
    """Whether sets of these sizes can be that similar."""
    return F.least(m, n) * 100 >= F.greatest(m, n) * percent


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) confirmed on the full sets: the text of a leader goes to
    each block of its members, a task holds one leader and a batch."""
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    members = (pairs.join(blocks, "a")
               .select("a", F.pmod(F.xxhash64("b"), "blocks").alias("block"), F.col("b").alias("id"), F.lit(1).alias("role")))
    leaders = members.select("a", "block").distinct().select("a", "block", F.col("a").alias("id"), F.lit(0).alias("role"))
    rows = (texts.join(members.unionByName(leaders), "id").select("a", "block", "role", "id", "t")
            .repartition(shuffle_parts(texts.sparkSession), "a", "block").sortWithinPartitions("a", "block", "role"))

    def run(batches):
        group, heads = None, []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(4)]
            out = []
            for a, block, role, row, s in zip(*cols, shingle_sets(batch.column(4))):
                if group != (a, block):
                    group, heads = (a, block), []
                if role == 0:
                    heads.append(s)
                elif any(confirmed(x, s, percent) for x in heads):
                    out.append((a, row))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _cells(mixed: DataFrame) -> DataFrame:
    """(bkey, x, i, j, id, comp, side): the members of each open bucket dealt
    into cells in which every two members of different components meet.  The
    bucket's largest component stands apart (its members need not meet each
    other): cell (0, i, j) joins its block i with block j of the others, cell
    (1, i, j) joins blocks i and j of the others."""
    sizes = mixed.groupBy("bkey", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    top = sizes.groupBy("bkey").agg(F.max(F.struct("c", "comp", "n")).alias("m"), F.sum("c").alias("c"), F.sum("n").alias("n"))

    def blocks(rows, shingles):
        return F.greatest(F.ceil(rows / CELL_ROWS), F.ceil(shingles / CELL_SHINGLES)).cast("int")
    top = top.select("bkey", F.col("m.comp").alias("main"), blocks(F.col("m.c"), F.col("m.n")).alias("nm"),
                     blocks(F.col("c") - F.col("m.c"), F.col("n") - F.col("m.n")).alias("no"))
    rows = mixed.join(top, "bkey").withColumn("is_main", F.col("comp") == F.col("main"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("nm")).otherwise(F.col("no"))).cast("int")

    def cell(x, i, j):
        return F.struct(F.lit(x).alias("x"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    rows = rows.withColumn("own", own)
    others = F.sequence(F.lit(0), F.col("no") - 1)
    for_main = F.transform(others, lambda j: cell(0, F.col("own"), j))
    for_other = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("nm") - 1), lambda i: cell(0, i, F.col("own"))),
        F.transform(others, lambda j: cell(1, F.least(j, F.col("own")), F.greatest(j, F.col("own")))))
    rows = rows.withColumn("cell", F.explode(F.when(F.col("is_main"), for_main).otherwise(for_other)))
    return rows.select("bkey", "cell.x", "cell.i", "cell.j", "id", "comp", F.when(F.col("is_main"), -1).otherwise(F.col("own")).alias("side"))


def _finished(cells: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that tie different components of a cell together."""
    key = ["bkey", "x", "i", "j"]
    rows = (cells.join(texts, "id").select(*key, "id", "comp", "side", "t")
            .repartition(shuffle_parts(texts.sparkSession), *key).sortWithinPartitions(*key))

    def run(batches):
        now, held = None, []
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in range(7)]
            for *cell, row, comp, side, own in zip(*cols, shingle_sets(batch.column(7))):
                if now != cell:
                    out += _ties(now, held, percent)
                    now, held = cell, []
                held.append((row, comp, side, own))
            yield _links_batch(out)
        yield _links_batch(_ties(now, held, percent))

    return rows.mapInArrow(run, "a long, b long").distinct()


def _links_batch(links) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _ties(cell, held, percent) -> list[tuple[int, int]]:
    """The links of a cell, but for those inside components already tied."""
    if len(held) < 2:
        return []
    ids, comp, side = (np.array([h[c] for h in held]) for c in range(3))
    sets = [h[3] for h in held]
    left = np.flatnonzero(side == (-1 if cell[1] == 0 else cell[2]))
    right = np.flatnonzero(side == cell[3])
    if not len(left) or not len(right):
        return []
    both = _shared([sets[k] for k in left], [sets[k] for k in right])
    n = np.array([len(x) for x in sets])
    hit = (both > 0) & (100 * both >= percent * (n[left][:, None] + n[right][None, :] - both))
    hit &= comp[left][:, None] != comp[right][None, :]
    tied: dict[int, int] = {}

    def root(c):
        while tied.get(c, c) != c:
            c = tied[c]
        return c
    out = []
    for l, r in zip(*np.nonzero(hit)):
        a, b = root(int(comp[left[l]])), root(int(comp[right[r]]))
        if a != b:
            tied[max(a, b)] = min(a, b)
            x, y = int(ids[left[l]]), int(ids[right[r]])
            out.append((min(x, y), max(x, y)))
    return out


def _shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets ``a`` with the sets ``b``: a
    product of 0/1 matrices over the shingles of both sides, in slabs."""
    (fa, ra), (fb, rb) = ((np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (a, b))
    vocab = np.intersect1d(fa, fb)
    total = np.zeros((len(a), len(b)), np.int64)
    where = []
    for flat, row in ((fa, ra), (fb, rb)):
        col = np.searchsorted(vocab, flat)
        on = col < len(vocab)
        on[on] = vocab[col[on]] == flat[on]
        order = np.argsort(col[on], kind="stable")
        where.append((col[on][order], row[on][order]))
    for start in range(0, len(vocab), CELL_COLUMNS):
        slabs = []
        for (col, row), n in zip(where, (len(a), len(b))):
            lo, hi = np.searchsorted(col, (start, start + CELL_COLUMNS))
            m = np.zeros((n, min(CELL_COLUMNS, len(vocab) - start)), np.float32)
            m[row[lo:hi], col[lo:hi] - start] = 1
            slabs.append(m)
        total += (slabs[0] @ slabs[1].T).astype(np.int64)  # exact: sums of at most CELL_COLUMNS ones
    return total


# ------------------------------------------------------------ operator
def _salted(rows: DataFrame, hot: DataFrame, by: Column) -> DataFrame:
    """``rows`` with ``salt``: 0, or for hot sets one of their salts."""
    known = rows.join(F.broadcast(hot), SAME, "left")
    return known.withColumn("salt", F.pmod(by, F.coalesce("salts", F.lit(1)))).drop("salts")


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    made = stage(sketch(docs, id_col, text_col), "sketch")
    member = made.where("n > 0 and id is not null")
    sets = stage(member.groupBy(*SAME).agg(F.min("id").alias("rep"), F.min_by("regs", "id").alias("regs"), F.count("*").alias("copies")), "sets")
    reps = sets.select(F.col("rep").alias("id"), "n", "regs")

    all_buckets = _buckets(reps)
    shared = all_buckets.groupBy("bkey").agg(F.min(F.struct("id", "n")).alias("lead"), F.max("id").alias("last")).where("lead.id < last")
    buckets = stage(all_buckets.join(shared.select("bkey", "lead"), "bkey"), "buckets")
    wanted = stage(buckets.select("id").distinct(), "needed")
    # The comparison marks the side as selective, which lets Spark build its
    # runtime Bloom filter from it.
    needed = wanted.where(F.col("id") >= F.lit(-(1 << 63)).cast("long"))
    near = stage(reps.join(needed, "id"), "near")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    texts = stage(texts.join(needed, "id"), "texts")
    collect_garbage(spark)

    star = buckets.where((F.col("id") != F.col("lead.id")) & _close("n", "lead.n", percent))
    star = star.select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct()
    likely_star = stage(_estimated(star, near, percent), "likely")
    edges = stage(_verified(likely_star, texts, percent).unionByName(_tied(member, sets)), "edges")
    for t in (wanted, near, likely_star):
        drop_stage(t)
    label = components(edges)

    # Buckets that hold several components still.
    named = buckets.select("bkey", "id", "n").join(label, "id", "left").select("bkey", "id", "n", F.coalesce("comp", "id").alias("comp"))
    named = stage(named.groupBy("bkey", "id", "comp").agg(F.max("n").alias("n")), "named")
    open_keys = (named.groupBy("bkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"))
                 .where("lo < hi and c > 2").select("bkey"))
    mixed = stage(named.join(open_keys, "bkey", "left_semi"), "mixed")
    more = stage(_finished(_cells(mixed), texts, percent), "ties")
    if not more.isEmpty():
        # The ties link components: theirs are found among the labels alone.
        one, two = (label.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab")
        ends = more.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        over = components(ends).select(F.col("id").alias("comp"), F.col("comp").alias("top"))
        nodes = label.unionByName(more.select(F.explode(F.array("a", "b")).alias("id")).distinct()
                                  .join(label, "id", "left_anti").select("id", F.col("id").alias("comp")))
        label = stage(nodes.join(over, "comp", "left").select("id", F.coalesce("top", "comp").alias("comp")), "label")
    for t in (buckets, texts, edges, named, mixed, more):
        drop_stage(t)
    collect_garbage(spark)

    comp = stage(sets.join(label, sets.rep == label.id, "left").select(*SAME, "copies", F.coalesce("comp", "rep").alias("component_id")), "comp")
    # A set's copies may be a third of all rows: of a set with a thousandth of
    # them or more, one row for each salt meets as many rows at most.
    share = F.greatest(F.lit(member.count() // HOT_SETS), F.lit(1))
    hot = comp.where(F.col("copies") > share).select(*SAME, F.ceil(F.col("copies") / share).cast("int").alias("salts"))   # under HOT_SETS rows
    each = comp.join(F.broadcast(hot), SAME, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    out = _salted(made.select("id", *SAME), hot, F.xxhash64("id", F.monotonically_increasing_id())).join(
        each.select(*SAME, "salt", "component_id"), [*SAME, "salt"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _tied(member: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of one doc_id's several texts."""
    own = F.struct(*SAME)
    several = member.groupBy("id").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo < hi").select("id")
    reps = member.join(several, "id", "left_semi").select("id", *SAME).distinct().join(sets.select(*SAME, "rep"), SAME).select("id", "rep")
    first = reps.groupBy("id").agg(F.min("rep").alias("a"))
    return reps.join(first, "id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id, one
    row of it; rows with a null id stay.  The caller's columns are carried in a
    struct, so their names may be any."""
    found = near_duplicates(docs, percent, id_col, text_col)
    kept = stage(found.where("kept").where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("key")).distinct(), "kept")
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own"), F.col(f"`{id_col}`").cast("long").alias("key"),
                      F.xxhash64(F.col(f"`{text_col}`")).alias("order"))
    once = Window.partitionBy("key").orderBy("order")
    stay = own.where("key is not null").join(kept, "key", "left_semi").withColumn("place", F.row_number().over(once)).where("place = 1")
    return stay.select("own").unionByName(own.where("key is null").select("own")).select("own.*")
